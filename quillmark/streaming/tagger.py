"""The packs on streams: rules hold no state, so the batch expressions run as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quillmark.operators.tagging import row_tags
from quillmark.plans.registry import ANSWER, QUERY


def tag_stream(stream: DataFrame, path: str, checkpoint: str, query_col: str = QUERY, answer_col: str = ANSWER, flag_col: str = "Flags") -> StreamingQuery:
    """Tags what is there and ends; a later start with the same checkpoint goes on from it."""
    out = row_tags(stream, query_col, answer_col, flag_col)
    return out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
