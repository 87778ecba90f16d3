"""Reading chat logs from CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the inferring reader takes for a missing cell.
PANDAS_NA = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _options(line_breaks: bool) -> dict:
    return {"header": True, "multiLine": line_breaks, "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str,
    limit: int = 0,
    columns: Sequence[str] | None = None,
    na_tokens: bool = False,
    partitions: int | None = None,
    line_breaks: bool = True,
) -> DataFrame:
    """All cells as strings: RFC 4180 quotes, line breaks inside them, a BOM, blank lines, short rows.

    ``limit``: the first rows only (0: all). ``columns``: only these are parsed.
    ``na_tokens``: cells that mean "missing" to an inferring reader become null.
    With line breaks inside quotes a file is one split, and ``partitions`` spreads
    its rows for what comes after; with ``line_breaks=False``, for files that have
    none, each file is read in splits of ``spark.sql.files.maxPartitionBytes``.
    """
    names = spark.read.csv(path, inferSchema=False, **_options(line_breaks)).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    df = spark.read.schema(schema).csv(path, mode="PERMISSIVE", enforceSchema=True, **_options(line_breaks))
    if columns is not None:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    if na_tokens:
        df = df.select(*[F.when(~F.col(f"`{c}`").isin(*PANDAS_NA), F.col(f"`{c}`")).alias(c) for c in df.columns])
    if limit:
        df = df.limit(limit)
    return df.repartition(partitions) if partitions else df


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """The rows of all part tables, by the names of their columns; a column that a part lacks is null there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
