"""Turns of a log from tables of conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmark.plans.registry import ANSWER, QUERY, RETRIEVED_DOCS, SEARCH_QUERY


def question_answer_pairs(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` -> (conv_id, turn) and the four columns that rules read, one row for each turn of a user.

    The answer is the next turn if that is an assistant's, else null; the
    retrieved documents are the system's turn before, the search query the
    question's first words.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    beside = rows.select(
        "conv_id",
        "turn",
        "role",
        F.col("text").alias(QUERY),
        F.when(F.lead("role").over(order) == "assistant", F.lead("text").over(order)).alias(ANSWER),
        F.substring("text", 1, 20).alias(SEARCH_QUERY),
        F.when(F.lag("role").over(order) == "system", F.lag("text").over(order)).alias(RETRIEVED_DOCS),
    )
    return beside.where("role = 'user'").drop("role")
