"""Connected components of a distributed edge table.

Alternating large-star and small-star steps (Kiveris et al., 2014): each step is
one minimum per node and one join, links are never gathered in one place, and a
node with very many links only ever meets its minimum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm import kernel
from quillmark.llm.storage import Scratch

_MAX_ROUNDS = 60


_STEP = 1_000_000


def forests(edges: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """The edges of one task, in steps, as forests with the same components."""
    u, v, size = [], [], 0

    def done() -> pa.RecordBatch:
        a, b = kernel.forest(np.concatenate(u), np.concatenate(v))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["u", "v"])

    for a, b in edges:
        u.append(a)
        v.append(b)
        size += len(a)
        if size > _STEP:
            yield done()
            u, v, size = [], [], 0
    if u:
        yield done()


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``edges(u, v)`` of longs without nulls, best a forest for each task -> ``(node, root)`` for each node that isn't the least of its component."""
    star = scratch.table(edges.select("u", "v").where("u <> v"), f"{name}-0")
    for step in range(1, _MAX_ROUNDS):
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # a table of its own: the join can then split a node with very many links
        least = scratch.table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-{step}m")
        # large star: each larger neighbour goes to the least of the neighbourhood
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.table(large.where("u <> v").distinct(), f"{name}-{step}l")
        # small star: the node and its smaller neighbours go to the least of them
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        star, before = scratch.table(small.where("u <> v").distinct(), f"{name}-{step}"), star
        # a set of stars: no root is itself below another node, and each node has one root
        row = star.agg(F.count("*").alias("n"), F.countDistinct("u").alias("d")).first()
        inner = star.select(F.col("v").alias("u")).join(star.select("u"), "u", "left_semi").limit(1).count()
        scratch.drop(f"{name}-{step - 1}")
        scratch.drop(f"{name}-{step}l")
        scratch.drop(f"{name}-{step}m")
        del before
        if not inner and row.n == row.d:
            return star.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError("components did not settle")

