"""SimHash near-duplicates by covering-code anchors.

Two fingerprints of 64 bits that differ in at most 3 agree up to one bit in the
lower or in the upper half. Of each half, 31 bits are searched: the anchors are
the code words of the perfect Hamming code [31, 26], whose covering radius is 1.
A fingerprint goes to every anchor within radius plus threshold, 1 + 1 = 2, of
its half: to 16 of them, or to one if it is a code word itself. If x and y are
within one bit there, the anchor nearest x is within 2 of y, so they meet.
Per anchor all fingerprints are compared over the whole 64 bits, and only a
spanning forest of the links leaves the task.

Equal fingerprints are one node, so groups of copies are never expanded. Anchors
with more than ``block`` fingerprints are compared in pairs of blocks.

Defined results: a null or empty text has no words and the fingerprint zero,
which links like any other. Rows repeated under one ``doc_id`` are fingerprinted
each. A null ``doc_id`` never names a component unless all its members are null.
An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm import graph, kernel
from quillmark.llm.native import Columns
from quillmark.llm.storage import Scratch

HALF = 31
BLOCK = 4096


def _fingerprints(texts: pa.Array, width: int) -> np.ndarray:
    parts = [b" ".join((t or b"").lower().split()) for t in texts.to_pylist()]
    data = b" ".join(parts)
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    raw = np.frombuffer(data, dtype=np.uint8)
    gaps = np.flatnonzero(raw == 0x20)
    gaps = gaps[~np.isin(gaps, begin[1:] - 1)]  # the spaces inside a text
    before, after = np.searchsorted(gaps, begin), np.searchsorted(gaps, begin + sizes)
    out = np.zeros(len(parts), dtype=np.uint64)
    n_words = np.where(sizes > 0, after - before + 1, 0)
    full = n_words >= width
    # short texts: one shingle, the whole sequence
    short = np.flatnonzero((n_words > 0) & ~full)
    out[short] = kernel.xxh64(data, begin[short], begin[short] + sizes[short])
    whole = np.flatnonzero(full)
    if not len(whole):
        return out
    # word k of a text starts after its gap k - 1 and ends at its gap k
    counts = (n_words - width + 1)[whole]
    of = np.repeat(np.arange(len(whole)), counts)
    k = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    text = whole[of]
    padded = np.concatenate((gaps, [0]))
    first = np.where(k == 0, begin[text], padded[np.minimum(before[text] + k - 1, len(gaps))] + 1)
    last = np.where(k == n_words[text] - width, begin[text] + sizes[text], padded[np.minimum(before[text] + k + width - 1, len(gaps))])
    h = kernel.xxh64(data, first, last)
    starts = np.cumsum(counts) - counts
    for bit in range(64):
        ones = np.add.reduceat(((h >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), starts)
        out[whole[2 * ones > counts]] |= np.uint64(1 << bit)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``(id, fp)`` for each row; ``fp`` holds the 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(batches, 1, 1 << 20):
            fp = _fingerprints(batch.column(1), width).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["id", "fp"])

    given = Columns(docs)
    rows = given.frame.select(given[id_col].alias("id"), given[text_col].cast("binary").alias("t"))
    return rows.mapInArrow(run, f"id {given.kind(id_col)}, fp long")


def _anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and code words of all anchors within 2 of each value of 31 bits."""
    syndrome = np.zeros(len(half), dtype=np.int64)
    for bit in range(HALF):
        syndrome ^= np.where((half >> bit) & 1, bit + 1, 0)
    rows, words = [], []
    own = np.flatnonzero(syndrome == 0)
    rows.append(own)
    words.append(half[own])
    off = np.flatnonzero(syndrome)
    for i in range(HALF + 1):  # flip position i (0: none) and the one that mends the rest
        j = syndrome[off] ^ i
        on = (i == 0) | (j > i)
        at, flip = off[on], j[on]
        code = half[at] ^ (np.int64(1) << (flip - 1))
        rows.append(at)
        words.append(code ^ (1 << (i - 1)) if i else code)
    return np.concatenate(rows), np.concatenate(words)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        bits = fp.view(np.uint64)
        for half in range(2):
            part = ((bits >> np.uint64(32 * half)) & np.uint64((1 << HALF) - 1)).astype(np.int64)
            rows, words = _anchors(part)
            yield pa.RecordBatch.from_arrays([pa.array(words | (half << HALF)), pa.array(fp[rows])], ["anchor", "fp"])


def _compare(limit: int):
    def links(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u, v = [], []
        for at in range(0, len(values), 256):
            near = np.bitwise_count(values[at : at + 256, None].view(np.uint64) ^ values[None, at:].view(np.uint64)) <= limit
            i, j = np.nonzero(near)
            on = i < j
            a, b = kernel.forest(values[at + i[on]], values[at + j[on]])
            u.append(a)
            v.append(b)
        return np.concatenate(u), np.concatenate(v)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            lists = batch.column(0)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.diff(offsets)
            u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            small = np.flatnonzero(sizes <= 64)
            for d in range(1, int(sizes[small].max(initial=1))):
                for e in range(d):
                    on = small[sizes[small] > d]
                    x, y = values[offsets[on] + e], values[offsets[on] + d]
                    near = np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)) <= limit
                    u.append(x[near])
                    v.append(y[near])
            for g in np.flatnonzero(sizes > 64):
                a, b = links(values[offsets[g] : offsets[g + 1]])
                u.append(a)
                v.append(b)
            yield kernel.forest(np.concatenate(u), np.concatenate(v))

    return lambda batches: graph.forests(pairs(batches))


def near_links(nodes: DataFrame, scratch: Scratch, threshold: int = 3, block: int = BLOCK) -> DataFrame:
    """``nodes(fp)``, distinct -> edges ``(u, v)`` with the same components as all pairs within ``threshold`` bits."""
    if not 0 <= threshold <= 3:
        raise ValueError("the anchors cover thresholds up to 3")
    spread = scratch.table(nodes.select("fp").mapInArrow(_replicate, "anchor long, fp long"), "anchors")
    hot = spread.groupBy("anchor").count().where(F.col("count") > block)
    hot = scratch.table(hot.select("anchor", F.ceil(F.col("count") / block).cast("int").alias("g")), "hot")
    pairs = spread.join(hot, "anchor", "left").withColumn("b", F.when(F.col("g").isNotNull(), F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")))
    # of a hot anchor, each pair of blocks is a group of its own
    other = F.when(F.col("g").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("g") - 1))
    pairs = pairs.withColumn("o", F.explode(other))
    pairs = pairs.select("anchor", "fp", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"))
    groups = pairs.groupBy("anchor", "lo", "hi").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return groups.select("fps").mapInArrow(_compare(threshold), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 3, width: int = 3) -> DataFrame:
    """One row for each of ``docs``: ``(id_col, fingerprint, component_id)``."""
    scratch = Scratch(docs.sparkSession, "simhash")
    fps = scratch.table(fingerprints(docs, id_col, text_col, width), "fps")
    nodes = scratch.table(fps.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = graph.components(near_links(nodes, scratch, threshold), scratch)
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = scratch.table(named, "named")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "root").select("fp", "component_id")
    out = fps.join(named, "fp")
    return out.select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").toDF(id_col, "fingerprint", "component_id")


def op9(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
