"""What the two passage operators share: links between sorted rows, and the texts of linked documents.

Rows ``(key, ord, id, pos, ext)`` are dealt by ranges of (key, ord, id, pos), so
a key that very many documents share is spread over several tasks, and each task
reads its rows in order and keeps a few of them. Under a key, the rows of one
document that follow each other are a run; rows are linked with the rows before
or after their run, which stand next to them in the order. What lies at the ends
of ranges is linked in a second step, dealt by key: a few rows for each range.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm import bloom
from quillmark.llm.native import Columns
from quillmark.llm.storage import Scratch

_STEP = 250_000
#: Rows of a range, as long as that gives no more ranges than a driver can plan; beyond, ranges grow, and their sort spills.
RANGE_ROWS = 500_000
MAX_RANGES = 100_000
ROWS = "key long, ord int, id long, pos int, ext int"
_LINKS = "edge int, key long, ord int, a long, a_pos int, a_ext int, b long, b_pos int, b_ext int"
_KINDS = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
_WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")


def _agreed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many leading bits two orders have in common, coarsely: the smaller the more."""
    return np.frexp((x ^ y).view(np.uint32).astype(np.float64))[1]


class _Runs:
    """Rows in order, parted by key and by runs of one document."""

    def __init__(self, key: np.ndarray, doc: np.ndarray) -> None:
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        new_run = new_key | np.concatenate(([True], doc[1:] != doc[:-1]))
        self.start = np.flatnonzero(new_run)
        self.end = np.append(self.start[1:], len(key))
        self.of = np.cumsum(new_run) - 1  # run of each row
        opens = new_key[self.start]  # the first run of its key
        self.before = np.where(opens, -1, np.arange(len(self.start)) - 1)
        self.after = np.where(np.append(opens[1:], True), -1, np.arange(len(self.start)) + 1)
        self.group = np.cumsum(opens) - 1  # key of each run
        self.first = np.flatnonzero(opens)[self.group]  # first run of its key


def _link(to_first: bool):
    """Links of rows in order, each with the row before its run. ``to_first``: where that differs in ``ord``, also with the first one under the key; else, where the row after its run is more alike in ``ord``, also with that one."""
    names = [x.split()[0] for x in _LINKS.split(", ")]

    def out(edge: int, rows: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        key, order, doc, pos, ext = rows
        if edge:
            columns = [np.ones(len(a)), key[a], order[a], doc[a], pos[a], ext[a], doc[b], pos[b], ext[b]]
        else:  # nobody asks for the key of a link
            columns = [np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a)), doc[a], pos[a], ext[a], doc[b], pos[b], ext[b]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # what later rows may still need
        linked = 0  # so many of them, in front, have their links already
        begun = False  # whether the ends of the first key are out
        parts: list[list[np.ndarray]] = []

        def step(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, linked, begun, parts
            every = ([held] if held is not None else []) + parts
            parts = []
            if not every:
                return
            rows = [np.concatenate(c) for c in zip(*every, strict=True)]
            key, order, doc, _, _ = rows
            n = len(key)
            if not n:
                return
            r = _Runs(key, doc)
            final = len(r.start) - 1
            a = np.arange(linked, n if last else r.start[final])
            k = r.of[a]
            before, after = r.before[k], r.after[k]
            p = np.where(before >= 0, r.end[before] - 1, -1)
            q = np.where(after >= 0, r.start[after], -1)
            yield from pairs(rows, a, np.where(p >= 0, p, q))
            if to_first:
                more = r.start[r.first[k]]
                on = (p >= 0) & (order[p] != order[a]) & (doc[more] != doc[a]) & (doc[more] != doc[p])
            else:
                more = q
                on = (p >= 0) & (q >= 0) & (_agreed(order[a], order[q]) < _agreed(order[a], order[p]))
            yield from pairs(rows, a[on], more[on])
            if not begun and (last or final > 0):
                begun = True
                yield from ends(rows, [r.start[0], r.start[1]] if r.after[0] >= 0 else range(r.start[0], r.end[0]))
            if last:
                yield from ends(rows, [n - 1, r.end[r.before[final]] - 1] if r.before[final] >= 0 else range(r.start[final], n))
                held = None
                return
            context = {int(r.start[r.first[final]]), int(r.end[r.before[final]] - 1)} if r.before[final] >= 0 else set()
            keep = np.array([*sorted(context), *range(r.start[final], n)])
            held, linked = [x[keep] for x in rows], len(context)

        def pairs(rows: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
            on = b >= 0
            if on.any():
                yield out(0, rows, a[on], b[on])

        def ends(rows: list[np.ndarray], at) -> Iterator[pa.RecordBatch]:
            at = np.array(list(at), dtype=np.int64)
            yield out(1, rows, at, at)

        size = 0
        for batch in batches:
            parts.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            size += batch.num_rows
            if size >= _STEP:
                yield from step(False)
                size = 0
        yield from step(True)

    return run


def links(rows: DataFrame, scratch: Scratch, to_first: bool) -> DataFrame:
    """Pairs (a, a_pos, a_ext, b, b_pos, b_ext), one or two for each row whose key another document has too."""
    rows = scratch.table(rows, "rows")  # ranges are found by sampling: not to be computed twice
    n = min(MAX_RANGES, max(rows.sparkSession.sparkContext.defaultParallelism, ceil(rows.count() / RANGE_ROWS)))
    order = ["key", "ord", "id", "pos"]
    found = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_link(to_first), _LINKS)
    found = scratch.table(found, "links")
    scratch.drop("rows")
    ends = found.where("edge = 1").select("key", "ord", F.col("a").alias("id"), F.col("a_pos").alias("pos"), F.col("a_ext").alias("ext")).distinct()
    ends = ends.repartition("key").sortWithinPartitions(*order).mapInArrow(_link(to_first), _LINKS)
    return found.union(ends).where("edge = 0").drop("edge", "key", "ord")


def with_texts(pairs: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``pairs(a, b, ...)`` with the texts ta and tb; of ``docs(id, t)`` only linked ones, and a few others that a Bloom filter takes for such, are shuffled."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    texts = scratch.table(bloom.filtered(docs, bloom.Bloom(scratch.table(ids, "ids")), "id long, t binary"), "texts")
    left = texts.select(F.col("id").alias("a"), F.col("t").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("t").alias("tb"))
    return pairs.join(left, "a").join(right, "b")


class Documents:
    """Documents as (id, t), ids as whole numbers and texts as bytes, rows without an id left out.

    Ids that aren't whole numbers get numbers of their own, and results their ids back.
    """

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, scratch: Scratch, lower: bool = False) -> None:
        given = Columns(docs)
        self.id_col, name, text = id_col, given[id_col], given[text_col]
        rows = given.frame.where(name.isNotNull()).select(name.alias("name"), (F.lower(text) if lower else text).cast("binary").alias("t"))
        self.numbers = None
        if given.kind(id_col) in _WHOLE_NUMBERS:
            self.frame = rows.select(F.col("name").cast("long").alias("id"), "t")
        else:
            # a table, so that the numbers are the same whenever they are read
            self.numbers = scratch.table(rows.select("name").distinct().select("name", F.monotonically_increasing_id().alias("id")), "numbers")
            self.frame = rows.join(self.numbers, "name").select("id", "t")

    def named(self, found: DataFrame) -> DataFrame:
        """``found`` with the documents' own ids in ``id_col`` and ``other_id``."""
        if self.numbers is not None:
            columns = found.columns
            for c in ("id", "other_id"):
                found = found.join(self.numbers.select(F.col("id").alias(c), F.col("name").alias("name_of")), c).drop(c).withColumnRenamed("name_of", c)
            found = found.select(*columns)
        return found.withColumnRenamed("id", self.id_col)
