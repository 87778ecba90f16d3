"""A Bloom filter over a distributed table of hashes, small enough to be sent to all tasks.

Tasks mark positions, segments of the table are merged where they belong, and the
driver only joins finished segments: at most ``max_bytes`` in all, whatever the
number of hashes. Beyond what that serves, more hashes that aren't in the table
pass; every use confirms exactly what passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm import kernel

MAX_BYTES = 64 << 20
SEGMENT_BITS = 20
_BITS_PER_KEY = 16


def _positions(h: np.ndarray, bits: int) -> np.ndarray:
    x = kernel.mix(h)
    mask = np.uint64((1 << bits) - 1)
    return np.stack((x & mask, kernel.mix(x, 1) & mask))


def _marks(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.unique(_positions(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits))
            parts, starts = np.unique(x >> np.uint64(SEGMENT_BITS), return_index=True)
            low = (x & np.uint64((1 << SEGMENT_BITS) - 1)).astype(np.uint32)
            bodies = [part.tobytes() for part in np.split(low, starts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(parts.astype(np.int64)), pa.array(bodies, pa.binary())], ["segment", "marks"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, table = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([np.packbits(table).tobytes()], pa.binary())], ["segment", "bits"])

    for batch in batches:
        for segment, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if segment != now:
                if now is not None:
                    yield done()
                now, table = segment, np.zeros(1 << SEGMENT_BITS, dtype=bool)
            table[np.frombuffer(body, dtype=np.uint32)] = True
    if now is not None:
        yield done()


class Bloom:
    """``hashes``: one column of longs. The filter itself is a broadcast."""

    def __init__(self, hashes: DataFrame, max_bytes: int = MAX_BYTES) -> None:
        spark = hashes.sparkSession
        n = hashes.count()
        bits = max(SEGMENT_BITS, int(np.ceil(np.log2(max(1, n) * _BITS_PER_KEY))))
        self.bits = min(bits, max(SEGMENT_BITS, int(np.log2(max_bytes * 8))))
        table = bytearray((1 << self.bits) // 8)
        per = (1 << SEGMENT_BITS) // 8
        if n:
            marks = hashes.mapInArrow(_marks(self.bits), "segment long, marks binary")
            merged = marks.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge, "segment long, bits binary")
            for row in merged.toLocalIterator():  # at most max_bytes in all
                table[row.segment * per : (row.segment + 1) * per] = row.bits
        self.n = n
        self.sent = spark.sparkContext.broadcast(bytes(table))


def lookup(table: bytes, bits: int, h: np.ndarray) -> np.ndarray:
    """For each of the longs whether it may be in the filter; all that are in it are."""
    at = _positions(h.view(np.uint64), bits)
    body = np.frombuffer(table, dtype=np.uint8)
    on = (body[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7)).astype(np.uint8))) & 1
    return on.all(axis=0)


def filtered(df: DataFrame, bloom: Bloom, schema: str) -> DataFrame:
    """``df`` whose first column, a long, may be in the filter."""
    sent, bits = bloom.sent, bloom.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = lookup(sent.value, bits, batch.column(0).to_numpy(zero_copy_only=False))
            if on.any():
                yield batch.filter(pa.array(on))

    return df.mapInArrow(run, schema)


def split(df: DataFrame, bloom: Bloom) -> tuple[DataFrame, DataFrame]:
    """``df`` whose first column, a long, can't be in the filter, and the rest; ``df`` is read once for each."""
    sent, bits = bloom.sent, bloom.bits

    def part(inside: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                on = lookup(sent.value, bits, batch.column(0).to_numpy(zero_copy_only=False)) == inside
                if on.any():
                    yield batch.filter(pa.array(on))

        return df.mapInArrow(run, df.schema)

    return part(False), part(True)


def without(docs: DataFrame, keys: list, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``keys``, expressions over it, are a row of ``gone``, nulls equal to nulls.

    Only rows that the filter of ``gone`` takes for such are shuffled.
    """
    n = len(keys)
    gone = gone.toDF(*[f"__gone{i}" for i in range(n)])
    few = Bloom(gone.select(F.xxhash64(*gone.columns).alias("x")))
    if not few.n:
        return docs
    names = docs.columns
    rows = docs.select(F.xxhash64(*keys).alias("x"), *[k.alias(f"k{i}") for i, k in enumerate(keys)], *[F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(names)])
    stays, some = split(rows, few)
    same = F.lit(True)
    for i in range(n):
        same = same & F.col(f"k{i}").eqNullSafe(F.col(f"__gone{i}"))
    columns = [f"in{i}" for i in range(len(names))]
    return stays.select(*columns).union(some.join(gone, same, "left_anti").select(*columns)).toDF(*names)
