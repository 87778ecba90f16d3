"""Repeated passages by a sparse suffix array.

Of each document only the suffixes at minimiser positions are kept: in every
window of ``words - prefix + 1`` positions the one whose five words hash least,
the leftmost of equals. A passage of ``words`` words or more that two documents
share has such a window inside, so both keep the same suffix of it, and at least
``prefix`` words of the passage follow.

Suffixes are sorted. The order is lexicographic over blocks of words, each block
standing for its hash: first ``prefix`` words, then 4, 8, 16 and 40 more. As in any
suffix array, what stands between two suffixes agrees with both in at least as
many blocks as these with each other; so each suffix is compared with the
neighbour before it, and with the one after it where that agrees in more blocks.
Each match is checked word by word and extended to the left and right in the texts.

Every passage of ``words`` words that another document has gives its document a
match that covers ``prefix`` words or more of it, through the suffix kept inside;
each match is as long as the two texts agree. Sorting deals rows by ranges, so a
very common passage is spread over tasks, and each suffix is compared with one
or two neighbours, never with all.

Words are runs of non-blanks, compared as they are. Defined results: null, empty
and short texts have no passages; rows without an id are left out; rows under
one id are one document and don't repeat each other. Ids may be of any type. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm import kernel, passages
from quillmark.llm.storage import Scratch

WORDS = 50
PREFIX = 41
_GRAM = 5
#: Words of the blocks after the prefix.
_BLOCKS = (4, 8, 16, 40)


def minimisers(values: np.ndarray, low: np.ndarray, high: np.ndarray, window: int) -> np.ndarray:
    """Positions that are the leftmost least of some window inside one of the ranges [low, high)."""
    on = np.flatnonzero(high - low >= window)
    if not len(on):
        return np.zeros(0, dtype=np.int64)
    least = kernel.sliding_argmin(values, window)
    inside = np.zeros(len(values) + 1, dtype=np.int64)
    np.add.at(inside, low[on], 1)
    np.add.at(inside, high[on] - window + 1, -1)
    chosen = np.zeros(len(values), dtype=bool)
    chosen[least[np.cumsum(inside)[: len(least)] > 0]] = True
    return np.flatnonzero(chosen)


def block_order(ranges: kernel.Ranges, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """32 bits that sort by the blocks of words from ``at`` on: eight bits for each, the first ones lead; texts end at ``end``."""
    out = np.zeros(len(at), dtype=np.uint64)
    for size in _BLOCKS:
        to = np.minimum(at + size, end)
        out = out << np.uint64(8) | ranges.hashes(at, to) >> np.uint64(56)
        at = to
    return (out.astype(np.int64) - (1 << 31)).astype(np.int32)  # in the order of signed numbers


def _suffixes(words: int, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(batches, 1, 1 << 20):
            data, offsets = kernel.buffers(batch.column(1))
            starts, ends, first = kernel.word_spans(data, offsets)
            w = kernel.word_hashes(data, starts, ends)
            n = len(w) - prefix + 1
            if n <= 0:
                continue
            low, high = kernel.runs(first, prefix)
            at = minimisers(kernel.mix(kernel.shingle_hashes(w, _GRAM)[:n], 7), low, high, words - prefix + 1)
            doc = kernel.belongs(low, high, n)[at]
            ranges = kernel.Ranges(w)
            columns = [
                pa.array(ranges.hashes(at, at + prefix).view(np.int64)),
                pa.array(block_order(ranges, at + prefix, first[doc + 1])),
                batch.column(0).take(pa.array(doc)),
                pa.array((at - low[doc]).astype(np.int32)),
                pa.array(np.zeros(len(at), dtype=np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "ord", "id", "pos", "ext"])

    return run


def _same(x: list, y: list, i: int, j: int, by: int) -> int:
    """How many words agree from i and j on, in steps of ``by`` (1 or -1)."""
    n = min(len(x) - i, len(y) - j) if by > 0 else min(i, j) + 1
    done, step = 0, 64
    while done < n:
        m = min(step, n - done)
        a, b = i + by * done, j + by * done
        same = x[a : a + m] == y[b : b + m] if by > 0 else x[a - m + 1 : a + 1] == y[b - m + 1 : b + 1]
        if same:
            done += m
            step *= 2
        elif m == 1:
            break
        else:
            step = max(1, m // 2)
    return max(0, done)


def extend(x: list, y: list, anchors: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Maximal matches (start in x, start in y, words) through the anchors, of ``least`` words or more."""
    out, reach = [], {}
    for i, j in sorted(anchors):
        if reach.get(i - j, -1) >= i:
            continue
        right = _same(x, y, i, j, 1)
        left = _same(x, y, i - 1, j - 1, -1) if i and j else 0
        reach[i - j] = i + right
        if left + right >= least:
            out.append((i - left, j - left, left + right))
    return out


def _compare(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(batches, 3):
            rows = []
            for a, b, anchors, ta, tb in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = ta.split(), tb.split()
                for i, j, n in extend(x, y, [(p["a_pos"], p["b_pos"]) for p in anchors], least):
                    rows += [(a, i, n, b, j), (b, j, n, a, i)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["id", "start_word", "n_words", "other_id", "other_word"])

    return run


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, prefix: int = PREFIX) -> DataFrame:
    """Rows (id_col, start_word, n_words, other_id, other_word): maximal matches with another document, for each of the two; one or two for each suffix."""
    if not _GRAM <= prefix <= words:
        raise ValueError(f"prefix must be between {_GRAM} and words")
    scratch = Scratch(docs.sparkSession, "suffixes")
    known = passages.Documents(docs, id_col, text_col, scratch)
    found = passages.links(known.frame.mapInArrow(_suffixes(words, prefix), passages.ROWS), scratch, to_first=False)
    pairs = scratch.table(found.groupBy("a", "b").agg(F.collect_list(F.struct("a_pos", "b_pos")).alias("at")), "pairs")
    pairs = passages.with_texts(pairs, known.frame, scratch).select("a", "b", "at", "ta", "tb")
    out = pairs.mapInArrow(_compare(prefix), "id long, start_word long, n_words long, other_id long, other_word long")
    return known.named(out.distinct())


def op7(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
