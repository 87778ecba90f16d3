"""Which tokens several documents have, and the stretches of a document that can be alike another one.

Let every stretch alike have at least ``similarity`` of its distinct tokens in
common with another document. With 1 for each place whose token another document
has, and less ``similarity / (1 - similarity)`` for each other one, it then scores
0 or more; of tokens that the document repeats itself, and no other has, the first
and the last place cost half of that, and those between nothing. A place is living if some stretch around it, long enough,
scores 0 or more. No passage reaches beyond living places, so all others can leave.

Tokens are counted exactly but for 32 bits and the number of their part, and the
answer is a table of bits, at most 128 MB: what is taken for shared by mistake lets
more places live, and never fewer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillmark.llm import kernel

PACKED = "part int, h binary"
PACKED_CLASSES = "part int, h binary, c binary"
LIVING = "id long, n int, s binary, e binary, t binary"
_PER_PART = 1 << 21
_MOST_BITS = 30


def _among(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(x), dtype=bool)
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x


def _parted(h: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Slices of ordered hashes by their first bits."""
    if not len(h):
        return
    part = (h >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    for i, j in zip(cuts, [*cuts[1:], len(h)], strict=True):
        yield int(part[i]), slice(int(i), int(j))


def _staying(batches: Iterator[pa.RecordBatch], gone) -> Iterator[pa.RecordBatch]:
    """Rows whose last column isn't in ``gone``, hashes in order."""
    for batch in batches:
        out = _among(batch.column(batch.num_columns - 1).to_numpy(), gone.value)
        yield batch.filter(pa.array(~out)) if out.any() else batch


def pack(tokens: Callable, least: int, bits: int, gone):
    """Of (id, text, x, k) without the rows with ``k`` in ``gone``: (part, 32 bits of each token), twice where two documents of a batch have it; of texts of ``least`` tokens or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(_staying(batches, gone), 1, 4 << 20):
            h, low, high = tokens(batch.column(1))
            doc = kernel.belongs(low, np.where(high - low >= least, high, low), len(h))
            h, doc = h[doc >= 0], doc[doc >= 0]
            x = np.sort(h)
            again = x[1:][x[1:] == x[:-1]]
            on = _among(h, again)
            some, of = h[on], doc[on]
            order = np.lexsort((of, some))
            some, of = some[order], of[order]
            twice = np.unique(some[1:][(some[1:] == some[:-1]) & (of[1:] != of[:-1])])
            x = x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x
            x = np.repeat(x, 1 + _among(x, twice))
            short = (x >> np.uint64(32 - bits)).astype(np.uint32)
            rows = [(p, short[at].tobytes()) for p, at in _parted(x, bits)]
            if rows:
                parts, bodies = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(bodies, pa.binary())], ["part", "h"])

    return run


def pack_classes(bits: int):
    """(part, 32 bits of tokens, their classes) of living stretches, each token and class once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(batches, 4, 8 << 20):
            data, offsets = kernel.buffers(batch.column(4))
            h, c = data.view(np.uint64), np.repeat(batch.column(5).to_numpy(), np.diff(offsets) // 8)
            order = np.lexsort((c, h))
            h, c = h[order], c[order]
            on = np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))
            h, c = h[on], c[on]
            short = (h >> np.uint64(32 - bits)).astype(np.uint32)
            parts, bodies, classes = zip(*((p, short[at].tobytes(), c[at].tobytes()) for p, at in _parted(h, bits)), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(bodies, pa.binary()), pa.array(classes, pa.binary())], ["part", "h", "c"])

    return run


def _merge(bits: int, size: int, classes: bool):
    """The bits of each part, rows in order of parts: places of tokens that come twice, or in two classes."""

    def done(part: int, bodies: list[bytes], of: list[bytes]) -> pa.RecordBatch:
        if classes:
            h, c = (np.frombuffer(b"".join(x), dtype=t) for x, t in ((bodies, np.uint32), (of, np.int64)))
            order = np.lexsort((c, h))
            h, c = h[order], c[order]
            at = h[1:][(h[1:] == h[:-1]) & (c[1:] != c[:-1])] >> np.uint32(32 - (size - bits))
        else:
            x = np.sort(np.frombuffer(b"".join(bodies), dtype=np.uint32))
            at = x[1:][x[1:] == x[:-1]] >> np.uint32(32 - (size - bits))
        table = np.zeros(1 << size - bits, dtype=bool)
        table[at.astype(np.int64)] = True
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(table).tobytes()], pa.binary())], ["part", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bodies, of = None, [], []
        for batch in batches:
            for part, body, *c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if part != now:
                    if now is not None:
                        yield done(now, bodies, of)
                    now, bodies, of = part, [], []
                bodies.append(body)
                of += c
        if now is not None:
            yield done(now, bodies, of)

    return run


class Filters:
    """Tables of bits for about ``n`` tokens, in parts of about two million."""

    def __init__(self, n: int) -> None:
        self.parts = max(4, (max(1, n) // _PER_PART).bit_length())
        self.size = max(self.parts + 3, min(_MOST_BITS, max(1, n).bit_length()))

    def of(self, packed: DataFrame, classes: bool = False):
        """The table, sent to all tasks, and its number of bits as a power of two."""
        table = np.zeros((1 << self.size) // 8, dtype=np.uint8)
        per = (1 << self.size - self.parts) // 8
        merged = packed.repartition(1 << self.parts, "part").sortWithinPartitions("part").mapInArrow(_merge(self.parts, self.size, classes), "part int, bits binary")
        for row in merged.toLocalIterator():  # at most 128 MB in all
            table[row.part * per : (row.part + 1) * per] = np.frombuffer(row.bits, dtype=np.uint8)
        return packed.sparkSession.sparkContext.broadcast(table.tobytes()), self.size


def _hits(table: bytes, size: int, h: np.ndarray) -> np.ndarray:
    at = (h >> np.uint64(64 - size)).astype(np.int64)
    return (np.frombuffer(table, dtype=np.uint8)[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def _misses(h: np.ndarray, doc: np.ndarray, among: np.ndarray) -> np.ndarray:
    """For the places ``among``, in halves, what a token costs that others lack: 2, or if its document has it there several times, 1 at the first and the last place."""
    x = h ^ kernel.mix(doc.astype(np.uint64), 5)
    out = 2 * among.astype(np.int64)
    y = np.sort(x[among])
    at = np.flatnonzero(among & _among(x, y[1:][y[1:] == y[:-1]]))
    at = at[np.argsort(x[at], kind="stable")]
    new = x[at[1:]] != x[at[:-1]]
    out[at] = np.concatenate(([True], new)).astype(np.int64) + np.concatenate((new, [True])) if len(at) else 0
    return out


def stretches(h: np.ndarray, hit: np.ndarray, low: np.ndarray, high: np.ndarray, least: int, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(from, to, range) of the living stretches: unions of all that are ``least`` long or more and score 0 or more.

    ``hit``: places whose token is shared. A token that is repeated at once counts as one place.
    """
    cost = int(1000 * similarity / (1 - similarity)) if similarity < 1 else 1 << 30
    sizes = np.maximum(high - low, 0)
    n, k = int(sizes.sum()), len(low)
    if not n:
        return (np.zeros(0, dtype=np.int64),) * 3
    of = np.repeat(np.arange(k), sizes)
    begin = np.cumsum(sizes) - sizes
    src = np.arange(n) - begin[of] + low[of]
    x, on = h[src], hit[src]
    first = np.concatenate(([True], (x[1:] != x[:-1]) | (of[1:] != of[:-1])))
    score = np.where(on & first, 1000, -(cost // 2) * _misses(x, of, first & ~on))
    at = np.arange(n) + of + 1  # a place before each range parts it from the last one
    q = np.full(n + k, -(cost + 1000) * (int(sizes.max()) + 2), dtype=np.int64)
    q[at] = score
    q = np.cumsum(q)
    best = np.maximum.accumulate(q[::-1])[::-1]
    # what starts among equal tokens has them too
    need = q.copy()
    need[at - 1] -= np.where(first, 0, score[first][np.cumsum(first) - 1])
    to = np.searchsorted(-best, -need, "right") - 1  # the farthest end that scores no less
    i = np.flatnonzero(to - np.arange(n + k) >= least)
    change = np.bincount(i + 1, minlength=n + k + 2) - np.bincount(to[i] + 1, minlength=n + k + 2)
    living = np.concatenate(([False], np.cumsum(change)[: n + k] > 0, [False]))
    edges = np.flatnonzero(living[1:] != living[:-1])
    back = np.zeros(n + k, dtype=np.int64)
    back[at] = src
    s, e = back[edges[::2]], back[edges[1::2] - 1] + 1
    number = np.zeros(n + k, dtype=np.int64)
    number[at] = of
    total = np.concatenate(([0], np.cumsum(hit)))
    some = total[e] > total[s]
    return s[some], e[some], number[edges[::2]][some]


def close(h: np.ndarray, hit: np.ndarray, low: np.ndarray, high: np.ndarray, least: int, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(from, to, range) of the runs of windows of ``least`` that lack few enough distinct tokens.

    A stretch alike has at most (1 - similarity) / similarity as many distinct tokens
    that aren't shared as it has shared ones, and these are at most all of its range. No
    window inside it can have more. In texts that repeat themselves this leaves less than
    the score, which counts a shared token at each of its places.
    """
    sizes = np.maximum(high - low, 0)
    n, k = int(sizes.sum()), len(low)
    if not n:
        return (np.zeros(0, dtype=np.int64),) * 3
    of = np.repeat(np.arange(k), sizes)
    end = np.cumsum(sizes)
    src = np.arange(n) - (end - sizes)[of] + low[of]
    x, on = h[src], hit[src]
    order = np.lexsort((x, of))
    again = (x[order][1:] == x[order][:-1]) & (of[order][1:] == of[order][:-1])
    before = np.full(n, -1)
    before[order[1:][again]] = order[:-1][again]
    total = np.bincount(of[on & (before < 0)], minlength=k)
    most = np.floor(total * (1 - similarity) / similarity + 1e-9)
    # a miss counts in the windows that hold its place and none of the same token before it
    miss = np.flatnonzero(~on)
    opens = np.maximum(np.maximum(before[miss], miss - least) + 1, (end - sizes)[of[miss]])
    lacks = np.cumsum(np.bincount(opens, minlength=n + 1) - np.bincount(miss + 1, minlength=n + 1))[:n]
    i = np.flatnonzero((lacks <= most[of]) & (np.arange(n) + least <= end[of]) & (total[of] > 0))
    if not len(i):
        return (np.zeros(0, dtype=np.int64),) * 3
    first = np.concatenate(([True], (i[1:] != i[:-1] + 1) | (of[i[1:]] != of[i[:-1]])))
    last = np.concatenate((first[1:], [True]))
    return src[i[first]], src[i[last] + least - 1] + 1, of[i[first]]


def _rows(ids: pa.Array, n: np.ndarray, h: np.ndarray, s: np.ndarray, e: np.ndarray, doc: np.ndarray, before: np.ndarray, which: np.ndarray) -> list[pa.Array]:
    """Columns of LIVING for the rows ``which``; ``before``: what is taken from the places of each stretch to count them from the document's start."""
    cuts = zip(np.searchsorted(doc, which).tolist(), np.searchsorted(doc, which, "right").tolist(), strict=True)
    begins, ends, bodies = [], [], []
    for i, j in cuts:
        begins.append((s[i:j] - before[i:j]).astype(np.int32).tobytes())
        ends.append((e[i:j] - before[i:j]).astype(np.int32).tobytes())
        bodies.append(b"".join(h[x:y].tobytes() for x, y in zip(s[i:j].tolist(), e[i:j].tolist(), strict=True)))
    return [ids.take(pa.array(which)), pa.array(n[which].astype(np.int32)), *(pa.array(x, pa.binary()) for x in (begins, ends, bodies))]


def living(tokens: Callable, least: int, similarity: float, seen, gone):
    """Of the same rows: the living stretches of each text of ``least`` tokens or more, which may be none."""
    sent, size = seen

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(_staying(batches, gone), 1, 1 << 20):
            h, low, high = tokens(batch.column(1))
            which = np.flatnonzero(high - low >= least)
            if not len(which):
                continue
            hit = _hits(sent.value, size, h)
            s, e, of = stretches(h, hit, low, high, least, similarity)
            columns = _rows(batch.column(0), high - low, h, s, e, of, low[of], which)
            yield pa.RecordBatch.from_arrays([*columns, batch.column(2).take(pa.array(which))], ["id", "n", "s", "e", "t", "x"])

    return run


def stretches_in(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Tokens of living stretches; of each stretch from, to, row and place in the document."""
    begins, ends = ([np.frombuffer(x, dtype=np.int32) for x in batch.column(c).to_pylist()] for c in (2, 3))
    row = np.repeat(np.arange(len(begins)), [len(x) for x in begins])
    place = np.concatenate(begins).astype(np.int64)
    width = np.concatenate(ends) - place
    data, _ = kernel.buffers(batch.column(4))
    return data.view(np.uint64), np.cumsum(width) - width, np.cumsum(width), row, place


def still_living(least: int, similarity: float, seen):
    """Of living stretches of documents with their classes, what lives if only tokens of several classes count: a row for each stretch, and its place once more."""
    sent, size = seen

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(batches, 4, 1 << 20):
            h, low, high, row, place = stretches_in(batch)
            hit = _hits(sent.value, size, h)
            s, e, of = stretches(h, hit, low, high, least, similarity)
            # whole ones, as what is alike is looked for with what lies around it
            some = np.unique(close(h, hit, s, e, least, similarity)[2])
            s, e, of = s[some], e[some], of[some]
            if len(s):
                at = place[of] + s - low[of]
                bodies = [h[i:j].tobytes() for i, j in zip(s.tolist(), e.tolist(), strict=True)]
                doc = pa.array(row[of])
                columns = [batch.column(0).take(doc), pa.array(at.astype(np.int32)), pa.array(bodies, pa.binary()), batch.column(5).take(doc)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "s", "t", "root"])

    return run


def postings(least: int, similarity: float, seen):
    """(h, id, s, root, least): the shared tokens of each stretch, and how many of them one alike must have at least."""
    sent, size = seen

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(batches, 2, 1 << 20):
            own, must = [], []
            for body in batch.column(2).to_pylist():
                h = np.frombuffer(body, dtype=np.uint64)
                own.append(np.unique(h[_hits(sent.value, size, h)]))
                must.append(max(1, int(np.ceil(similarity * _least_distinct(h, least) - 1e-9))))
            of = np.repeat(np.arange(len(own)), [len(x) for x in own])
            at = pa.array(of)
            columns = [pa.array(np.concatenate(own).view(np.int64)), *(batch.column(c).take(at) for c in (0, 1, 3)), pa.array(np.array(must, dtype=np.int32)[of])]
            yield pa.RecordBatch.from_arrays(columns, ["h", "id", "s", "root", "least"])

    return run


def _least_distinct(h: np.ndarray, least: int) -> int:
    """A number of distinct tokens that all stretches of ``least`` places have at least."""
    order = np.argsort(h, kind="stable")
    near = (h[order][1:] == h[order][:-1]) & (order[1:] - order[:-1] < least)
    again = np.zeros(len(h) + 1, dtype=np.int64)
    again[order[1:][near] + 1] = 1
    total = np.cumsum(again)
    return max(1, least - int((total[least:] - total[:-least]).max(initial=0)))
