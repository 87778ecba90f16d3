"""Near-duplicate passages by compact windows.

Tokens are the hashes of five words from each position. Under one hash function,
all stretches of a document whose least token is at position c are those that
start in [l, c] and end in [c, r], where l and r reach to the next smaller tokens:
the node of c in the Cartesian tree over the hashes. These compact windows tell
the least token of all stretches of a passage's length at once.

A signature is the pair of least tokens under the two functions of a band. The
intervals of stretches that the windows of both functions give are joined, so one
row (signature, first and last stretch) stands for all stretches next to each
other that share it; there is one for about six words of a passage's length
in each band. Rows are sorted by signature, and under it by the tokens between the
two least ones, so that rows of one passage stand together. Each is linked with
the document before it, and where that differs in between, with the first one under
the signature: no row meets all others, however many share a passage.

Per pair of documents the rows' intervals are joined, and the stretches around
them verified: a match that is exact and has nothing alike beside it is taken at
once; else the longest parts of one whose tokens are mostly in the other are
found, then denser ones inside those that fail, and the sets of tokens of both
must have a Jaccard similarity of ``similarity`` or more. A stretch that reaches
the end of what is looked at is looked at again with more around it.

Before that, copies of whole texts (equal MD5) leave but for one and are linked
with it, and of the others all that can't be alike another document (``shared``).
Windows and links are those of what lives.

A stretch of similarity s shares a signature with a chance of s^2 in each band,
and a row is linked with one or two documents of its signature only. What this
misses is searched after it: linked documents are classes, and two documents of
different classes that are alike share tokens that are each in several classes. So
only such tokens count, places that still live are taken, and all pairs of stretches
of different classes that share enough of these tokens are verified. Classes are
therefore whole, whatever the bands find; documents of one class need not all be
verified against each other. The cost of this step grows with the square of the
number of classes that share a token among those still living.

Words are lower-cased runs of letters and digits. Defined results: null, empty
and short texts have no passages; rows without an id are left out; rows under
one id are one document. Ids may be of any type. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm import bloom, graph, kernel, passages, shared
from quillmark.llm.storage import Scratch
from quillmark.llm.suffix_dedup import minimisers

WIDTH = 5
WORDS = 50
BANDS = 3
SIMILARITY = 0.8
_LEVELS = 12
#: Marks of one passage are closer to each other than this.
_NEAR = 128
#: Up to so many copies of whole texts are known to all tasks.
_MOST_COPIES = 8_000_000
#: So many tokens must the rarest ones of two stretches of different classes share.
_SHARED = 4
_ZERO = np.zeros(1, dtype=np.int64)
_PAIR = np.uint64(0x9FB21C651E98DF25)


def compact_windows(values: np.ndarray, low: np.ndarray, high: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, l, c, r), ends included, of all nodes at least ``least`` wide; the leftmost of equal values is the least."""
    at = minimisers(values, low, high, least)
    doc = kernel.belongs(low, high, len(values))[at]
    tables = [values]
    for j in range(min(_LEVELS, max(1, int((high - low).max(initial=1))).bit_length())):
        t = tables[-1]
        tables.append(np.minimum(t[: len(t) - (1 << j)], t[1 << j :]) if len(t) > 1 << j else t[:0])
    own, first, last = values[at], low[doc], high[doc]
    left, right = at.copy(), at + 1
    for j in range(len(tables) - 1, -1, -1):
        t, by = tables[j], 1 << j
        if not len(t):
            continue
        while True:
            on = left - by >= first
            on[on] = t[left[on] - by] > own[on]
            left[on] -= by
            also = right + by <= last
            also[also] = t[right[also]] >= own[also]
            right[also] += by
            if j < len(tables) - 1 or not (on.any() or also.any()):
                break
    on = right - left >= least
    return doc[on], left[on], at[on], right[on] - 1


def _tokens(texts: pa.Array, width: int):
    data, offsets = kernel.buffers(texts)
    starts, ends, first = kernel.word_spans(data, offsets, kernel.NOT_ALNUM, punctuation=True)
    low, high = kernel.runs(first, width)
    return kernel.shingle_hashes(kernel.word_hashes(data, starts, ends), width), low, high


def windows_of_length(values: np.ndarray, low: np.ndarray, high: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The compact windows cut to stretches of ``least`` tokens: (first start, last start, c), in order of their starts.

    What starts in a window is one row of places beside each other in the list
    of the leftmost least tokens of all stretches.
    """
    count = np.maximum(high - low - least + 1, 0)
    starts = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
    at = kernel.sliding_argmin(values, least)[starts]
    opens = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)))) if len(at) else np.zeros(0, dtype=np.int64)
    return starts[opens], starts[np.append(opens[1:], len(at)) - 1] if len(at) else opens, at[opens]


def _windows(bands: int, words: int, width: int):
    least = words - width + 1
    bits = (2 * least).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(batches, 4, 1 << 20):
            h, low, high, row, place = shared.stretches_in(batch)
            of = kernel.belongs(low, high, len(h))
            ranges = kernel.Ranges(h)
            for i in range(bands):
                mixed = [kernel.mix(h, 11 + 2 * i + k) for k in range(2)]
                (a0, a1, a), (b0, b1, b) = (windows_of_length(v, low, high, least) for v in mixed)
                # join of the two lists of intervals, which part the same starts: each begins where one of both does
                s = np.union1d(a0, b0)
                x, y = (np.searchsorted(f, s, "right") - 1 for f in (a0, b0))
                e = np.minimum(a1[x], b1[y])
                a, b, d = a[x], b[y], of[s]
                between = ranges.hashes(np.minimum(a, b), np.maximum(a, b) + 1)
                # the place of the first least token tells how two documents lie to each other
                columns = [
                    pa.array(kernel.mix(mixed[0][a] * _PAIR + mixed[1][b]).view(np.int64)),
                    pa.array((between >> np.uint64(48)).astype(np.int32)),
                    batch.column(0).take(pa.array(row[d])),
                    pa.array((place[d] + a - low[d]).astype(np.int32)),
                    pa.array(((a - s) << bits | (e + least - 1 - a)).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "ord", "id", "pos", "ext"])

    return run


def joined(rectangles: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Interval join of (a from, a to, b from, b to): hulls of those that overlap in both, by one sweep over a."""
    done: list[list[int]] = []
    live: list[list[int]] = []
    for a0, a1, b0, b1 in sorted(rectangles):
        now, rest = [a0, a1, b0, b1], []
        for h in live:
            if h[1] < a0:
                done.append(h)
            elif h[2] <= now[3] and now[2] <= h[3]:
                now = [min(h[0], now[0]), max(h[1], now[1]), min(h[2], now[2]), max(h[3], now[3])]
            else:
                rest.append(h)
        live = [*rest, now]
    return [tuple(h) for h in (*done, *live)]


def dense(hit: np.ndarray, cost: int, least: int) -> list[tuple[int, int]]:
    """Disjoint stretches that score highest with 1 for each hit and -cost for each miss, ``least`` long or more."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    out, stack, total = [], [], 0
    previous = 0
    # maximal scoring subsequences over the runs of hits (Ruzzo and Tompa, 1999)
    for s, e in zip(edges[::2], edges[1::2], strict=True):
        total -= cost * int(s - previous)
        before, after = total, total + int(e - s)
        total, previous = after, e
        new = [int(s), int(e), before, after]
        while True:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][2] < new[2]), -1)
            if k < 0 or stack[k][3] >= new[3]:
                stack.append(new)
                break
            new = [stack[k][0], new[1], stack[k][2], new[3]]
            del stack[k:]
    out = [(s, e) for s, e, _, _ in stack if e - s >= least]
    return out


def longest(hit: np.ndarray, cost: int, least: int) -> list[tuple[int, int]]:
    """Disjoint stretches, from hit to hit and ``least`` long or more, that score 0 or more with 1 for each hit and -cost for each miss: the longest, then those beside it."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    gained = np.cumsum(ends - starts)
    before = gained - (ends - starts) - cost * (starts - gained + (ends - starts))
    after = gained - cost * (ends - gained)
    out, todo = [], [(0, len(starts))]
    while todo:
        i, j = todo.pop()
        if i >= j or ends[j - 1] - starts[i] < least:
            continue
        # for each end the first start that scores no more
        floor = np.minimum.accumulate(before[i:j])
        at = i + np.searchsorted(-floor, -after[i:j], "left")
        k = int(np.argmax(ends[i:j] - starts[at]))
        s, e = int(at[k]), i + k
        if ends[e] - starts[s] >= least:
            out.append((int(starts[s]), int(ends[e])))
            todo += [(i, s), (e + 1, j)]
    return sorted(out)


def _distinct(x: np.ndarray) -> np.ndarray:
    """In order and each once; for short arrays faster than numpy's own."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def _held(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in ``table``, which is in order."""
    if not len(table):
        return np.zeros(len(x), dtype=bool)
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x


def _overlap(p: np.ndarray, q: np.ndarray) -> float:
    """Jaccard similarity of two sets, in order."""
    both = np.count_nonzero(_held(p, q) if len(p) < len(q) else _held(q, p))
    return both / max(1, len(p) + len(q) - both)


def _widened(s: int, e: int, least: int, n: int) -> list[tuple[int, int]]:
    """The stretch, or if it is too short, those of ``least`` around it that lie within n: to the left, to the right, half and half."""
    lack = least - (e - s)
    if lack <= 0:
        return [(s, e)]
    places = {max(0, min(s - by, n - least)) for by in (lack, 0, lack // 2)}
    return [(x, x + least) for x in sorted(places)] if n >= least else []


def alike(p: np.ndarray, q: np.ndarray, least: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """(start, end, other start, other end, similarity) of disjoint stretches of p, each with the best one of q."""
    lenient = round(similarity / (1 - similarity)) if similarity < 1 else 1 << 30
    # two stretches of this length share so many tokens; ends that differ can lie outside what is shared
    core = int(np.ceil(2 * similarity / (1 + similarity) * least - 1e-9))
    hit = _held(p, np.sort(q))
    out = []
    dead: set[tuple[int, int]] = set()  # stretches of which q has too few tokens
    # the longest stretches first; where these are too unlike, denser ones inside them
    for cost in (lenient, 2 * lenient, 6 * lenient, 1 << 30):
        any_here = False
        for find, size in ((longest, core), (dense, least)):
            if np.count_nonzero(hit) < core:
                return out
            for s0, e0 in find(hit, cost, size):
                any_here = True
                if (s0, e0) in dead or not hit[s0:e0].any():
                    continue
                best, able = None, False
                for s, e in _widened(s0, e0, least, len(p)):
                    part = _distinct(p[s:e])
                    on = _held(q, part)
                    need = max(1, int(np.ceil(similarity * len(part) - 1e-9)))
                    if np.count_nonzero(on) < need:
                        continue
                    able = True
                    for search in (longest, dense):
                        for u0, v0 in search(on, cost, need):
                            for u, v in _widened(u0, v0, least, len(q)):
                                got = _overlap(part, _distinct(q[u:v]))
                                if got >= similarity and (best is None or (v - u, got, -u) > (best[3] - best[2], best[4], -best[2])):
                                    best = (s, e, u, v, got)
                        if best:
                            break
                if not able:
                    dead.add((s0, e0))
                if best:
                    hit[best[0] : best[1]] = False
                    out.append(best)
        if not any_here:
            break  # with a higher cost there are no more of them
    return out


def _living(p: np.ndarray, q: np.ndarray, least: int, similarity: float) -> list[tuple[int, int]]:
    """The stretches of p that can be alike one of q."""
    hit = _held(p, np.sort(q))
    s, e, _ = shared.stretches(p, hit, _ZERO, np.array([len(p)]), least, similarity)
    return list(zip(s.tolist(), e.tolist(), strict=True))


def _alike_parts(p: np.ndarray, q: np.ndarray, least: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """What is alike in p and q, by the stretches of each that can be alike one of the other's."""
    parts = _living(p, q, least, similarity)
    others = _living(q, p, least, similarity) if parts else []
    return [(i + s, i + e, k + u, k + v, got) for i, j in parts for k, m in others for s, e, u, v, got in alike(p[i:j], q[k:m], least, similarity)]


def _equal(x: np.ndarray, y: np.ndarray) -> int:
    """How many tokens agree from the start, by growing steps."""
    n, done, step = min(len(x), len(y)), 0, 64
    while done < n:
        to = min(n, done + step)
        differ = np.flatnonzero(x[done:to] != y[done:to])
        if len(differ):
            return done + int(differ[0])
        done, step = to, 4 * step
    return n


def exact_run(x: np.ndarray, y: np.ndarray, i: int, j: int) -> tuple[int, int]:
    """(start, end) in x of the equal tokens around x[i] and y[j], which are equal."""
    return i - _equal(x[:i][::-1], y[:j][::-1]), i + _equal(x[i:], y[j:])


def _segments(a: np.ndarray, a_ext: np.ndarray, b: np.ndarray, b_ext: np.ndarray, bits: int) -> list[tuple[int, np.ndarray, tuple[int, int, int, int]]]:
    """Marks that lie alike in both documents and close to each other: (b - a, places in a, rectangle)."""
    by = b.astype(np.int64) - a
    order = np.lexsort((a, by))
    a, a_ext, b, b_ext, by = a[order], a_ext[order], b[order], b_ext[order], by[order]
    cuts = np.flatnonzero((by[1:] != by[:-1]) | (a[1:] - a[:-1] > _NEAR)) + 1
    begins = np.concatenate(([0], cuts))
    low = (1 << bits) - 1
    sides = [f.reduceat(x, begins).tolist() for x, f in ((a - (a_ext >> bits), np.minimum), (a + (a_ext & low), np.maximum), (b - (b_ext >> bits), np.minimum), (b + (b_ext & low), np.maximum))]
    return list(zip(by[begins].tolist(), np.split(a, cuts), zip(*sides, strict=True), strict=True))


def _stretches(x: np.ndarray, y: np.ndarray, marks: tuple[np.ndarray, ...], least: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """(start, end, other start, other end, similarity) of passages of x that y has too."""
    if len(x) == len(y) and np.array_equal(x, y):
        return [(0, len(x), 0, len(y), 1.0)] if len(x) >= least else []
    segments = _segments(*marks, (2 * least).bit_length())
    runs: list[tuple[int, int, int]] = []
    for by, places, _ in segments:
        i = 0
        while i < len(places):
            p = int(places[i])
            s, e = exact_run(x, y, p, p + by) if x[p] == y[p + by] else (p, p + 1)
            runs.append((s, e, by))
            i = max(i + 1, int(np.searchsorted(places, e)))
    out: list[tuple[int, int, int, int, float]] = []
    for a0, a1, b0, b1 in joined([r for _, _, r in segments]):
        if any(s <= a0 and a1 < e and u <= b0 and b1 < v for s, e, u, v, _ in out):
            continue
        here = [(s, e, by) for s, e, by in runs if s <= a1 and a0 < e and s + by <= b1 and b0 < e + by]
        lo, hi = min([a0, *(s for s, _, _ in here)]), max([a1 + 1, *(e for _, e, _ in here)])
        if here:
            # all exact runs of the hull as one passage
            s, e = min(s for s, _, _ in here), max(e for _, e, _ in here)
            u, v = min(s + by for s, _, by in here), max(e + by for _, e, by in here)
            got = _overlap(_distinct(x[s:e]), _distinct(y[u:v])) if min(e - s, v - u) >= least and similarity * (e - s) <= v - u <= (e - s) / similarity + least else 0.0
            if got >= similarity:
                margin = max(8, (e - s) // 4)
                beside = np.concatenate((x[max(0, min(lo, s - margin)) : s], x[e : max(hi, e + margin)]))
                near = y[max(0, min(b0, u - margin)) : max(b1 + 1, v + margin)]
                # what lies beside it can't add to it if hardly anything there is alike
                if np.count_nonzero(_held(beside, np.sort(near))) <= (e - s) // 16:
                    out.append((s, e, u, v, got))
                    continue
        margin = least
        while True:
            x0, x1 = max(0, lo - margin), min(len(x), hi + margin)
            y0, y1 = max(0, min(b0, lo + b0 - a0) - margin), min(len(y), max(b1 + 1, hi + b1 - a1) + margin)
            found = [(x0 + s, x0 + e, y0 + u, y0 + v, got) for s, e, u, v, got in alike(x[x0:x1], y[y0:y1], least, similarity)]
            edge = any((s == x0 > 0) or (e == x1 < len(x)) for s, e, _, _, _ in found)
            if not edge or (x0 == 0 and x1 == len(x)):
                break
            margin *= 4
        out += found
    return sorted(set(out))


def _whole(n: int, begins: bytes, ends: bytes, tokens: bytes, side: int) -> np.ndarray:
    """All places of a document, with values of their own where no stretch lives."""
    out = 2 * np.arange(n, dtype=np.uint64) + np.uint64(side)
    h, at = np.frombuffer(tokens, dtype=np.uint64), 0
    for s, e in zip(np.frombuffer(begins, dtype=np.int32).tolist(), np.frombuffer(ends, dtype=np.int32).tolist(), strict=True):
        out[s:e] = h[at : at + e - s]
        at += e - s
    return out


def _verify(words: int, width: int, similarity: float):
    """Passages of pairs (a, b, at, living stretches of both)."""
    least = words - width + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(kernel.slices(batches, 6, 2 << 20), 10, 2 << 20):
            at = batch.column(2)
            ends = at.offsets.to_numpy()
            fields = [at.values.field(c).to_numpy() for c in range(4)]
            rows = []
            sides = zip(*(batch.column(c).to_pylist() for c in range(3, 11)), strict=True)
            for n, (a, b, side) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sides, strict=True)):
                x, y = _whole(*side[:4], 0), _whole(*side[4:], 1)
                marks = tuple(f[ends[n] : ends[n + 1]] for f in fields)
                fits = (marks[0] < len(x)) & (marks[2] < len(y))  # else of another text under this id
                found = _stretches(x, y, tuple(m[fits] for m in marks), least, similarity) if fits.any() else []
                for s, e, u, v, got in found:
                    one, two = (a, s, e - s + width - 1), (b, u, v - u + width - 1)
                    rows += [(*one, *two, got), (*two, *one, got)]
            if rows:
                yield _found_rows(rows)

    return run


def _verify_stretches(words: int, width: int, similarity: float):
    """Passages of pairs of living stretches (a, b, place and tokens of a's, of b's)."""
    least = words - width + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(kernel.slices(batches, 3, 2 << 20), 5, 2 << 20):
            rows = []
            for a, b, i, x, j, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                p, q = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                # looked at from either side, as what is found on one side depends on it
                there = _alike_parts(p, q, least, similarity) or [(u, v, s, e, got) for s, e, u, v, got in _alike_parts(q, p, least, similarity)]
                for s, e, u, v, got in there:
                    one, two = (a, i + s, e - s + width - 1), (b, j + u, v - u + width - 1)
                    rows += [(*one, *two, got), (*two, *one, got)]
            if rows:
                yield _found_rows(rows)

    return run


def _found_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.float64())], ["id", "start_word", "n_words", "other_id", "other_word", "other_words", "similarity"])


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from graph.forests((b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches)


class _Found:
    """Verified passages ``rows`` and the class ``roots(node, root)`` of each document that isn't the least of its class."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, words: int, similarity: float, bands: int, width: int) -> None:
        scratch = Scratch(docs.sparkSession, "windows")
        least = words - width + 1
        self.known = known = passages.Documents(docs, id_col, text_col, scratch, lower=True)
        # copies of a whole text: all but one leave, and are linked with that one
        texts = known.frame.select("id", "t", F.md5("t").alias("m"), F.xxhash64("t").alias("x"))
        groups = texts.groupBy("m").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.max(F.length("t")).alias("size"))
        groups = scratch.table(groups, "groups")
        total = groups.agg(F.sum("size")).first()[0] or 0
        several = groups.where("first < last").select(F.col("m").alias("m2"), "first")
        few = scratch.table(texts.select("id", "m", "x").join(several, F.col("m") == F.col("m2")).where("id <> first").select("m", "id", "x", "first").distinct(), "copies")
        key = F.xxhash64("m", "id")
        own = texts.select("id", "t", "x", key.alias("k"))
        n = few.count()
        if n > _MOST_COPIES:
            own, n = bloom.without(texts, [F.col("m"), F.col("id")], few.select("m", "id")).select("id", "t", "x", key.alias("k")), 0
        gone = np.sort(np.array([r.k for r in few.select(key.alias("k")).toLocalIterator()] if n else [], dtype=np.int64))
        gone = docs.sparkSession.sparkContext.broadcast(gone)
        # what can't be alike anything leaves
        filters = shared.Filters(total // 6)
        seen = filters.of(own.mapInArrow(shared.pack(lambda x: _tokens(x, width), least, filters.parts, gone), shared.PACKED))
        every = scratch.table(own.mapInArrow(shared.living(lambda x: _tokens(x, width), least, similarity, seen, gone), shared.LIVING + ", x long"), "living")
        alive = every.where(F.length("t") > 0).drop("x")
        scratch.free()
        # neighbours under signatures
        links = passages.links(alive.mapInArrow(_windows(bands, words, width), passages.ROWS), scratch, to_first=True)
        scratch.free()
        # dealt by a, so that the first texts need no other exchange; a document has one or two links for each of its rows
        pairs = links.repartition("a").groupBy("a", "b").agg(F.collect_list(F.struct("a_pos", "a_ext", "b_pos", "b_ext")).alias("at"))
        schema = "id long, start_word long, n_words long, other_id long, other_word long, other_words long, similarity double"

        for side in "ab":
            pairs = pairs.join(alive.select(F.col("id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in "nset"]), side)
        pairs = pairs.select("a", "b", "at", *[f"{x}_{c}" for x in "ab" for c in "nset"])
        found = scratch.table(pairs.mapInArrow(_verify(words, width, similarity), schema).distinct(), "passages")
        # of copies only those long enough
        count = every.select(F.col("id").alias("first"), "x", F.col("n") + (width - 1)).toDF("first", "x", "words").distinct()
        same = few.join(count, ["first", "x"]).select("id", F.lit(0).cast("long").alias("start_word"), F.col("words").cast("long").alias("n_words"), F.col("first").alias("other_id"), F.lit(0).cast("long").alias("other_word"), F.col("words").cast("long").alias("other_words"), F.lit(1.0).alias("similarity"))
        back = same.select(F.col("other_id").alias("id"), "other_word", "other_words", F.col("id").alias("other_id"), "start_word", "n_words", "similarity").toDF(*same.columns)
        found = found.union(scratch.table(same.union(back), "same"))
        roots = graph.components(found.select("id", "other_id").where("id > other_id").mapInArrow(_forests, "u long, v long"), scratch)
        # whatever could still link two classes: only tokens of several classes count
        named = alive.join(roots, F.col("id") == F.col("node"), "left").select("id", "n", "s", "e", "t", F.coalesce("root", "id").alias("root"))
        named = scratch.table(named, "named")
        scratch.drop("links")
        scratch.drop("living")
        seen = filters.of(named.mapInArrow(shared.pack_classes(filters.parts), shared.PACKED_CLASSES), classes=True)
        rest = scratch.table(named.mapInArrow(shared.still_living(least, similarity, seen), "id long, s int, t binary, root long"), "rest")
        if rest.limit(1).count():
            tokens = scratch.table(rest.mapInArrow(shared.postings(least, similarity, seen), "h long, id long, s int, root long, least int"), "postings")
            often = tokens.groupBy("h").agg(F.count("*").alias("df"), F.min("root").alias("one"), F.max("root").alias("two")).where("one < two").select("h", "df")
            of = Window.partitionBy("id", "s")
            rare = tokens.join(often, "h").withColumn("k", F.row_number().over(of.orderBy("df", "h"))).withColumn("all", F.count("*").over(of))
            # two alike share so many that their rarest ones, all but as many, have _SHARED in common
            rare = scratch.table(rare.where(f"k <= all - least + least({_SHARED}, least)").select("h", F.col("id").alias("a"), F.col("s").alias("a_s"), F.col("root").alias("ra"), F.least(F.lit(_SHARED), "least").alias("must")), "rare")
            other = rare.toDF("h", "b", "b_s", "rb", "must_b")
            more = rare.join(other, "h").where("a < b and ra <> rb").groupBy("a", "a_s", "b", "b_s").agg(F.count("*").alias("n"), F.max(F.least("must", "must_b")).alias("must")).where("n >= must")
            more = scratch.table(more.select("a", "a_s", "b", "b_s"), "others")
            for side in "ab":
                more = more.join(rest.select(F.col("id").alias(side), F.col("s").alias(f"{side}_s"), F.col("t").alias(f"{side}_t")), [side, f"{side}_s"])
            more = more.select("a", "b", "a_s", "a_t", "b_s", "b_t").mapInArrow(_verify_stretches(words, width, similarity), schema)
            more = scratch.table(more.distinct(), "late")
            if more.limit(1).count():
                found = found.union(more)
                links = more.select("id", "other_id")
                for c in ("id", "other_id"):
                    links = links.join(roots.toDF(c, f"r_{c}"), c, "left").withColumn(f"r_{c}", F.coalesce(f"r_{c}", c))
                links = links.where("r_id > r_other_id").select(F.col("r_id").alias("u"), F.col("r_other_id").alias("v")).distinct()
                again = graph.components(scratch.table(links, "late-links"), scratch, "late-classes")
                # a root that got a root itself takes its class with it
                moved = roots.join(again.toDF("root", "top"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
                roots = scratch.table(moved.union(again), "roots")
        self.rows, self.roots = found, roots


def near_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    width: int = WIDTH,
) -> DataFrame:
    """Rows (id_col, start_word, n_words, other_id, other_word, other_words, similarity): a passage and one like it elsewhere; for each of the two."""
    found = _Found(docs, id_col, text_col, words, similarity, bands, width)
    return found.known.named(found.rows)


def passage_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    width: int = WIDTH,
) -> DataFrame:
    """Rows (id_col, class_id, passages): each document that has a passage like one elsewhere, the least document reached by such links, and its passages."""
    found = _Found(docs, id_col, text_col, words, similarity, bands, width)
    passage = F.struct("start_word", "n_words", "other_id", "other_word", "other_words", "similarity")
    roots = found.roots.withColumnsRenamed({"node": "id", "root": "class"})
    if found.known.numbers is None:
        own = found.rows.groupBy("id").agg(F.sort_array(F.collect_list(passage)).alias("passages")).join(roots, "id", "left")
        return own.select(F.col("id").alias(id_col), F.coalesce("class", "id").alias("class_id"), "passages")
    name = found.known.numbers
    of = found.rows.select("id").distinct().join(roots, "id", "left").join(name, "id").select("name", F.coalesce("class", "id").alias("class"))
    of = of.join(of.groupBy("class").agg(F.min("name").alias("class_id")), "class").select(F.col("name").alias(id_col), "class_id")
    rows = found.known.named(found.rows)
    return rows.groupBy(id_col).agg(F.sort_array(F.collect_list(passage)).alias("passages")).join(of, id_col).select(id_col, "class_id", "passages")


def op1(spark, sf_dir: str) -> DataFrame:
    return passage_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
