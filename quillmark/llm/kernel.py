"""Array kernels over batches of texts: words, hashes, shingles, sliding minima.

They take the raw UTF-8 bytes of an Arrow column and return numpy arrays for the
whole batch, so that no Python object is made per word. All of them are
deterministic over processes and machines.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: [\x20\x09-\x0D]
BLANKS = np.zeros(256, dtype=bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
#: Everything ASCII that isn't a letter or digit; bytes of other characters belong to words.
NOT_ALNUM = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_CHUNK = 1 << 18


def give_back() -> None:
    """Returns memory that this process has freed to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_UP = _powers(_BASE, _CHUNK)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _CHUNK)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser; another ``seed`` gives another permutation."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & _MASK)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows again in pieces of about ``most`` bytes in ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def word_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = BLANKS, punctuation: bool = False):
    """Starts and ends of all words, and the number of words before each text.

    With ``punctuation`` the general punctuation block (U+2000 to U+207F) and
    the Latin-1 signs U+0080 to U+00BF part words too.
    """
    keep = ~breaks[data]
    if punctuation and len(data) > 2:
        lead = np.flatnonzero((data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81)))
        for i in range(3):
            keep[lead + i] = False
        lead = np.flatnonzero(data[:-1] == 0xC2)
        for i in range(2):
            keep[lead + i] = False
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    head = keep.copy()
    head[1:] &= ~keep[:-1]
    head[inner] = keep[inner]
    tail = keep
    last = tail.copy()
    last[:-1] &= ~tail[1:]
    last[inner - 1] = tail[inner - 1]
    starts, ends = np.flatnonzero(head), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits for each word, by its bytes alone."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + _CHUNK, side="right")))
        high = ends[to - 1]
        n = int(high - low)
        if n <= _CHUNK:
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * _UP[:n], out=sums[1:])
            s, e = starts[at:to] - low, ends[at:to] - low
            out[at:to] = (sums[e] - sums[s]) * _DOWN[s]
        else:  # one word longer than a chunk: the same sum, by parts
            total = 0
            for p in range(0, n, _CHUNK):
                part = data[low + p : min(high, low + p + _CHUNK)].astype(np.uint64) + np.uint64(1)
                total += int((part * _UP[: len(part)]).sum(dtype=np.uint64)) * pow(_BASE, p, 1 << 64)
            out[at] = total & _MASK
        at = to
    return mix(out)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for the ``width`` words from each position on, over the whole array."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += words[i : i + n]
    return mix(out)


class Ranges:
    """Hashes of any ranges of an array of words, from sums with powers of a base."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words * (_UP[:n] if n <= _CHUNK else _powers(_BASE, n)), out=self.sums[1:])
        self.down = _DOWN if n < _CHUNK else _powers(pow(_BASE, -1, 1 << 64), n + 1)

    def hashes(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For each range [low, high) of words, the same wherever the words stand; empty ones give one value."""
        return mix((self.sums[high] - self.sums[low]) * self.down[low], 3)


def runs(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text with ``first[i]`` to ``first[i + 1]`` words: the range of positions with a whole shingle."""
    low = first[:-1]
    return low, np.maximum(low, first[1:] - width + 1)


def belongs(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Text number of each of ``n`` positions, -1 outside all ranges."""
    out = np.full(n, -1, dtype=np.int64)
    sizes = high - low
    at = np.repeat(low - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    out[at] = np.repeat(np.arange(len(low)), sizes)
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``x[i : i + width]`` for each i with a whole window."""
    if len(x) < width:
        return x[:0]
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost minimum of ``x[i : i + width]`` for each i with a whole window."""
    at = np.arange(len(x))
    if len(x) < width:
        return at[:0]

    def joined(x: np.ndarray, at: np.ndarray, by: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = x[: len(x) - by], x[by:]
        return np.minimum(a, b), np.where(b < a, at[by:], at[: len(at) - by])

    span = 1
    while span * 2 <= width:
        x, at = joined(x, at, span)
        span *= 2
    return joined(x, at, width - span)[1] if width > span else at


_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _wrap(x: int) -> np.uint64:
    return np.uint64(x & _MASK)


def _rot(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rot(acc + lane * _P2, 31) * _P1


def xxh64(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of ``data[starts[i]:ends[i]]`` for all i at once."""
    raw = np.frombuffer(data + bytes(8), dtype=np.uint8)
    eight = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    four = np.ndarray((len(raw) - 3,), dtype="<u4", buffer=raw, strides=(1,))
    size = (ends - starts).astype(np.int64)
    at = starts.astype(np.int64)
    h = np.full(len(at), _wrap(seed + int(_P5)), dtype=np.uint64)
    long = np.flatnonzero(size >= 32)
    if len(long):
        acc = [np.full(len(long), v, dtype=np.uint64) for v in (_wrap(seed + int(_P1) + int(_P2)), _wrap(seed + int(_P2)), _wrap(seed), _wrap(seed - int(_P1)))]
        left, p = size[long] // 32, at[long].copy()
        on = np.arange(len(long))
        while len(on):
            for i in range(4):
                acc[i][on] = _round(acc[i][on], eight[p[on] + 8 * i])
            p[on] += 32
            left[on] -= 1
            on = on[left[on] > 0]
        joined = _rot(acc[0], 1) + _rot(acc[1], 7) + _rot(acc[2], 12) + _rot(acc[3], 18)
        for a in acc:
            joined = (joined ^ _round(np.zeros_like(a), a)) * _P1 + _P4
        h[long] = joined
        at[long] = p
    h += size.astype(np.uint64)
    rest = size & 31
    for _ in range(3):
        on = np.flatnonzero(rest >= 8)
        if not len(on):
            break
        h[on] = _rot(h[on] ^ _round(np.zeros(len(on), np.uint64), eight[at[on]]), 27) * _P1 + _P4
        at[on] += 8
        rest[on] -= 8
    on = np.flatnonzero(rest >= 4)
    h[on] = _rot(h[on] ^ (four[at[on]].astype(np.uint64) * _P1), 23) * _P2 + _P3
    at[on] += 4
    rest[on] -= 4
    for _ in range(3):
        on = np.flatnonzero(rest > 0)
        if not len(on):
            break
        h[on] = _rot(h[on] ^ (raw[at[on]].astype(np.uint64) * _P5), 11) * _P1
        at[on] += 1
        rest[on] -= 1
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    h ^= h >> np.uint64(32)
    return h


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges with the same components as (u, v): each node that isn't the least of its component, and that least one."""
    nodes, both = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = both[: len(u)], both[len(u) :]
    label = np.arange(len(nodes))
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        la, lb = la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]
