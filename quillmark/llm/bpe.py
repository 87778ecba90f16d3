"""Byte-level BPE by prefix dynamic programming.

BPE gives each byte prefix of a piece exactly one possible last token: the token
that ends there and that BPE leaves alone after the last token of what precedes
it. :class:`Prefixes` stores that token per prefix. Appending bytes only adds
entries, and after an edit entries are recomputed only until they agree with the
old ones, so both give exactly what encoding the whole piece would.

Texts are split by the vocabulary's pattern first and each match is encoded
alone; a match that is itself a token is that token. Encodings of frequent
words are kept in bounded caches in each Python worker.

Defined results: null and empty texts have no tokens and decode to no bytes.
Bytes that aren't UTF-8 are read as U+FFFD. Output columns take the place of
input columns of their names; others pass through.
"""

from __future__ import annotations

import base64
import contextlib
import gc
import hashlib
import struct
import threading
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmark.llm import kernel
from quillmark.llm.storage import ship

#: Entries of a cache; words, which come most often, get six times as many.
_CACHE = 40_000
#: A vocabulary is sent to all tasks; larger files are refused.
MAX_VOCABULARY_BYTES = 64 << 20


class Vocabulary:
    """Ranks of byte strings, as in a ``.tiktoken`` file."""

    def __init__(self, body: bytes) -> None:
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in body.splitlines() if x.strip())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        #: Every end of a token, with its rank if it is itself one, else -1.
        self.ends = {token[i:]: -1 for token in self.ranks for i in range(len(token))} | self.ranks
        self.longest = max(map(len, self.ranks))
        self.pairs: dict[int, bool] = {}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing[:5]}")

    def merged(self, piece: bytes) -> list[int]:
        """Plain BPE: the pair of least rank is joined again and again, the leftmost first."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranked = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not ranked:
                break
            i = min(ranked)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def follows(self, before: int, token: int) -> bool:
        """Whether BPE leaves ``token`` alone after ``before`` (-1: at the start)."""
        own = [token] if before < 0 else [before, token]
        known = self.merged(b"".join(self.tokens[t] for t in own)) == own
        if len(self.pairs) >= 6 * _CACHE:
            self.pairs.clear()
        self.pairs[before << 32 | token] = known
        return known

    def extend(self, data: bytes, last: list[int], stop: int | None = None) -> None:
        """Appends to ``last`` the last token of each prefix of ``data`` beyond the first ``len(last)``, up to ``stop`` bytes."""
        ends, pairs = self.ends, self.pairs
        for end in range(len(last) + 1, (len(data) if stop is None else stop) + 1):
            for start in range(end - 1, -1, -1):
                token = ends.get(data[start:end])
                if token is None:
                    raise ValueError("no token ends here; the vocabulary isn't one of BPE")
                if token >= 0:
                    before = last[start - 1] if start else -1
                    known = pairs.get(before << 32 | token)
                    if known or (known is None and self.follows(before, token)):
                        last.append(token)
                        break
            else:
                raise ValueError("no token ends here; the vocabulary isn't one of BPE")

    def path(self, data: bytes, last: list[int]) -> list[int]:
        """The tokens of ``data``, read backwards from the last one."""
        out, end, tokens = [], len(data), self.tokens
        while end:
            token = last[end - 1]
            out.append(token)
            end -= len(tokens[token])
        return out[::-1]


class Prefixes:
    """The last token of every prefix of ``data``."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.extend(self.data, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Puts ``new`` for ``data[start:stop]``; returns how many prefixes were computed."""
        old = self.last[stop:]
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = self.last[:start]
        edited = start + len(new)
        agree = 0
        for end in range(start + 1, len(self.data) + 1):
            self.vocabulary.extend(self.data, self.last, end)
            agree = agree + 1 if end > edited and self.last[-1] == old[end - edited - 1] else 0
            if agree >= self.vocabulary.longest:  # all that later prefixes look back on is as before
                self.last += old[end - edited :]
                return end - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        return self.vocabulary.path(self.data, self.last)


@lru_cache(maxsize=4096)
def _packer(n: int) -> struct.Struct:
    """So many ids, four bytes each."""
    return struct.Struct(f"<{n}i")


class _Kept(dict):
    """A bounded cache: when it is full, what was used since the last time stays."""

    def __init__(self, make, size: int = _CACHE) -> None:
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = out
        return out


#: Words whose neighbourhood shows whether a pattern splits alike at blanks, whatever stands beside them.
_PROBES = ("a", "'s", "I'll", "é", "12", "3a", "!?", "...", "漢字", "_x", "x_", "-", "\u00a0b", "🙂", "A.b", "\x00", "/", "Ünï")


def splits_at_blanks(split) -> bool:
    """Whether each word with the blank before it, and each line break, is split by itself."""
    for a in _PROBES:
        for b in _PROBES:
            for gap in (" ", "\n"):
                lead = [gap, b] if gap == "\n" else [gap + b]
                if split(a + gap + b) != [x for part in (a, *lead) for x in split(part)]:
                    return False
    return True


class Encoder:
    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        self.by_word = splits_at_blanks(self.split)
        self.known, self.begun = _Kept(self._piece), _Kept(self._begin)
        self.first, self.next = _Kept(lambda word: self._word("", word)), _Kept(lambda word: self._word(" ", word), 6 * _CACHE)
        self.line = self.pieces("\n")

    def _begin(self, start: bytes) -> tuple[int, ...]:
        """The last tokens of the prefixes of a beginning that pieces share."""
        last = list(self.begun[start[:-3]]) if len(start) > 3 else []
        self.vocabulary.extend(start, last)
        return tuple(last)

    def _piece(self, text: str) -> bytes:
        data = text.encode("utf-8", "replace")
        rank = self.vocabulary.ranks.get(data)
        if rank is not None:
            return _packer(1).pack(rank)
        last = list(self.begun[data[: min(12, (len(data) - 1) // 3 * 3)]])
        self.vocabulary.extend(data, last)
        ids = self.vocabulary.path(data, last)
        return _packer(len(ids)).pack(*ids)

    def _word(self, lead: str, word: str) -> bytes | None:
        """The ids of a word as it stands after ``lead``; None where its neighbours matter."""
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        found = self.split(lead + word)
        return self._piece(found[0]) if len(found) == 1 else b"".join(map(self.known.__getitem__, found))

    def pieces(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self.split(text)))

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.encode(text), dtype="<i4").tolist()

    def encode(self, text: str) -> bytes:
        """The ids, four bytes each."""
        # where the pattern allows it, a word between single blanks is split by itself; other spacing is split as a whole
        if not self.by_word:
            return self.pieces(text)
        parts = []
        after, first, line = self.next.__getitem__, self.first.__getitem__, self.line
        for one in text.split("\n"):
            words = one.split(" ")
            parts.append(line)
            parts.append(first(words[0]))
            parts.extend(map(after, words[1:]))
        return self.pieces(text) if None in parts else b"".join(parts[1:])


_encoders: dict[tuple[bytes, str], Encoder] = {}
_lock = threading.Lock()
_tasks = 0
_IDLE_S = 1.5


def _release(at: int) -> None:
    """Frees the caches of a worker that no task has used since task number ``at``: idle workers live on for a while."""
    with _lock:
        if at == _tasks:
            _encoders.clear()
            gc.collect()
            kernel.give_back()


@contextlib.contextmanager
def _encoder(body: bytes, pattern: str) -> Iterator[Encoder]:
    """The worker's encoder, warm from its last task if that has just ended."""
    global _tasks
    key = (hashlib.sha256(body).digest(), pattern)
    with _lock:
        _tasks += 1
        mine = _tasks
        encoder = _encoders.get(key)
        if encoder is None:
            _encoders.clear()
            encoder = _encoders[key] = Encoder(Vocabulary(body), pattern)
    try:
        yield encoder
    finally:
        timer = threading.Timer(_IDLE_S, _release, (mine,))
        timer.daemon = True
        timer.start()


def _vocabulary_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        body = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(body) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {MAX_VOCABULARY_BYTES} bytes")
    return body


class _Decoder:
    """Bytes of the tokens, one after another."""

    def __init__(self, body: bytes) -> None:
        pairs = sorted((int(b), base64.b64decode(a)) for a, b in (x.split() for x in body.splitlines() if x.strip()))
        self.table = np.frombuffer(b"".join(t for _, t in pairs), dtype=np.uint8)
        self.begin = np.zeros(pairs[-1][0] + 1, dtype=np.int64)
        self.size = np.full(pairs[-1][0] + 1, -1, dtype=np.int64)
        held, known = np.array([len(t) for _, t in pairs], dtype=np.int64), np.array([r for r, _ in pairs])
        self.size[known], self.begin[known] = held, np.cumsum(held) - held

    def column(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """A binary column from ids and the offsets of its rows."""
        ids = ids.astype(np.int64)
        sizes = self.size[ids]
        if (sizes < 0).any():
            raise ValueError("an id isn't in the vocabulary")
        ends = np.concatenate(([0], np.cumsum(sizes)))
        flat = self.table[np.repeat(self.begin[ids] - ends[:-1], sizes) + np.arange(ends[-1])]
        bounds = ends[offsets].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(flat)])


def encode(df: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", ids_col: str = "ids", bytes_col: str | None = None) -> DataFrame:
    """``df`` with the token ids of ``text_col`` in ``ids_col``. ``vocabulary`` is a file the driver can read.

    With ``bytes_col`` the ids are decoded again in the same pass, into that column.
    """
    spark = df.sparkSession
    ship(spark)
    body = spark.sparkContext.broadcast(_vocabulary_bytes(vocabulary))
    taken = {c.casefold() for c in (ids_col, bytes_col) if c}
    rest = [c for c in df.columns if c.casefold() not in taken]
    frame = df.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text_col}`").cast("binary").alias("__t"))
    made = [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False)), *([T.StructField(bytes_col, T.BinaryType())] if bytes_col else [])]
    schema = T.StructType([*[df.schema[c] for c in rest], *made])
    at, names = len(rest), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel.give_back()
        decoder = _Decoder(body.value) if bytes_col else None
        with _encoder(body.value, pattern) as encoder:
            for batch in kernel.slices(batches, at, 1 << 20):
                ids = [encoder.encode((t or b"").decode("utf-8", "replace")) for t in batch.column(at).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int64) // 4
                flat = np.frombuffer(b"".join(ids), dtype="<i4").astype(np.int32, copy=False)
                columns = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))]
                if decoder:
                    columns.append(decoder.column(flat, ends))
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], *columns], names)

    return frame.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes of ``ids_col`` in the binary column ``bytes_col``; null counts as no ids."""
    spark = df.sparkSession
    ship(spark)
    body = spark.sparkContext.broadcast(_vocabulary_bytes(vocabulary))
    rest = [c for c in df.columns if c.casefold() != bytes_col.casefold()]
    at = rest.index(ids_col)
    schema = T.StructType([*[df.schema[c] for c in rest], T.StructField(bytes_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _Decoder(body.value)
        for whole in batches:
            for low in range(0, whole.num_rows, 64):
                batch = whole.slice(low, 64)
                lists = batch.column(at)
                if lists.null_count:
                    lists = lists.fill_null([])
                offsets = lists.offsets.to_numpy().astype(np.int64)
                ids = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
                yield pa.RecordBatch.from_arrays([*batch.columns, decoder.column(ids, offsets - offsets[0])], [*rest, bytes_col])

    return df.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema)


def digests(df: DataFrame, ids_col: str = "ids", bytes_col: str = "decoded") -> list:
    """The columns n_tokens, ids_sha256 and decoded_sha256."""
    return [
        F.size(ids_col).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col(ids_col).cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(bytes_col), 256).alias("decoded_sha256"),
    ]


def op10(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode(docs, path, public_tokenizers.PATTERN, bytes_col="decoded")
    return coded.select("doc_id", *digests(coded))
