"""Exact line dedup with two Bloom filters.

A line's key is the line without blanks ``[\\x20\\x09-\\x0D]`` at its ends and with
A-Z in lower case. A first pass over the texts puts the hash of each key of a
document into the filter of keys seen once, and if it is in there already, into
that of keys seen twice. Each task sends only the positions it sets, and each
segment of the filters is merged where it belongs, so the filters are a table
that grows with the keys and keeps its rate of false positives. The second pass
shuffles the keys that the twice-seen filter holds, as digests of 128 bits, and
only these, for the exact decision: the documents a key is in are counted, and
the largest ``doc_id`` keeps it.

Up to ``max_filter_bytes`` the twice-seen filter goes to all tasks. Beyond, the
hashes go to the filter: each is dealt to the segment it belongs to, and segments
with very many hashes, as that of a line which a third of all documents hold, are
copied to several tasks that share them.

Lines go where texts are read: up to ``max_filter_bytes`` the repeated keys and
their keepers are sent to all tasks and no text moves; beyond, documents that lose
lines, and a few others by a Bloom filter, are joined with what they lose.

Defined results: a null or empty text is one empty line. Rows under one
``doc_id`` are one document. Rows without a ``doc_id`` count as no document;
they lose lines that enough others hold. Lines without 20 code points, repeated
or not, stay. An empty table gives no rows. Output columns take the place of
input columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm import bloom, kernel
from quillmark.llm.native import Columns
from quillmark.llm.storage import Scratch

_BLANKS = b" \t\n\x0b\x0c\r"
_SEGMENT_BITS = 20
BITS_PER_KEY = 24
MAX_FILTER_BYTES = 64 << 20
#: Hashes of a segment beyond these go to several tasks.
SEGMENT_ROWS = 2_000_000
_FLUSH = 1_000_000


def _keys(text: bytes, least: int) -> list[bytes | None]:
    """The key of each line, None where it has too few code points."""
    out: list[bytes | None] = []
    for line in text.split(b"\n"):
        key = line.strip(_BLANKS).lower()
        long = len(key) >= 4 * least or (len(key) >= least and len(key.decode("utf-8", "replace")) >= least)
        out.append(key if long else None)
    return out


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)


def _digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def _segments(h: np.ndarray, segments: int) -> np.ndarray:
    """The segment each hash belongs to."""
    return ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)


def _positions(h: np.ndarray) -> np.ndarray:
    """Two positions in its segment for each hash."""
    return np.stack((kernel.mix(h, 1), kernel.mix(h, 2))) & np.uint64((1 << _SEGMENT_BITS) - 1)


def _marks(least: int, segments: int):
    """Pass one: (segment, positions seen once, positions of keys seen twice) for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            h, counts = np.unique(np.concatenate(seen), return_counts=True)
            of = _segments(h, segments)  # in order, as h is
            at = _positions(h)
            cuts = np.flatnonzero(np.diff(of)) + 1
            rows = [[], [], []]
            for a, b in zip([0, *cuts], [*cuts, len(h)], strict=True):
                rows[0].append(int(of[a]))
                part, again = at[:, a:b], counts[a:b] > 1
                rows[1].append(np.unique(part).astype(np.uint32).tobytes())
                rows[2].append(np.unique(part[:, again]).astype(np.uint32).tobytes())
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())], ["segment", "once", "twice"])

        n = 0
        for batch in kernel.slices(batches, 0):
            for text in batch.column(0).to_pylist():
                own = {k for k in _keys(text or b"", least) if k is not None}
                if own:
                    seen.append(_hashes(list(own)))
                    n += len(own)
            if n > _FLUSH:
                yield flush()
                seen, n = [], 0
        if seen:
            yield flush()

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments, their parts one after another, to the segment of the twice-seen filter."""
    size = 1 << _SEGMENT_BITS
    now, once, twice = None, None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([np.packbits(twice).tobytes()], pa.binary())], ["segment", "bits"])

    for batch in batches:
        for segment, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if segment != now:
                if now is not None:
                    yield done()
                now, once, twice = segment, np.zeros(size, bool), np.zeros(size, bool)
            part = np.frombuffer(a, dtype=np.uint32)
            twice[part[once[part]]] = True
            twice[np.frombuffer(b, dtype=np.uint32)] = True
            once[part] = True
    if now is not None:
        yield done()


def _held(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether both positions of each hash are set in the packed bits."""
    return ((table[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7)).astype(np.uint8))) & 1).all(axis=0)


_NAMES = ["id", "t", "h", "d"]


def _suspects(least: int, segments: int, sent):
    """Pass two: (id, t, h, digest) for each key of a document, with ``sent`` only of those that may be in others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if sent is None else np.frombuffer(sent.value, dtype=np.uint8)
        for batch in kernel.slices(batches, 2):
            rows, keys = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                own = [k for k in set(_keys(text or b"", least)) if k is not None]
                rows += [i] * len(own)
                keys += own
            if not keys:
                continue
            h = _hashes(keys)
            on = np.arange(len(keys))
            if table is not None:
                on = np.flatnonzero(_held(table, _positions(h) + (_segments(h, segments) << np.uint64(_SEGMENT_BITS))))
            at = pa.array(np.array(rows, dtype=np.int64)[on])
            digests = pa.array([_digest(keys[i]) for i in on], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(h[on].view(np.int64)), digests], _NAMES)

    return run


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (segment, kind, bits, id, t, h, digest), each segment's bits before its hashes: the hashes that are in them."""
    now, table = None, None
    for batch in batches:
        segment = batch.column(0).to_numpy()
        kind = batch.column(1).to_numpy()
        cuts = np.flatnonzero((segment[1:] != segment[:-1]) | (kind[1:] == 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(segment)], strict=True):
            if kind[a] == 0:
                now, table = segment[a], np.frombuffer(batch.column(2)[a].as_py(), dtype=np.uint8)
                a += 1
            if a < b and now == segment[a]:  # a segment without bits has no key seen twice
                h = batch.column(5).slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                on = pa.array(np.flatnonzero(_held(table, _positions(h))) + a)
                if len(on):
                    yield pa.RecordBatch.from_arrays([batch.column(c).take(on) for c in range(3, 7)], _NAMES)


def _routed(hashes: DataFrame, twice: DataFrame, segments: int, schema: str, rows: int) -> DataFrame:
    """``hashes(id, t, h, d)`` that the twice-seen filter holds, checked where the filter's segments are."""
    upper = F.shiftrightunsigned("h", 32)
    dealt = hashes.withColumn("segment", F.shiftrightunsigned(upper * F.lit(segments), 32))
    hot = dealt.groupBy("segment").count().where(F.col("count") > rows).select("segment", F.ceil(F.col("count") / rows).alias("copies"))
    copies = F.coalesce("copies", F.lit(1).cast("long"))
    dealt = dealt.join(hot, "segment", "left").withColumn("copy", F.pmod(F.xxhash64("id", "t", "h"), copies))
    tables = twice.join(hot, "segment", "left").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    nothing = [F.lit(None).cast(k).alias(n) for n, k in (x.split(" ", 1) for x in schema.split(", "))]
    both = tables.select("segment", "copy", F.lit(0).alias("kind"), "bits", *nothing).union(dealt.select("segment", "copy", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("bits"), *_NAMES))
    both = both.repartition("segment", "copy").sortWithinPartitions("segment", "copy", "kind")
    return both.select("segment", "kind", "bits", *_NAMES).mapInArrow(_check, schema)


def repeated_keys(rows: DataFrame, scratch: Scratch, kind: str, least: int, documents: int, max_filter_bytes: int, segment_rows: int) -> tuple[DataFrame, DataFrame]:
    """``rows(id, t, text)`` -> the suspects (id, t, h, d), and (h, d, keeper) of the keys in enough documents."""
    spark = rows.sparkSession
    text = F.col("text").cast("binary")
    # an upper bound of the number of keys, without Python: each is 20 bytes at least and has a line of its own
    breaks = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    n = rows.agg(F.sum(F.least(F.length(text) / least + 1, breaks))).first()[0]
    segments = max(1, int(np.ceil((n or 0) * BITS_PER_KEY / (1 << _SEGMENT_BITS))))
    marks = rows.select(text.alias("t")).mapInArrow(_marks(least, segments), "segment long, once binary, twice binary")
    merged = marks.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge, "segment long, bits binary")
    schema = f"id {kind}, t string, h long, d binary"
    per = (1 << _SEGMENT_BITS) // 8
    source = rows.select("id", "t", text.alias("text"))
    if segments * per <= max_filter_bytes:
        table = bytearray(segments * per)
        for row in merged.toLocalIterator():  # at most max_filter_bytes in all
            table[row.segment * per : (row.segment + 1) * per] = row.bits
        found = source.mapInArrow(_suspects(least, segments, spark.sparkContext.broadcast(bytes(table))), schema)
    else:
        hashes = scratch.table(source.mapInArrow(_suspects(least, segments, None), schema), "hashes")
        found = _routed(hashes, scratch.table(merged, "twice"), segments, schema, segment_rows)
    suspects = scratch.table(found, "suspects")
    counts = suspects.groupBy("h", "d").agg(F.countDistinct("id").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= documents)
    # a table of its own: the join can then split a key that very many documents hold
    return suspects, scratch.table(counts.select("h", "d", "keeper"), "repeated")


def _drop(least: int, at: int, names: list[str], kept_by=None, gone_of=None, skip=None):
    """Rows (columns, id, x, text, digests that go) without repeated lines.

    ``kept_by``: a broadcast of (hashes in order, digests, keepers) of all
    repeated keys, else each row has its list. Rows whose x ``skip`` may hold are
    left to another pass.
    """

    def gone_lines(texts: list, ids: pa.Array) -> Iterator[set]:
        """For each text the numbers of the lines that go."""
        h, digests, keepers = kept_by.value
        every, owner, line = [], [], []
        for i, text in enumerate(texts):
            for j, key in enumerate(_keys(text or b"", least)):
                if key is not None:
                    every.append(key)
                    owner.append(i)
                    line.append(j)
        out: list[set] = [set() for _ in texts]
        if every and len(h):
            own = _hashes(every).view(np.int64)
            place = np.searchsorted(h, own)
            hit = np.flatnonzero(h[np.minimum(place, len(h) - 1)] == own)
            for k in hit:
                d = _digest(every[k])
                p = place[k]
                while p < len(h) and h[p] == own[k]:  # keys of one hash stand beside each other
                    if digests[p].as_py() == d and ids[owner[k]].as_py() != keepers[p].as_py():
                        out[owner[k]].add(line[k])
                    p += 1
        return iter(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(batches, at + 2):
            if skip is not None:
                batch = batch.filter(pa.array(~bloom.lookup(skip[0].value, skip[1], batch.column(at + 1).to_numpy(zero_copy_only=False))))
            texts = batch.column(at + 2).to_pylist()
            if kept_by is not None:
                gone = gone_lines(texts, batch.column(at))
            else:
                lists = batch.column(at + 3).to_pylist() if gone_of else [None] * len(texts)
                gone = ({j for j, k in enumerate(_keys(t or b"", least)) if k is not None and _digest(k) in set_of} if set_of else set() for t, set_of in zip(texts, (set(x or ()) for x in lists), strict=True))
            kept, before, after = [], [], []
            for text, out in zip(texts, gone, strict=True):
                lines = (text or b"").split(b"\n")
                before.append(len(lines))
                after.append(len(out))
                kept.append(b"\n".join(x for j, x in enumerate(lines) if j not in out) if out else text or b"")
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(kept, pa.binary()), pa.array(before, pa.int64()), pa.array(after, pa.int64())], names)

    return run


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 20,
    documents: int = 3,
    max_filter_bytes: int = MAX_FILTER_BYTES,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """``docs`` with ``text_col`` without repeated lines, and the columns ``n_lines`` (before) and ``n_dropped``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    given = Columns(docs)
    kind = given.kind(id_col)
    name, text = given[id_col], given[text_col]
    # rows without an id are told apart by their texts
    whole = F.when(name.isNull(), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    rows = given.frame.select(name.alias("id"), whole.alias("t"), text.alias("text"))
    suspects, repeated = repeated_keys(rows, scratch, kind, least, documents, max_filter_bytes, segment_rows)
    kept = given.kept([text_col, "n_lines", "n_dropped"])
    names = [*(f"in{i}" for i in kept), "text", "n_lines", "n_dropped"]
    schema = ", ".join([*(f"in{i} {given.kinds[i]}" for i in kept), "text binary", "n_lines long", "n_dropped long"])
    columns = [F.col(f"in{i}") for i in kept]
    x = F.xxhash64(name, whole)
    frame = given.frame.select(*columns, name.alias("id"), x.alias("x"), text.cast("binary").alias("text"))
    n = repeated.count()
    if n * 64 <= max_filter_bytes:
        table = repeated.orderBy("h").toArrow().combine_chunks()  # at most max_filter_bytes
        sent = spark.sparkContext.broadcast(tuple(_whole(table.column(c)) if c else _whole(table.column(c)).to_numpy() for c in range(3)))
        out = frame.mapInArrow(_drop(least, len(kept), names, kept_by=sent), schema)
    else:
        gone = suspects.join(repeated.select("d", "keeper"), "d").where("id is null or id <> keeper")
        gone = scratch.table(gone.groupBy("id", "t").agg(F.collect_set("d").alias("gone")), "gone")
        few = bloom.Bloom(gone.select(F.xxhash64("id", "t").alias("x")), max_filter_bytes)
        rest = frame.mapInArrow(_drop(least, len(kept), names, skip=(few.sent, few.bits)), schema)
        # only documents that lose lines move, and the few that the filter takes for such
        some = given.frame.select(x.alias("x"), *columns, name.alias("id"), whole.alias("t"), text.cast("binary").alias("text"))
        some = bloom.filtered(some, few, ", ".join(["x long", *(f"in{i} {given.kinds[i]}" for i in kept), f"id {kind}", "t string", "text binary"]))
        what = gone.select(F.col("id").alias("id2"), F.col("t").alias("t2"), "gone")
        some = some.join(what, F.col("id").eqNullSafe(F.col("id2")) & F.col("t").eqNullSafe(F.col("t2")), "left").select(*columns, "id", "x", "text", "gone")
        out = rest.union(some.mapInArrow(_drop(least, len(kept), names, gone_of=True), schema))
    final = [*(given.names[i] for i in kept), text_col, "n_lines", "n_dropped"]
    return out.withColumn("text", F.col("text").cast("string")).toDF(*final)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def op6(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP6_SQL = r"""
with lines as (
  select doc_id, i, line, lower_ascii as key from (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as i
    from documents) l,
  lateral (select translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_ascii) k),
repeated as (
  select key, max(doc_id) as keeper from lines where length(key) >= 20
  group by key having count(distinct doc_id) >= 3),
marked as (
  select l.doc_id, l.i, l.line, r.key is not null and l.doc_id <> r.keeper as gone
  from lines l left join repeated r on l.key = r.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""
