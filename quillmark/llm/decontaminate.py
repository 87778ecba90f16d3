"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are short and documents long, so their Jaccard similarity is small even
where an item lies whole in a document, and a sketch of the document would need
as many bins as it has shingles. The sketch is therefore the item's: the ``least``
of its shingles by hash, a bottom-k MinHash, estimates which share of the item a
document holds when they are looked up among the document's shingles.

Items are parted by size, in powers of two. For each size the number of minima
and how many of them a document must hold follow from the hypergeometric
distribution, so that a pair at the threshold is missed with a chance of ``MISS``
at most; items of up to ``least`` shingles are kept whole and nothing is missed.
A part is only searched in documents large enough for it, and only with shingles
up to the part's largest minimum: the longer the items, the fewer. Shingles that
more than ``HOT`` items share are no minima as long as an item has others enough;
an item made of such shingles keeps as many of them as must be met exactly.

Pairs with enough minima are candidates. Their containment is counted over the
whole sets of shingles, by their words.

Words are lower-cased runs of letters and digits; shingles have five of them, and
a text of fewer words is one shingle, its whole sequence. So an item of one to
four words is found where it is the whole document, and not inside longer ones,
where it proves nothing. The index of up to ``index_chars`` of items, about four
bytes for each, is sent to all tasks, and pairs are found where documents are
read. Beyond that, minima and shingles are joined by hash.

Defined results: null and empty texts have no shingles; such documents are clean
and such items match nothing. Rows repeated give their pairs each. An empty table
on either side gives no pairs. Ids may be of any type, null included.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm import bloom, kernel
from quillmark.llm.native import Columns
from quillmark.llm.storage import Scratch, ship

WIDTH = 5
CONTAINMENT = 0.8
MISS = 1e-6
LEAST = 16
HOT = 64
INDEX_CHARS = 16 << 20
_EXPANDED = 2_000_000


class _Texts:
    """Words and shingles of a column of lower-cased texts."""

    def __init__(self, texts: pa.Array, width: int) -> None:
        self.width = width
        self.data, offsets = kernel.buffers(texts)
        self.starts, self.ends, self.first = kernel.word_spans(self.data, offsets, kernel.NOT_ALNUM, punctuation=True)
        words = kernel.word_hashes(self.data, self.starts, self.ends)
        h = kernel.shingle_hashes(words, width)
        low, high = kernel.runs(self.first, width)
        low, high = low.copy(), high.copy()
        n = np.diff(self.first)
        extra = [h]
        for k in range(1, width):  # whole sequences of k words
            short = np.flatnonzero(n == k)
            if len(short):
                low[short] = sum(map(len, extra)) + np.arange(len(short))
                high[short] = low[short] + 1
                extra.append(kernel.mix(kernel.shingle_hashes(words, k)[self.first[short]], 100 + k))
        self.h, self.low, self.high = np.concatenate(extra), low, high

    def shingle(self, text: int, at: int) -> bytes:
        """The words of the shingle at place ``at`` of ``h``, which belongs to ``text``."""
        begin, n = int(self.first[text]), int(self.first[text + 1] - self.first[text])
        i, n = (at, self.width) if n >= self.width else (begin, n)
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[i : i + n], self.ends[i : i + n], strict=True))

    def own(self, text: int) -> tuple[np.ndarray, np.ndarray]:
        """The text's distinct hashes in order, and a place of each."""
        a, b = int(self.low[text]), int(self.high[text])
        values, first = np.unique(self.h[a:b], return_index=True)
        return values, first + a


def _needed(n: int, containment: float) -> int:
    return max(1, ceil(containment * n - 1e-9))


@lru_cache(maxsize=100_000)
def sketch_plan(n: int, of: int, containment: float, least: int, miss: float) -> tuple[int, int]:
    """(minima, how many of them must be met) for an item of ``n`` shingles, of which ``of`` can be minima; (0, 0) if they don't suffice."""
    there = of - (n - _needed(n, containment))  # of these, a document with enough of the item has so many at least
    if there <= 0:
        return 0, 0

    def fewer(k: int, t: int) -> float:
        return sum(comb(there, i) * comb(of - there, k - i) for i in range(max(0, k - of + there), t) if k - i <= of - there) / comb(of, k)

    k = min(least, of)
    while fewer(k, 1) > miss:
        k += 1
    t = 1
    while t < k and fewer(k, t + 1) <= miss:
        t += 1
    return k, t


def minima(values: np.ndarray, shared_by: np.ndarray, containment: float, least: int, miss: float) -> tuple[np.ndarray, int]:
    """An item's minima out of its hashes in order, and how many of them must be met; ``shared_by``: in how many items each hash is."""
    rare = values[shared_by <= HOT]
    k, t = sketch_plan(len(values), len(rare), containment, least, miss)
    if k:
        return rare[:k], t
    # any so many of its shingles: one of them at least is in a document that has enough; the rarest
    k = len(values) - _needed(len(values), containment) + 1
    return values[np.argsort(shared_by, kind="stable")[:k]], 1


class _Index:
    """Items of different texts, parted by size."""

    def __init__(self, texts: list[bytes], width: int, containment: float, least: int, miss: float) -> None:
        self.texts, self.width, self.containment = texts, width, containment
        t = _Texts(pa.array(texts, pa.binary()), width)
        sets = [np.unique(t.h[a:b]) for a, b in zip(t.low, t.high, strict=True)]
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        every, of = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
        self.enough = np.zeros(len(sets), dtype=np.int64)
        by: dict[int, list] = {}
        for i, s in enumerate(sets):
            if len(s):
                low, self.enough[i] = minima(s, of[np.searchsorted(every, s)], containment, least, miss)
                by.setdefault(len(s).bit_length() - 1, []).append((i, low))
        self.parts = []
        for size, rows in sorted(by.items()):
            values = np.concatenate([low for _, low in rows])
            owner = np.repeat(np.array([i for i, _ in rows], dtype=np.int32), [len(low) for _, low in rows])
            order = np.argsort(values, kind="stable")
            self.parts.append((_needed(1 << size, containment), values[order], owner[order]))
        self.words: dict[int, dict[int, bytes]] = {}

    def item(self, i: int) -> dict[int, bytes]:
        """Hash to words of an item's shingles."""
        if i not in self.words:
            if len(self.words) > 10_000:
                self.words.clear()
            t = _Texts(pa.array([self.texts[i]], pa.binary()), self.width)
            self.words[i] = {int(h): t.shingle(0, int(p)) for h, p in zip(*t.own(0), strict=True)}
        return self.words[i]

    def candidates(self, t: _Texts) -> Iterator[tuple[int, int]]:
        """(text, item) with enough common minima, by text."""
        sizes = t.high - t.low
        found = []
        for needed, values, owner in self.parts:
            texts = np.flatnonzero(sizes >= needed)
            if not len(texts):
                continue
            doc = kernel.belongs(t.low[texts], t.high[texts], len(t.h))
            held = np.zeros(1 << 20, dtype=bool)
            held[(values >> np.uint64(44)).astype(np.int64)] = True
            on = np.flatnonzero((doc >= 0) & (t.h <= values[-1]) & held[(t.h >> np.uint64(44)).astype(np.int64)])
            v, d = t.h[on], texts[doc[on]]
            a = np.searchsorted(values, v, "left")
            on = np.flatnonzero(values[np.minimum(a, len(values) - 1)] == v)
            if not len(on):
                continue
            # each shingle of a text once
            d, v, a = d[on], v[on], a[on]
            _, once = np.unique(np.stack((d.astype(np.uint64), v)), axis=1, return_index=True)
            d, v, a = d[once], v[once], a[once]
            n = np.searchsorted(values, v, "right") - a
            total, at = np.cumsum(n), 0
            while at < len(d):
                to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _EXPANDED, "right")))
                to = int(np.searchsorted(d, d[to - 1], "right"))  # whole texts
                m = n[at:to]
                place = np.repeat(a[at:to] - np.cumsum(m) + m, m) + np.arange(m.sum())
                pair, hits = np.unique(np.repeat(d[at:to], m) * len(self.texts) + owner[place], return_counts=True)
                pair = pair[hits >= self.enough[pair % len(self.texts)]]
                found += zip((pair // len(self.texts)).tolist(), (pair % len(self.texts)).tolist(), strict=True)
                at = to
        return iter(sorted(found))

    def pairs(self, t: _Texts) -> Iterator[tuple[int, int, int]]:
        """(text, item, shared) for all items contained in a text."""
        last, places = -1, {}
        for d, i in self.candidates(t):
            if d != last:
                last, places = d, t.own(d)
            shared = common(t, d, places, self.item(i))
            if shared >= _needed(int(self.sizes[i]), self.containment):
                yield d, i, shared


def common(t: _Texts, text: int, places: tuple[np.ndarray, np.ndarray], wanted: dict[int, bytes]) -> int:
    """How many shingles of an item the text has, by their words."""
    values, at = places
    h = np.fromiter(wanted, dtype=np.uint64, count=len(wanted))
    i = np.minimum(np.searchsorted(values, h), len(values) - 1)
    return sum(t.shingle(text, int(at[p])) == wanted[int(x)] for x, p in zip(h[values[i] == h], i[values[i] == h], strict=True))


def _search(sent, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, of, ids = sent.value
        for batch in kernel.slices(batches, 1):
            rows = [(d, k, shared, int(index.sizes[i])) for d, i, shared in index.pairs(_Texts(batch.column(1), width)) for k in of[i]]
            if rows:
                docs, which, shared, size = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(docs)), ids.take(pa.array(which)), pa.array(shared, pa.int64()), pa.array(size, pa.int64())], ["id", "item", "n_shared", "n_item"])

    return run


def _sent(docs: DataFrame, items: DataFrame, schema: str, width: int, containment: float, least: int) -> DataFrame:
    """Pairs by an index in all tasks; ``items`` is known to be small."""
    table = items.toArrow()
    ids, texts = table.column(0).combine_chunks(), table.column(1).to_pylist()
    if isinstance(ids, pa.ChunkedArray):
        ids = pa.concat_arrays(ids.chunks) if ids.num_chunks else pa.nulls(0, ids.type)
    of: dict[bytes, list[int]] = {}
    for i, t in enumerate(texts):
        if t:
            of.setdefault(t, []).append(i)
    index = _Index(list(of), width, containment, least, MISS)
    return docs.mapInArrow(_search(docs.sparkSession.sparkContext.broadcast((index, list(of.values()), ids)), width), schema)


def _all_shingles(width: int):
    """(key, number of distinct shingles, hash) of each shingle of (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(batches, 1):
            t = _Texts(batch.column(1), width)
            sets = [np.unique(t.h[a:b]) for a, b in zip(t.low, t.high, strict=True)]
            n = np.array([len(s) for s in sets], dtype=np.int64)
            h = np.concatenate([*sets, np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(np.repeat(n, n)), pa.array(h.view(np.int64))], ["key", "n", "h"])

    return run


def _choose(containment: float, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, list, list] = [], [], []
            for i, found in enumerate(batch.column(1).to_pylist()):
                pairs = sorted((x["h"] & (1 << 64) - 1, x["by"]) for x in found)
                low, t = minima(np.array([h for h, _ in pairs], np.uint64), np.array([by for _, by in pairs]), containment, least, MISS)
                for out, more in zip(rows, ([i] * len(low), [t] * len(low), low.view(np.int64).tolist()), strict=True):
                    out += more
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64())], ["item_key", "enough", "h"])

    return run


def _count(width: int, containment: float):
    """Candidates (key, item key, text, item's text) to (key, item key, shared, size of the item)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.slices(batches, 2):
            t, items = _Texts(batch.column(2), width), _Texts(batch.column(3), width)
            rows = []
            for i in range(batch.num_rows):
                wanted = {int(h): items.shingle(i, int(p)) for h, p in zip(*items.own(i), strict=True)}
                shared = common(t, i, t.own(i), wanted)
                if shared >= _needed(len(wanted), containment):
                    rows.append((i, shared, len(wanted)))
            if rows:
                at, shared, size = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(shared, pa.int64()), pa.array(size, pa.int64())], ["key", "item_key", "n_shared", "n_item"])

    return run


def _joined(docs: DataFrame, items: DataFrame, width: int, containment: float, least: int) -> DataFrame:
    """Pairs by joins of hashes, for items of any number. Texts take part once, however often they come."""
    scratch = Scratch(docs.sparkSession, "contained")
    keyed = lambda df: df.withColumn("key", F.md5("t"))
    docs, items = keyed(docs), keyed(items)
    each = items.where("t is not null").select("key", "t").dropDuplicates(["key"])
    shingles = scratch.table(each.mapInArrow(_all_shingles(width), "key string, n long, h long"), "item-shingles")
    shared_by = shingles.groupBy("h").agg(F.count("*").alias("by"))
    sets = shingles.join(shared_by, "h").groupBy("key").agg(F.collect_list(F.struct("h", "by")).alias("found"))
    low = scratch.table(sets.mapInArrow(_choose(containment, least), "item_key string, enough long, h long"), "minima")
    sizes = shingles.select(F.col("key").alias("item_key"), "n").distinct()
    # of the documents' shingles, those that are some item's minimum, and a few others
    few = bloom.Bloom(low.select("h").distinct())
    texts = docs.where("t is not null").select("key", "t")
    hashes = texts.mapInArrow(_all_shingles(width), "key string, n long, h long").select("h", "key", "n")
    hashes = scratch.table(bloom.filtered(hashes, few, "h long, key string, n long").distinct(), "hashes")
    hits = hashes.withColumnRenamed("n", "of").join(low, "h").groupBy("key", "item_key", "enough", "of").agg(F.count("*").alias("hits")).where("hits >= enough")
    found = scratch.table(hits.join(sizes, "item_key").where(F.col("of") >= containment * F.col("n") - 1e-9).select("key", "item_key"), "candidates")
    held = bloom.Bloom(found.select(F.xxhash64("key").alias("x")).distinct())
    some = bloom.filtered(texts.select(F.xxhash64("key").alias("x"), "key", "t"), held, "x long, key string, t binary").drop("x").dropDuplicates(["key"])
    wanted = each.select(F.col("key").alias("item_key"), F.col("t").alias("item_t"))
    rows = found.join(some, "key").join(wanted, "item_key").select("key", "item_key", "t", "item_t")
    sure = scratch.table(rows.mapInArrow(_count(width, containment), "key string, item_key string, n_shared long, n_item long"), "pairs")
    names = items.select(F.col("key").alias("item_key"), "item")
    return sure.join(docs.select("key", "id"), "key").join(names, "item_key").select("id", "item", "n_shared", "n_item")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    containment: float = CONTAINMENT,
    width: int = WIDTH,
    least: int = LEAST,
    index_chars: int = INDEX_CHARS,
) -> DataFrame:
    """Pairs ``(id_col, item_id_col, n_shared, n_item)``: the document holds that share of the item's shingles or more."""
    ship(docs.sparkSession)
    a, b = Columns(docs), Columns(items)
    wanted = b.frame.select(b[item_id_col].alias("item"), F.lower(b[item_text_col]).cast("binary").alias("t"))
    frame = a.frame.select(a[id_col].alias("id"), F.lower(a[text_col]).cast("binary").alias("t"))
    total = wanted.agg(F.sum(F.length("t") + 16)).first()[0] or 0
    if total <= index_chars:
        out = _sent(frame, wanted, f"id {a.kind(id_col)}, item {b.kind(item_id_col)}, n_shared long, n_item long", width, containment, least)
    else:
        out = _joined(frame, wanted, width, containment, least)
    return out.toDF(id_col, item_id_col if item_id_col != id_col else f"item_{item_id_col}", "n_shared", "n_item")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without those that hold an item; each row goes by its own text, whatever others have its id.

    Of the texts only those that go, and a few that a Bloom filter takes for such, are shuffled.
    """
    given = Columns(docs)
    keys = [given[id_col], F.xxhash64(F.coalesce(given[text_col], F.lit("")))]
    rows = given.frame.select(F.struct(keys[0].alias("i"), keys[1].alias("t")).alias("row"), given[text_col].alias("text"))
    leaks = contained_items(rows, items, "row", **options).select("row.i", "row.t").distinct()
    leaks = Scratch(docs.sparkSession, "leaks").table(leaks, "rows")
    return bloom.without(given.frame, keys, leaks).toDF(*given.names)


def op2(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contained_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP2_SQL = r"""
with words as (
  select 'd' as side, doc_id as id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+') as w from documents
  union all select 'i', item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+') from benchmark),
shingles as (
  select distinct side, id, s from (
    select side, id, array_to_string(w[p:p + 4], ' ') as s from (select side, id, w, unnest(range(1, len(w) - 3)) as p from words)
    union all select side, id, array_to_string(w, ' ') || ' .' from words where len(w) between 1 and 4)),
sizes as (select id, count(*) as n_item from shingles where side = 'i' group by id),
shared as (
  select d.id as doc_id, i.id as item_id, count(*) as n_shared from shingles d join shingles i on d.s = i.s
  where d.side = 'd' and i.side = 'i' group by all)
select doc_id, item_id, n_shared, n_item from shared join sizes on sizes.id = item_id where n_shared >= 0.8 * n_item
"""
