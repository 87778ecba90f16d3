"""Passage operators, archives and the pipeline against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillmark.llm import passages, substring_dedup, suffix_dedup, warc
from quillmark.llm.storage import Scratch

from .test_text_operators import edge, passage, plain_common, plain_components, plain_contained, plain_fp, plain_lines, plain_rules, table


def plain_repeats(docs, words):
    seen = {}
    for i, t in docs:
        w = (t or "").encode().split()
        for p in range(len(w) - words + 1):
            seen.setdefault(tuple(w[p : p + words]), set()).add(i)
    return {i for v in seen.values() if len(v) > 1 for i in v}


@pytest.fixture(scope="module")
def mixed(spark):
    r = random.Random(7)
    docs, near, clean = [], set(), set()
    shared = passage(70, 1)
    for i in range(60):
        docs.append((i, f"{passage(r.randrange(5, 90), 1000 + i)} {shared} {passage(r.randrange(5, 90), 2000 + i)}"))
    for k in range(30):
        w = passage(90, 100 + k).split()
        v = list(w)
        v[40 + k % 10] = "edited"
        docs += [(100 + 2 * k, f"{passage(200, 3000 + k)} {' '.join(w)}"), (101 + 2 * k, f"{' '.join(v)} {passage(60, 4000 + k)}")]
        near |= {100 + 2 * k, 101 + 2 * k}
    for k in range(40):
        docs.append((300 + k, passage(150, 5000 + k)))
        clean.add(300 + k)
    docs += [(400, passage(400, 9)), (401, passage(400, 9)), (402, passage(60, 11) + " " + passage(60, 11))]
    rows = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    both = rows.union(edge(spark).withColumn("doc_id", F.col("doc_id") + 1000)).withColumn("key", F.lit(1)).withColumn("pos", F.lit(1))
    return both, docs, near, clean


def test_suffixes_against_brute_force(spark, mixed):
    df, docs, _, clean = mixed
    rows = suffix_dedup.repeated_passages(df).collect()
    got = {r.doc_id for r in rows}
    assert plain_repeats(docs, 50) <= got <= plain_repeats(docs, 41) and not got & clean and 402 not in got
    texts = {i: t.split() for i, t in docs}
    for r in rows:
        assert texts[r.doc_id][r.start_word : r.start_word + r.n_words] == texts[r.other_id][r.other_word : r.other_word + r.n_words] and r.doc_id != r.other_id


def test_near_passages(spark, mixed):
    df, docs, near, clean = mixed
    rows = substring_dedup.near_passages(df).collect()
    got = {r.doc_id for r in rows}
    assert plain_repeats(docs, 50) | near <= got and not got & clean and 402 not in got
    words = {i: re.findall(r"[^\W_]+", (t or "").lower()) for i, t in docs}
    for r in rows:  # places, lengths, partner and similarity are what they say
        a, b = words[r.doc_id][r.start_word : r.start_word + r.n_words], words[r.other_id][r.other_word : r.other_word + r.other_words]
        x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
        assert len(a) == r.n_words >= 50 and len(b) == r.other_words >= 50 and r.doc_id != r.other_id
        assert abs(len(x & y) / len(x | y) - r.similarity) < 1e-9 and r.similarity >= 0.8
    both = {(r.doc_id, r.start_word, r.other_id, r.other_word) for r in rows}
    assert both == {(b, j, a, i) for a, i, b, j in both}


def test_an_edit_at_every_word(spark):
    """Passages alike by the definition are found wherever they differ; 12 bands, so that none is missed by chance."""
    docs, want = [], set()
    for n in (50, 60):
        for k in range(n):
            w = passage(n, 100 * n + k).split()
            v = [*w[:k], "edited", *w[k + 1 :]]
            a, b = ({tuple(x[i : i + 5]) for i in range(n - 4)} for x in (w, v))
            i = 1000 * n + 2 * k
            docs += [(i, f"{passage(20, i)} {' '.join(w)} {passage(9, i + 1)}"), (i + 1, f"{passage(9, i + 2)} {' '.join(v)} {passage(20, i + 3)}")]
            if len(a & b) >= 0.8 * len(a | b):
                want |= {i, i + 1}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = substring_dedup.near_passages(df, bands=12).collect()
    assert want <= {r.doc_id for r in rows} and len(want) == 220
    assert all(r.similarity >= 0.8 and r.n_words >= 50 and r.doc_id ^ 1 == r.other_id for r in rows)


def test_alike_against_brute_force():
    r = random.Random(3)
    numbers = lambda n: [r.randrange(10**9) for _ in range(n)]
    tokens = lambda w: np.array([hash(tuple(w[i : i + 5])) & (1 << 63) - 1 for i in range(len(w) - 4)], dtype=np.uint64)

    def stretches(x):
        return [set(x[s:e].tolist()) for s in range(len(x)) for e in range(s + 46, len(x) + 1)]

    both = 0
    for _ in range(40):
        w = numbers(r.randrange(50, 55))
        v = list(w)
        for _ in range(r.randrange(1, 3)):
            k, how = r.randrange(len(v)), r.randrange(3)
            v[k : k + (how != 1)] = [-1 - r.randrange(99)] if how != 2 else []
        p, q = tokens(numbers(1) + w), tokens(v + numbers(1))
        want = any(len(a & b) >= 0.8 * len(a | b) for a in stretches(p) for b in stretches(q))
        assert bool(substring_dedup.alike(p, q, 46, 0.8)) == want
        both += want
    assert 5 < both < 40
    # the longest match of the other text is not always the one alike
    w = numbers(60)
    p, q = tokens(w), tokens(numbers(9) + w[:52] + numbers(80) + w[:28] + [-1] + w[29:] + numbers(9))
    assert [(s, e, j > 0.8) for s, e, _, _, j in substring_dedup.alike(p, q, 46, 0.8)] == [(0, 56, True)]


def test_compact_windows_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(100):
        sizes = rng.integers(0, 60, 4)
        low = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        high = np.maximum(low, low + sizes - rng.integers(0, 3, 4))
        v = rng.integers(0, 40, sizes.sum()).astype(np.uint64)
        t = int(rng.integers(1, 9))
        want = []
        for d in range(4):
            for c in range(low[d], high[d]):
                a = b = c
                while a > low[d] and v[a - 1] > v[c]:
                    a -= 1
                while b + 1 < high[d] and v[b + 1] >= v[c]:
                    b += 1
                if b - a + 1 >= t:
                    want.append((d, a, c, b))
        assert sorted(zip(*(x.tolist() for x in substring_dedup.compact_windows(v, low, high, t)), strict=True)) == sorted(want)
        # cut to one length: what starts in each node
        cut = [(max(a, c - t + 1), min(c, b - t + 1), c) for _, a, c, b in want]
        assert list(zip(*(x.tolist() for x in substring_dedup.windows_of_length(v, low, high, t)), strict=True)) == sorted(cut)


@pytest.mark.parametrize("step", [500_000, 3])
@pytest.mark.parametrize("to_first", [True, False])
def test_each_shared_key_gives_a_link(spark, monkeypatch, step, to_first):
    """Whatever the ranges and steps, a row has a link if and only if another document has its key, and links connect all documents of a key."""
    import pyarrow as pa

    monkeypatch.setattr(passages, "_STEP", step)
    r = random.Random(step)
    for _ in range(60):
        rows = sorted({(r.randrange(4), r.randrange(2), r.randrange(5), r.randrange(6)) for _ in range(r.randrange(1, 50))})
        cuts = sorted(r.sample(range(len(rows) + 1), min(3, len(rows))))
        found, ends, pairs = set(), set(), set()
        key_of = {(d, p): k for k, _, d, p in rows}
        rows = [x for x in rows if key_of[x[2], x[3]] == x[0]]  # a place has one key
        cuts = [min(c, len(rows)) for c in cuts]

        def run(part):
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32())
            batches = [pa.RecordBatch.from_arrays([*(pa.array([x[c] for x in part[i : i + 2]], t) for c, t in enumerate(kinds)), pa.array([0] * len(part[i : i + 2]), pa.int32())], ["key", "ord", "id", "pos", "ext"]) for i in range(0, len(part), 2)]
            for b in passages._link(to_first)(iter(batches)):
                for e, key, order, a, ap, _, other, op, _ in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if e:
                        ends.add((key, order, a, ap))
                    else:
                        key = key_of[a, ap]
                        found.add((key, a, ap))
                        pairs.add((key, a, other))
                        assert a != other and any(x[0] == key and x[2] == other and x[3] == op for x in rows)

        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            run(rows[a:b])
        few = sorted(ends)
        for k in {x[0] for x in few}:
            run([x for x in few if x[0] == k])
        want = {(k, d, p) for k, _, d, p in rows if any(x[0] == k and x[2] != d for x in rows)}
        assert found == want
        for k in range(4):
            docs = {d for key, d, _ in want if key == k}
            tops = {d: d for d in docs}
            for _ in docs:
                for key, x, y in pairs:
                    if key == k:
                        tops[x] = tops[y] = min(tops[x], tops[y])
            assert len(set(tops.values())) <= 1


def test_one_hot_passage_over_many_ranges(spark, monkeypatch):
    """Every document is linked, and all of them with each other, wherever the ranges cut the passage's keys."""
    monkeypatch.setattr(passages, "RANGE_ROWS", 40)
    hot = passage(50, 1)
    docs = [(i, f"{passage(6, 1000 + i)} {hot} {passage(6, 2000 + i)}") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for find in (substring_dedup.near_passages, suffix_dedup.repeated_passages):
        rows = find(df).collect()
        assert {r.doc_id for r in rows} == set(range(400)) and len(rows) < 1700
        tops = list(range(400))
        for _ in range(400):
            before = list(tops)
            for r in rows:
                tops[r.doc_id] = tops[r.other_id] = min(tops[r.doc_id], tops[r.other_id])
            if tops == before:
                break
        assert set(tops) == {0}
        assert all(r.n_words >= 50 for r in rows)


def test_links_past_an_unlike_document(spark):
    """Pairs of documents share a passage of which a third one, that comes before them, holds two thirds."""
    docs = []
    for k in range(300):
        w = passage(60, 100 + k).split()
        docs += [(3 * k, f"{passage(30, 5000 + k)} {' '.join(w[:40])} {passage(30, 6000 + k)}")]
        docs += [(3 * k + i, f"{passage(20, 7000 + 2 * k + i)} {' '.join(w)} {passage(20, 9000 + 2 * k + i)}") for i in (1, 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for find in (substring_dedup.near_passages, suffix_dedup.repeated_passages):
        rows = [r for r in find(df).collect() if r.n_words >= 50]
        assert {r.doc_id for r in rows} == {i for i, _ in docs if i % 3} and all(r.doc_id // 3 == r.other_id // 3 and r.n_words >= 60 for r in rows)


def test_recall_against_all_pairs(spark):
    """Passages of random lengths with random edits: what brute force takes for alike is found, nearly always at 0.8 and surely at 1."""
    r = random.Random(11)
    docs, pairs = [], []
    for k in range(240):
        w = passage(r.randrange(55, 120), 100 + k).split()
        v = list(w)
        for _ in range(r.randrange(0, 5)):
            v[r.randrange(len(v))] = f"edit{r.randrange(10**6)}"
        a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (w, v))
        docs += [(2 * k, f"{passage(40, 3000 + k)} {' '.join(w)} {passage(40, 4000 + k)}"), (2 * k + 1, f"{passage(30, 5000 + k)} {' '.join(v)} {passage(30, 6000 + k)}")]
        pairs.append((len(a & b) / len(a | b), 2 * k))
    got = {(r.doc_id, r.other_id) for r in substring_dedup.near_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(abs(a - b) == 1 and min(a, b) % 2 == 0 for a, b in got)
    for low, high, least in ((0.8, 0.9, 0.93), (0.9, 1.0, 0.97), (1.0, 1.1, 1.0)):
        of = [i for s, i in pairs if low <= s < high]
        share = sum((i, i + 1) in got and (i + 1, i) in got for i in of) / len(of)
        print(f"recall of passages alike by {low} to {high}: {share:.3f} of {len(of)}")
        assert share >= least and len(of) >= 12


def test_no_link_between_classes_is_lost(spark):
    """All pairs alike by 0.8 to 0.85 are found with one band too, and classes are those of brute force; short repeats aren't passages."""
    docs, n = [], 56
    for k in range(400):
        w = passage(n, 100 + k).split()
        v = [*w[: 20 + k % 17], "edited", *w[21 + k % 17 :]]
        docs += [(2 * k, f"{passage(20, 3000 + k)} {' '.join(w)} {passage(20, 4000 + k)}"), (2 * k + 1, f"{passage(20, 5000 + k)} {' '.join(v)} {passage(20, 6000 + k)}")]
    docs += [(900 + i, passage(60, 9)) for i in range(3)] + [(910, "la " * 300), (911, "la " * 20), (912, passage(100, 8))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for bands in (1, 3):
        got = {r.doc_id: r for r in substring_dedup.passage_classes(df, bands=bands).collect()}
        assert {i: r.class_id for i, r in got.items()} == {**{i: i & ~1 for i in range(800)}, 900: 900, 901: 900, 902: 900}
        assert all(p.n_words >= 50 and p.other_words >= 50 and p.similarity >= 0.8 for r in got.values() for p in r.passages)


def test_stretches_are_verified_from_either_side():
    p = np.arange(68, dtype=np.uint64)
    new = np.arange(1000, 1166, dtype=np.uint64)
    q = np.concatenate((new[:65], p[1:8], new[65:70], p[13:35], new[70:75], p[41:63], new[75:115]))
    for (a, x), (b, y) in (((1, p), (2, q)), ((1, q), (2, p))):
        batch = pa.RecordBatch.from_arrays([pa.array([a]), pa.array([b]), pa.array([0], pa.int32()), pa.array([x.tobytes()]), pa.array([0], pa.int32()), pa.array([y.tobytes()])], ["a", "b", "a_s", "a_t", "b_s", "b_t"])
        rows = [r for out in substring_dedup._verify_stretches(50, 5, 0.8)(iter([batch])) for r in out.to_pylist()]
        assert {(r["id"], r["other_id"]) for r in rows} == {(1, 2), (2, 1)}


def test_close_stretches_against_brute_force():
    """Every stretch that is alike by its distinct tokens is inside one run."""
    from quillmark.llm import shared

    r = np.random.default_rng(5)
    lost = 0
    for size in (2, 4, 8, 30):
        sizes = r.integers(0, 40, 60)
        low = np.cumsum(sizes) - sizes
        h = r.integers(0, size, sizes.sum()).astype(np.uint64)
        hit = np.isin(h, np.flatnonzero(r.random(size) < 0.7))
        s, e, of = shared.close(h, hit, low, low + sizes, 6, 0.8)
        kept = np.zeros(len(h), dtype=bool)
        for i, j, k in zip(s, e, of, strict=True):
            assert low[k] <= i < j <= low[k] + sizes[k]
            kept[i:j] = True
        for a, n in zip(low, sizes, strict=True):
            for i in range(a, a + n - 5):
                for j in range(i + 6, a + n + 1):
                    if len(set(h[i:j][hit[i:j]])) >= 0.8 * len(set(h[i:j])):
                        assert any(x <= i and j <= y for x, y in zip(s, e, strict=True))
        lost += int((~kept).sum())
    assert lost > 100


def test_living_stretches_against_brute_force():
    """Every stretch of which enough distinct tokens are shared is inside a living one."""
    from quillmark.llm import shared

    rng = np.random.default_rng(4)
    for _ in range(300):
        sizes = rng.integers(0, 40, 3)
        low = np.cumsum(sizes) - sizes
        h = np.repeat(rng.integers(1, 30, sizes.sum()), rng.integers(1, 4, sizes.sum()))[: sizes.sum()].astype(np.uint64)
        table = rng.permutation(30)[: rng.integers(1, 30)]
        hit = np.isin(h, table)
        s, e, of = shared.stretches(h, hit, low, low + sizes, 6, 0.8)
        lives = {(int(d), int(p)) for i, j, d in zip(s, e, of, strict=True) for p in range(i, j)}
        for d in range(3):
            for i in range(low[d], low[d] + sizes[d]):
                for j in range(i + 6, low[d] + sizes[d] + 1):
                    part = set(h[i:j].tolist())
                    if len(part & set(table.tolist())) >= 0.8 * len(part):
                        assert all((d, p) in lives for p in range(i, j))


def test_matches_against_brute_force(spark, mixed):
    """Every place of a passage of 50 words is covered by a match, and matches can't be extended."""
    df, docs, _, _ = mixed
    rows = suffix_dedup.repeated_passages(df).collect()
    texts = {i: (t or "").encode().split() for i, t in docs}
    where = {}
    for i, w in texts.items():
        for p in range(len(w) - 49):
            where.setdefault(tuple(w[p : p + 50]), set()).add(i)
    for r in rows:
        x, y, i, j, n = texts[r.doc_id], texts[r.other_id], r.start_word, r.other_word, r.n_words
        x, y = ([w.decode() for w in z] for z in (x, y))
        assert x[i : i + n] == y[j : j + n] and n >= 41
        assert i == 0 or j == 0 or x[i - 1] != y[j - 1]
        assert i + n == len(x) or j + n == len(y) or x[i + n] != y[j + n]
    for i, w in texts.items():
        for p in range(len(w) - 49):
            if len(where[tuple(w[p : p + 50])]) > 1:
                assert any(r.doc_id == i and r.start_word <= p + 9 and r.start_word + r.n_words >= p + 41 for r in rows)


def test_ids_of_any_type_and_empty_tables(spark, mixed):
    df, docs, _, _ = mixed
    some = df.where("doc_id < 140")
    named = some.withColumn("doc_id", F.concat(F.lit("doc "), F.col("doc_id").cast("string")))
    for find in (substring_dedup.near_passages, suffix_dedup.repeated_passages):
        got = find(named).collect()
        assert {r.doc_id for r in got} == {f"doc {r.doc_id}" for r in find(some).collect()} and all(isinstance(r.other_id, str) for r in got)
        assert find(df.limit(0)).count() == 0 and find(df.where("doc_id = 301")).count() == 0


# --- op 8 ---------------------------------------------------------------------------------------------------------


def test_archives(spark):
    r = random.Random(1)
    body = lambda n, seed: passage(n, seed)
    pages = [(i, f"http://h/{i}", body(r.randrange(1, 900), i)) for i in range(60)]
    pages += [(100 + i, "http://a b/\n", body(300, 500)) for i in range(9)] + [(200, None, None), (201, "u", ""), (202, "u", "é" * 500), (203, "u", "é" * 500), (204, "u", "short"), (205, "u", "short")]
    pages += [(300, "u", body(300, 501)), (300, "u", body(300, 501)), (None, "u", body(300, 500)), (301, "big", "".join(chr(r.randrange(32, 127)) for _ in range(400_000)))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("size", F.lit(1)).withColumn("keeper", F.lit(1))
    scratch = Scratch(spark, "warc-test")
    files = warc.write(df.repartition(3), f"{scratch.path}/a", scratch)
    whole = None
    for size in (warc.RANGE_BYTES, 50_000, 777):
        rows = sorted((r.record_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to or "") for r in warc.read(files, size).collect())
        whole = whole or rows
        assert rows == whole  # each record once, whatever the ranges
    best = {}
    for i, _, t in pages:
        if len((t or "").encode()) >= 1000 and i is not None:
            best[t] = max(best.get(t, i), i)
    want = []
    for i, _, t in pages:
        b = (t or "").encode()
        kind = "revisit" if t in best and best[t] != i else "response"
        want.append((f"<urn:x-page:{i}>", kind, len(b), hashlib.sha1(b).hexdigest(), f"<urn:x-page:{best[t]}>" if kind == "revisit" else ""))
    assert whole == sorted(want)
    listed = warc.list_archives(spark, f"{scratch.path}/a")
    assert warc.read(listed).where("record_type = 'response'").where(F.sha1("payload") != F.col("payload_digest")).count() == 0
    assert warc.read(warc.write(df.limit(0), f"{scratch.path}/b", Scratch(spark, "none"))).count() == 0


def test_other_bytes_between_members(spark, tmp_path):
    good = [warc.record(i, "u", 3, hashlib.sha1(b"abc").hexdigest(), b"abc") for i in range(5)]
    import gzip

    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"\x1f\x8b\x08 junk" + good[0] + b"\x1f\x8b\x08\x00" + good[1] + gzip.compress(b"no record") + b"".join(good[2:]))
    files = warc.list_archives(spark, str(path))
    for size in (1 << 20, 64):
        assert sorted(r.record_id for r in warc.read(files, size).collect()) == [f"<urn:x-page:{i}>" for i in range(5)]


def test_each_range_is_a_task(spark, tmp_path):
    r = random.Random(2)
    df = spark.createDataFrame([(i, "u", "".join(chr(r.randrange(33, 127)) for _ in range(2000))) for i in range(200)], "page_id long, url string, html string")
    scratch = Scratch(spark, "ranges")
    files = warc.write(df.repartition(4), f"{scratch.path}/a", scratch)
    n = sum(-(-r.length // 5000) for r in files.collect())
    got = warc.read(files, 5000, with_payload=False).withColumn("task", F.spark_partition_id())
    assert got.rdd.getNumPartitions() == n > 40
    assert got.count() == 200 and got.select("task").distinct().count() > 30


def test_members_of_several_records_and_damaged_ones(spark, tmp_path):
    import gzip

    def plain(i, body=b"abc", length=None, version=b"WARC/1.1"):
        head = b"%s\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x-page:%d>\r\nContent-Length: %s\r\n\r\n" % (version, i, length or b"%d" % len(body))
        return head + body + b"\r\n\r\n"

    rng = random.Random(3)
    big = bytes(rng.randrange(256) for _ in range(3 << 20))
    many = gzip.compress(b"".join(plain(i, bytes([65 + i]) * i) for i in range(20)))
    torn = bytearray(gzip.compress(plain(30, big)))
    torn[len(torn) // 2] ^= 255  # its checksum, or a block, is wrong
    cut = gzip.compress(plain(40) + plain(41, b"x" * 500))[:-30]
    parts = [many, bytes(torn), gzip.compress(plain(50)), gzip.compress(plain(51) + plain(52, length=b"many")), gzip.compress(plain(53, b"zz", b"99999")), gzip.compress(plain(60, big)), cut, gzip.compress(plain(70)), b"\x1f\x8b\x08"]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"".join(parts))
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    starts = [sum(map(len, parts[:i])) for i in range(len(parts))]
    for size in (warc.RANGE_BYTES, 1 << 18):
        for payload in (True, False):
            rows = warc.read(warc.list_archives(spark, str(tmp_path)), size, payload).collect()
            good = {int(r.record_id.split(":")[2][:-1]): r for r in rows if r.error is None}
            assert {*range(20), 50, 51, 60, 70} <= set(good) <= {*range(20), 30, 40, 41, 50, 51, 60, 70}
            assert [good[i].payload_bytes for i in range(20)] == list(range(20)) and [good[i].in_member for i in range(20)] == list(range(20))
            assert good[60].payload_digest == hashlib.sha1(big).hexdigest() and (not payload or bytes(good[60].payload) == big)
            assert {r.offset for r in rows if r.error} == {starts[1], starts[3], starts[4], starts[6]}


# --- pipeline -----------------------------------------------------------------------------------------------------


def test_pipeline_against_brute_force(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    P = pytest.importorskip("public_tokenizers")
    import base64

    import tiktoken

    item = passage(30, 77)
    line = "a common footer line that many documents carry today"
    texts = [passage(80, i) for i in range(40)] + [passage(80, 3)] * 3 + [f"{passage(80, 50 + i)}\n{line}" for i in range(6)]
    texts += [f"{passage(80, 60 + i)}\nThis line stands in three documents, on one host" for i in range(3)] + [f"{line}\n{passage(8, 70)}\n{line}"]
    texts += [f"{passage(60, 90)} {item}", "too short", passage(40, 91) + " " + passage(40, 91), passage(200, 95), passage(200, 95).replace(" ", "  ", 3)]
    df = table(spark, texts).union(edge(spark).withColumn("doc_id", F.col("doc_id") + 500)).withColumn("kept", F.lit("x")).withColumn("N_LINES", F.lit(1)).withColumn("c0", F.lit(2))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in pipeline.run(spark, str(tmp_path)).collect()}

    every = df.distinct().collect()
    common = plain_common([(r.text, r.source) for r in every])
    rows = []
    for r in every:
        _, words, clean = common[r.text, r.source]
        n, failed = plain_rules(r.text)[0], plain_rules(r.text)[-1]
        if not failed and n - words >= 10 and n - words >= 0.3 * n:
            rows.append((r.doc_id, clean))
    assert any(clean != r.text for r in every for clean in [common[r.text, r.source][2]])
    rows = [(i, t.decode()) for i, _, _, t in plain_lines(rows)]
    ids = [i for i, _ in rows]
    assert len(ids) == len(set(ids)) and None not in ids
    tops = plain_components({i: plain_fp(t) for i, t in rows})
    rows = [(i, t) for i, t in rows if tops[i] == i]
    leaks = {i for i, *_ in plain_contained(rows, [(1, item)])}
    rows = {i: t for i, t in rows if i not in leaks}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {i: r.ids for i, r in got.items()} == {i: encoding.encode_ordinary(t) for i, t in rows.items()}
    assert all(r.decoded_sha256 == hashlib.sha256(rows[i].encode()).hexdigest() for i, r in got.items())
    assert leaks and not re.search(line, "".join(rows.values())) and "".join(rows.values()).count("stands in three documents") == 1


def test_pipeline_over_an_empty_table(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    df = table(spark, [])
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage(30, 77))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = df
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns and [f.dataType for f in docs.schema.fields] == [f.dataType for f in df.schema.fields] and docs.count() == 0
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_stage_with_repeated_ids(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(1, passage(40, 1)), (1, passage(40, 1)), (2, passage(40, 1)), (None, passage(40, 2)), (None, passage(40, 2)), (3, passage(40, 3)), (3, passage(40, 4))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.lit(1))
    got = sorted((r.doc_id or 0, r.text) for r in pipeline.near_stage(spark, df, "").collect())
    assert [i for i, _ in got] == [0, 1, 3] and got[0][1] == passage(40, 2)


def test_near_stage_keeps_the_same_row_of_ties(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(1, passage(40, 1), n) for n in (5, 3, 4)] + [(None, passage(40, 2), n) for n in (9, 8)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string, n_chars int").repartition(3)
        assert sorted(r.n_chars for r in pipeline.near_stage(spark, df, "").collect()) == [3, 8]


def test_near_stage_decides_each_row_without_an_id(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    # copies of documents with an id go, one of each group of rows without an id stays
    rows = [(1, passage(40, 1)), (None, passage(40, 1)), (None, passage(40, 2)), (None, passage(40, 2).upper()), (None, passage(40, 5)), (4, passage(40, 1)), (4, passage(40, 6))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text.lower()) for r in pipeline.near_stage(spark, df, "").collect())
    assert got == sorted([(0, passage(40, 2)), (0, passage(40, 5)), (1, passage(40, 1)), (4, passage(40, 6))])
