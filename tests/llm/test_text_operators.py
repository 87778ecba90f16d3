"""Operators against brute force on small tables: defined results, nulls, ties, repeated rows, extra columns."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillmark.llm import bpe, chat_format, decontaminate, kernel, license_scan, line_dedup, quality_rules, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BASE = [f"word{i}" for i in range(400)]


def passage(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(BASE) for _ in range(n))


EDGE = [None, "", " \n\t", "one", "one two", "É é ÀB", "a\x0bb\x1cc", "x" * 300_000, "ab " * 40_000, "l\n" * 5000, "\x00nul", "tie tie", "tie tie"]


def table(spark, texts, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], schema)


def edge(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(EDGE)]
    return spark.createDataFrame([*rows, rows[4], rows[4], (None, "no id here", "en", "s", 1), (None, None, None, None, None)], SCHEMA)


# --- kernel -------------------------------------------------------------------------------------------------------


def test_xxh64():
    r = random.Random(1)
    data = bytes(r.randrange(256) for _ in range(3000))
    s = np.array([r.randrange(2000) for _ in range(1000)])
    e = s + np.array([r.choice([0, 1, 3, 4, 7, 8, 31, 32, 33, 64, 100]) for _ in s])
    assert [int(x) for x in kernel.xxh64(data, s, e)] == [xxhash.xxh64_intdigest(data[a:b], seed=42) for a, b in zip(s, e, strict=True)]


def test_word_hashes_depend_on_the_word_alone():
    import pyarrow as pa

    long = b"q" * (1 << 19)
    data, offsets = kernel.buffers(pa.array([b"ab cd", None, b"xx ab " + long, b"cd " + long + b" ab"], pa.binary()))
    starts, ends, first = kernel.word_spans(data, offsets)
    h = [int(x) for x in kernel.word_hashes(data, starts, ends)]
    assert first.tolist() == [0, 2, 2, 5, 8] and h[0] == h[3] == h[7] and h[1] == h[5] and h[4] == h[6] and len(set(h)) == 4


# --- op 9 ---------------------------------------------------------------------------------------------------------


def plain_fp(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    sh = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    ids = sorted(fps)
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in ids:
        for b in ids:
            if b < a and (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def test_simhash_against_brute_force(spark):
    texts = [passage(60, i) for i in range(30)]
    for i in range(30):
        w = texts[i].split()
        for k in range(3):
            texts.append(" ".join([*w[:k], "changed", *w[k + 1 :]]))
    texts += [None, "", texts[0], texts[0]]
    got = {r.doc_id: r for r in simhash.near_duplicates(table(spark, texts)).collect()}
    fps = {i: plain_fp(t) for i, t in enumerate(texts)}
    want = plain_components(fps)
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in got.items()} == want and len(set(want.values())) < len(want)


def test_all_close_fingerprints_link(spark):
    r = random.Random(4)
    nodes = set()
    for _ in range(150):
        x = r.getrandbits(64)
        nodes.add(x)
        for n in (1, 2, 3, 4):
            nodes.add(x ^ sum(1 << b for b in r.sample(range(64), n)))
    signed = [x - (1 << 64) if x >> 63 else x for x in nodes]
    from quillmark.llm.graph import components
    from quillmark.llm.storage import Scratch

    scratch = Scratch(spark, "test")
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for block in (4096, 2):  # with 2, nearly every anchor is compared in blocks
        roots = {r.node: r.root for r in components(simhash.near_links(df, scratch, block=block), scratch, f"c{block}").collect()}
        want = plain_components({x: x & (1 << 64) - 1 for x in signed})
        groups = lambda f: sorted(sorted(x for x in signed if f(x) == g) for g in {f(x) for x in signed})
        assert groups(lambda x: roots.get(x, x)) == groups(lambda x: want[x])


def test_components_of_long_chains(spark):
    from quillmark.llm.graph import components
    from quillmark.llm.storage import Scratch

    order = list(range(500))
    random.Random(2).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(299)] + [(order[i], order[i + 1]) for i in range(300, 499)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long").repartition(7), Scratch(spark, "chain")).collect()}
    assert {got.get(x, x) for x in order[:300]} == {min(order[:300])} and {got.get(x, x) for x in order[300:]} == {min(order[300:])}


# --- op 6 ---------------------------------------------------------------------------------------------------------


def plain_lines(rows):
    key = lambda x: x.strip(b" \t\n\x0b\x0c\r").lower()
    where = {}
    for i, t in rows:
        for x in (t or "").encode().split(b"\n"):
            if len(key(x).decode()) >= 20 and i is not None:
                where.setdefault(key(x), set()).add(i)
    gone = {k: max(v) for k, v in where.items() if len(v) >= 3}
    out = []
    for i, t in rows:
        lines = (t or "").encode().split(b"\n")
        kept = [x for x in lines if key(x) not in gone or gone[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), b"\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most, rows", [(line_dedup.MAX_FILTER_BYTES, 10**6), (1 << 17, 10**6), (1000, 3)])
def test_lines_against_brute_force(spark, most, rows):
    """Whether filters and keys are sent to all tasks or not, and with segments shared by several tasks."""
    common, other = "This line is in Very many documents ", "ÀÉ this one too, in three of them"
    texts = [f"{passage(5, i)}\n  {common}\t\nshort" for i in range(9)] + [f"{other}\n{other}\nx{i}" for i in range(3)] + ["only two documents hold this"] * 2
    texts += ["\n".join(passage(6, r % 70) for r in range(i, i + 40)) for i in range(90)]
    more = spark.createDataFrame([(None, f"{common}\nno id {i}", "en", "s", 1) for i in range(5)] + [(7, f"{common}\nagain", "en", "s", 1)], SCHEMA)
    df = table(spark, texts).union(edge(spark).withColumn("doc_id", F.col("doc_id") + 200)).union(more)
    plain = plain_lines([(r.doc_id, r.text) for r in df.collect()])
    out = line_dedup.dedup_lines(df.withColumn("N_lines", F.lit(0)).withColumn("gone", F.lit("x")).withColumn("id", F.array(F.lit(1))), max_filter_bytes=most, segment_rows=rows)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text.encode()) for r in out.collect()), key=repr)
    assert got == plain and sum(x[2] for x in got) > 1000 and {"gone", "id", "n_lines"} <= set(out.columns) and "N_lines" not in out.columns
    named = line_dedup.dedup_lines(df.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 9, "0"))), max_filter_bytes=most, segment_rows=rows)
    assert sorted((r.n_lines, r.n_dropped, r.text.encode()) for r in named.collect()) == sorted(x[1:] for x in plain)


def test_unaffected_texts_stay_where_they_are(spark):
    texts = [f"line number {i} stands in one document alone" for i in range(50)]
    plan = line_dedup.dedup_lines(table(spark, texts))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


# --- op 4 ---------------------------------------------------------------------------------------------------------


def plain_rules(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = {}
    for i in range(len(w) - 4):
        wins.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {p + k for v in wins.values() if len(v) > 1 for p in v for k in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_rules_against_brute_force(spark):
    texts = [passage(30, 1) + " " + passage(30, 1), passage(8, 2), "# a | b\n" * 4 + passage(40, 3), passage(50, 5) + "\n" + passage(50, 5)]
    df = table(spark, texts).union(edge(spark)).withColumn("h", F.lit(1)).withColumn("host", F.lit(2)).withColumn("kept", F.lit("x")).withColumn("n_words", F.lit(0))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = quality_rules.rules(df).collect()
    assert len(rows) == df.count() and all(tuple(r[n] for n in names) == plain_rules(r.text) for r in rows)


def test_common_lines_deplete(spark):
    common = "subscribe to our newsletter for all the latest news today now"
    rows = [(i, f"{common}\n{passage(4, i)}", "en", "a", 1) for i in range(130)]
    rows += [(200, f"{common}\n{passage(60, 7)}", "en", "a", 1), (201, f"{common}\n{passage(4, 8)}", "en", "b", 1)]
    copy = f"{passage(30, 9)}\n{passage(30, 10)}"
    rows += [(1000 + i, copy if i % 2 else f"{copy}\nedit {i % 7}", "en", "a", 1) for i in range(400)]
    got = {r.doc_id: r for r in quality_rules.rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not any(got[i].kept for i in range(130)) and got[200].kept and got[201].kept and got[200].n_common_words == 11
    assert all(got[1000 + i].kept for i in range(400))  # copies of one document don't make its lines common


def test_lines_of_documents_that_recombine_a_pool(spark):
    """Documents that share their lines with each other are still distinct documents."""
    pool = [passage(12, 50 + k) for k in range(20)]
    r = random.Random(6)
    rows = [(i, "\n".join(r.sample(pool, 10)), "en", "a", 1) for i in range(400)]
    got = quality_rules.rules(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(x.n_common_words == 120 and not x.kept for x in got)


def plain_common(rows, most=quality_rules.MAX_DOCUMENTS, least=quality_rules.MIN_DOCUMENTS, share=quality_rules.MAX_SHARE):
    """(text, host) -> numbers of its lines that are common on the host, and their words."""
    bare = lambda line: " ".join(re.findall(r"[^\x20\x09-\x0D]+", line.lower()))
    where, hosts = {}, {}
    for text, host in rows:
        for line in (text or "").split("\n"):
            if bare(line):
                where.setdefault((host, bare(line)), set()).add(text)
                hosts.setdefault(host, set()).add(text)
    common = {k for k, v in where.items() if len(v) > most or (len(v) >= least and len(v) > share * len(hosts[k[0]]))}
    out = {}
    for text, host in rows:
        lines = (text or "").split("\n")
        at = [i for i, line in enumerate(lines) if (host, bare(line)) in common]
        clean = "\n".join(line for i, line in enumerate(lines) if i not in at) if at else text
        out[text, host] = len(at), sum(len(bare(lines[i]).split(" ")) for i in at), clean
    return out


def test_common_lines_against_brute_force(spark):
    header, footer = passage(9, 400), passage(7, 401)
    rows = [(i, f"{header}\n{passage(30, 500 + i)}\n{passage(3, i % 40)}\n {footer.upper()} \t", "en", "big", 1) for i in range(500)]
    rows += [(1000 + i, "the same single line on all pages of a host, twelve words long", "en", "copies", 1) for i in range(120)]
    rows += [(2000 + i, f"Page {i}\n{footer}\n\n{passage(40, 900 + i)}", "en", None if i % 2 else "small", 1) for i in range(24)]
    rows += [(3000 + i, f"{header}\n{header}\nown {i}", "en", "stubs", 1) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).union(edge(spark)).withColumn("N_Words", F.lit("clash")).withColumn("h", F.lit(1)).withColumn("at", F.lit(2))
    for limits in ({}, {"max_documents": 7}, {"min_documents": 2, "max_share": 0.4}):
        got = quality_rules.rules(df, **limits).collect()
        want = plain_common([(r.text, r.source) for r in df.collect()], *(limits.get(k, d) for k, d in (("max_documents", 100), ("min_documents", 5), ("max_share", 0.1))))
        assert len(got) == df.count() and all((r.n_common_lines, r.n_common_words, r.clean_text) == want[r.text, r.source] for r in got)
        for r in got:
            rest = r.n_words - r.n_common_words
            assert r.kept == (not r.base_failed and rest >= 10 and rest >= 0.3 * r.n_words) and r.at == 2
    assert not any(r.kept for r in got if r.source == "stubs") and sum(r.kept for r in got if r.source == "big") == 500


# --- op 2 ---------------------------------------------------------------------------------------------------------


def plain_contained(docs, items):
    def shingles(t):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {(0, *w)} if w else set()

    out = set()
    sets = [(j, shingles(t)) for j, t in items]
    for i, d in docs:
        own = shingles(d)
        out |= {(i, j, len(q & own), len(q)) for j, q in sets if q and len(q & own) >= 0.8 * len(q)}
    return out


@pytest.mark.parametrize("chars", [decontaminate.INDEX_CHARS, 0])
def test_contained_items_against_brute_force(spark, chars):
    items = [(j, passage(n, 900 + j)) for j, n in enumerate([4, 5, 6, 9, 20, 40, 90, 300, 1])] + [(50, None), (51, ""), (52, passage(20, 904)), (None, passage(40, 905))]
    docs = [(i, passage(3000 if i % 2 else 40, i)) for i in range(12)]
    for j, t in items:
        if t and j is not None:
            w = t.split()
            docs.append((100 + j, passage(700, j) + " " + t.upper().replace(" ", ", ") + "! " + passage(700, j + 50)))
            docs.append((200 + j, passage(30, j) + " " + " ".join(w[: int(len(w) * 0.93)]) + " and more"))
            docs.append((300 + j, " ".join(w[: len(w) // 2]) + " " + passage(99, j)))
            # the two halves far apart: containment is of the whole document
            docs.append((400 + j, " ".join(w[: len(w) // 2]) + " " + passage(999, j) + " " + " ".join(w[len(w) // 2 :])))
    docs += [(500, items[0][1].upper()), (501, items[8][1] + "!"), (None, items[4][1]), (7, items[4][1]), (7, items[4][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit(3)).withColumn("ID", F.lit(4))
    got = sorted(map(tuple, decontaminate.contained_items(df, spark.createDataFrame(items, "item_id long, text string"), index_chars=chars).collect()), key=repr)
    want = plain_contained(docs, items)
    assert set(got) == want and len(want) >= 14 and len(got) == len(want) + 2  # one row comes twice, and holds two items


def test_items_that_share_most_shingles(spark):
    """Thousands of items with one preamble: shingles that all share are no candidates' reason, and nothing is lost."""
    preamble = passage(40, 1)
    items = [(i, f"{preamble} {passage(14 if i % 7 else 3, 10 + i)}") for i in range(300)]
    docs = [(i, f"{passage(50, 5000 + i)} {preamble} {passage(50, 6000 + i)}") for i in range(30)] + [(100 + i, f"{passage(9, i)} {items[i][1]}") for i in range(20)]
    df, what = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = plain_contained(docs, items)
    for chars in (decontaminate.INDEX_CHARS, 0):
        assert set(map(tuple, decontaminate.contained_items(df, what, index_chars=chars).collect())) == want
    assert len(want) > 1000  # those made of the preamble are in all documents


def test_sketches_miss_as_rarely_as_they_say():
    from math import comb

    for n in (1, 4, 16, 17, 30, 64, 300):
        for of in {n, max(1, n - 3), max(1, n // 2)}:
            k, t = decontaminate.sketch_plan(n, of, 0.8, 16, 1e-6)
            there = of - (n - decontaminate._needed(n, 0.8))
            if k:
                miss = sum(comb(there, i) * comb(of - there, k - i) for i in range(t) if 0 <= k - i <= of - there) / comb(of, k)
                assert k <= of and t >= 1 and miss <= 1e-6
            else:
                assert there <= 0
    assert decontaminate.sketch_plan(300, 300, 0.8, 16, 1e-6)[0] == 16


def test_many_items(spark):
    """10^5 items, beyond what one index holds."""
    items = spark.range(100_000).select(F.col("id").alias("item_id"), F.concat_ws(" ", *[F.concat(F.lit("w"), F.pmod(F.xxhash64("id", F.lit(k)), F.lit(5000)).cast("string")) for k in range(12)]).alias("text"))
    docs = items.where("item_id % 1000 = 3").select((F.col("item_id") + 1).alias("doc_id"), F.concat(F.lit("some words before "), "text", F.lit(" and after")).alias("text"))
    for chars in (decontaminate.INDEX_CHARS, 1 << 16):
        got = decontaminate.contained_items(docs, items, index_chars=chars).collect()
        assert sorted((r.doc_id, r.item_id) for r in got) == [(i + 1, i) for i in range(3, 100_000, 1000)]


def test_decontaminate_keeps_the_rest(spark):
    item = passage(30, 1)
    df = table(spark, [item, passage(50, 2), None, f"x {item} y"]).withColumn("source", F.lit("x")).union(edge(spark).withColumn("doc_id", F.col("doc_id") + 50))
    kept = decontaminate.decontaminate(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == df.columns and kept.count() == df.count() - 2
    assert decontaminate.decontaminate(df, spark.createDataFrame([], "item_id long, text string")).count() == df.count()


def test_leaks_go_by_row_not_by_id(spark):
    item = passage(30, 1)
    rows = [(None, f"a {item}"), (None, passage(40, 2)), (None, None), (7, f"b {item}"), (7, passage(40, 3))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = decontaminate.decontaminate(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == df.columns and sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, [rows[1], rows[2], rows[4]]))


# --- op 10 --------------------------------------------------------------------------------------------------------

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_columns(spark, reference):
    df = edge(spark).union(table(spark, [passage(30, 1), "  two  blanks \n\n x\n", "<|endoftext|> naïve 漢字 🙂 'tis"])).withColumn("t", F.lit(1)).withColumn("decoded", F.lit("clash")).withColumn("ids", F.lit(0))
    coded = bpe.decode(bpe.encode(df, PATH, P.PATTERN), PATH)
    assert set(coded.columns) == set(df.columns)
    at_once = bpe.encode(df, PATH, P.PATTERN, bytes_col="decoded")
    for r in [x for c in (coded, at_once) for x in c.select("text", "ids", "decoded", *bpe.digests(c)).collect()]:
        t = r.text or ""
        ids = reference.encode_ordinary(t)
        assert r.ids == ids and bytes(r.decoded) == t.encode() and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    empty = bpe.decode(bpe.encode(df.limit(0), PATH, P.PATTERN), PATH)
    assert empty.count() == 0


def test_prefixes_append_and_edit(reference):
    vocabulary = bpe.Vocabulary(open(PATH, "rb").read())
    r = random.Random(3)
    for _ in range(300):
        data = "".join(r.choice(["a", "b", " ", "the", "ing", "é", "漢", "zz", "1", "tion"]) for _ in range(r.randrange(1, 60))).encode()
        p = bpe.Prefixes(vocabulary, data[:5])
        p.append(data[5:])
        assert p.ids() == vocabulary.merged(data)
        i = r.randrange(len(data) + 1)
        j = r.randrange(i, len(data) + 1)
        new = data[:i] + b"thing" + data[j:]
        p.replace(i, j, b"thing")
        assert p.ids() == vocabulary.merged(new) and p.last == bpe.Prefixes(vocabulary, new).last
    far = bpe.Prefixes(vocabulary, b"the thing in between " * 400)
    assert far.replace(10, 12, b"xyz") < 600  # later prefixes are taken over


def test_patterns_that_look_across_blanks(reference):
    import regex

    vocabulary = bpe.Vocabulary(open(PATH, "rb").read())
    assert bpe.Encoder(vocabulary, P.PATTERN).by_word
    pattern = r"\w+ \w+|\s|\S"
    encoder = bpe.Encoder(vocabulary, pattern)
    text = "two words, and two more\nx 12 é y"
    assert not encoder.by_word and encoder.ids(text) == [i for piece in regex.findall(pattern, text) for i in vocabulary.merged(piece.encode())]


# --- op 3 ---------------------------------------------------------------------------------------------------------

RECORDS = {
    '{"messages":[{"role":"user","content":"hi"},{"role":"assistant","content":"<|end|>\\\\ [INST]"}]}': ("messages", [("user", "hi"), ("assistant", "<|end|>\\ [INST]")]),
    '{"id":7,"messages":[{"role":"user","content":"hi","name":"n"},{"content":"yo","role":"assistant","weight":0}],"VOID":1}': ("messages", [("user", "hi"), ("assistant", "yo")]),
    '{"prompt":"hi","messages":[{"role":"user","content":[{"type":"text","text":"a"},{"type":"image_url","image_url":{"url":"u"}},"b"]},{"role":"assistant","content":null}]}': ("messages", [("user", "a[image_url]b"), ("assistant", "")]),
    '{"messages":[{"role":"assistant","content":null,"tool_calls":[{"name":"f","n":1}]},{"role":"tool","content":"3"}]}': ("messages", [("assistant", '[{"n":1,"name":"f"}]'), ("tool", "3")]),
    '{"messages":[]}': ("messages", []),
    '{"messages":[{"role":"user"}]}': (None, []),
    '{"messages":[{"role":"user","content":{"a":1}}]}': (None, []),
    '{"messages":"no list"}': (None, []),
    '{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":"b"}]}': ("conversations", [("user", "a"), ("assistant", "b")]),
    '{"instruction":"do","input":"it","output":"done"}': ("instruction", [("user", "do\n\nit"), ("assistant", "done")]),
    '{"output":"done","instruction":"do"}': ("instruction", [("user", "do"), ("assistant", "done")]),
    '{"prompt":"p","completion":12.5}': ("prompt and completion", [("user", "p"), ("assistant", "12.5")]),
    '{"prompt":"p","response":null}': ("prompt and response", [("user", "p"), ("assistant", "")]),
    '{"question":true,"answer":"c","meta":{"prompt":"x"}}': ("question and answer", [("user", "true"), ("assistant", "c")]),
    '{"prompt":"p","completion":"c","question":"q","answer":"a"}': (None, []),
    '{"other":"x"}': (None, []),
    "[]": (None, []),
    "not json": (None, []),
}


def test_layouts(spark):
    df = spark.createDataFrame([(s,) for s in RECORDS], "record string").withColumn("turn", F.lit(1)).withColumn("h", F.lit(2)).withColumn("Turns", F.lit("x")).withColumn("formatted", F.lit("y")).withColumn("f", F.lit("z"))
    out = chat_format.format_turns(chat_format.canonical(df)).withColumn("read", chat_format.read_back(F.col("formatted")))
    out = out.withColumn("under", chat_format.under_mask(F.col("formatted"), F.col("loss_mask")))
    for r in out.collect():
        name, turns = RECORDS[r.record]
        assert r.mapping == name and [tuple(t) for t in r.turns] == turns and [tuple(t) for t in r.read] == turns, r.record
        spans = [r.formatted[s.start : s.start + s.length] for s in r.loss_mask]
        assert [re.sub(r"(?s)\\(.)", r"\1", s) for s in spans] == [t for role, t in turns if role == "assistant"]
        assert spans == [r.formatted.encode()[s.byte_start : s.byte_start + s.byte_length].decode() for s in r.loss_mask]
        assert r.under == "".join(t for role, t in turns if role == "assistant")
        assert len(re.findall(r"<\|role\|>", r.formatted)) == len(turns) and r.f == "z"
        assert (r.reject_reason is None) == (name is not None)
    bad = chat_format.rejects(chat_format.canonical(df.union(df.limit(1).withColumn("record", F.lit(None).cast("string"))))).collect()
    assert sorted({r.reject_reason for r in bad}) == ["no record", "not JSON", "unknown layout"]


def test_long_conversations_take_linear_time(spark):
    import time

    n = 20_000
    df = spark.range(2).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(F.when(i % 2 == 0, "assistant").otherwise("user").alias("role"), F.concat(F.lit("é"), i.cast("string")).alias("text"))).alias("turns"))
    out = chat_format.format_turns(df).select("formatted", F.size("loss_mask").alias("n"), F.length(chat_format.under_mask(F.col("formatted"), F.col("loss_mask"))).alias("under"))
    out.first()
    began = time.perf_counter()
    rows = out.collect()
    assert time.perf_counter() - began < 10
    assert all(r.n == n // 2 and r.under == sum(len(f"é{i}") for i in range(2, n + 1, 2)) for r in rows)


def test_layouts_hold_conversations_without_loss(spark):
    r = random.Random(8)
    rows = []
    for c in range(200):
        for t in range(r.choice([1, 2, 2, 2, 5])):
            role = ("user", "assistant")[t % 2] if c % 3 else r.choice(["system", "human", "tool", "", None])
            rows.append((c, t, role, r.choice([None, "", "[INST] x", "two\nlines", "naïve <|end|>"])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.canonical(chat_format.conversations_to_layouts(df)).collect()
    want = {}
    for c, _, role, text in rows:
        want.setdefault(c, []).append((role or "", text or ""))
    assert {x.conv_id: [tuple(t) for t in x.turns] for x in out} == want
    assert len({x.mapping for x in out}) >= 5 and len({x.fingerprint for x in out}) >= 6


def test_escapes_are_reversible(spark):
    r = random.Random(5)
    parts = ["<|role|>", "<|", "|>", "\\", "[INST]", "[/INST]", "</s>", "<s>", "<", "[", "a", "\n", "<\\|", "é"]
    cases = ["".join(r.choice(parts) for _ in range(r.randrange(8))) for _ in range(400)]
    df = spark.createDataFrame([(s,) for s in cases], "s string").select("s", chat_format.escape(F.col("s")).alias("e")).select("s", "e", chat_format.unescape(F.col("e")).alias("u"))
    for x in df.collect():
        assert x.u == x.s and not any(c in x.e for c in ("<|", "[INST]", "[/INST]", "<s>", "</s>"))


def test_conversations_with_gaps(spark):
    rows = [(1, 2, "assistant", None), (1, 1, None, "q"), (1, 1, "user", "q"), (None, None, None, None), (None, 3, "user", "alone"), (2, None, "user", ""), (2, 0, "user", "x"), (2, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for made in (chat_format.conversations_to_records, chat_format.conversations_to_layouts):
        got = [(r.conv_id, [tuple(t) for t in r.turns]) for r in chat_format.canonical(made(df)).collect()]
        want = [(1, [("", "q"), ("user", "q"), ("assistant", "")]), (None, [("", "")]), (None, [("user", "alone")]), (2, [("user", ""), ("user", "x"), ("user", "x")])]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert chat_format.canonical(chat_format.conversations_to_records(df.limit(0))).count() == 0


# --- op 5 ---------------------------------------------------------------------------------------------------------


def test_licences(spark):
    from quillmark.llm.license_texts import LICENSES

    mit = LICENSES["MIT"]
    wrapped = "\n".join(" * " + " ".join(mit.split()[i : i + 9]) for i in range(0, len(mit.split()), 9))
    texts = [
        (mit, "MIT"),
        ("Copyright (c) 2020 Some One\nAll rights reserved.\n\n" + mit.upper().replace('"', "”").replace("  ", "\n"), "MIT"),
        ("MIT License\n\nCopyright Jane Doe\n\n" + mit, "MIT"),
        ("The MIT License (MIT)\nCopyright: 2020-2024 The Foo Authors\r\n\r\n" + mit.replace("\n", "\r\n"), "MIT"),
        (f"/*\n * MIT License\n *\n * Copyright © 2001 X\n{wrapped}\n */", "MIT"),
        ("ISC License\n\nCopyright 2020 a, b <c@d.e>\n\n" + LICENSES["ISC"], "ISC"),
        ("BSD 3-Clause License\n\n(c) Me\n\n" + LICENSES["BSD-3-Clause"].replace("\n3. ", "\n* "), None),
        ("BSD 3-Clause License\n\nCopr. 1999 Me\n\n" + LICENSES["BSD-3-Clause"], "BSD-3-Clause"),
        (mit.replace("sublicense", "sublicence"), None),
        (mit + " And more.", None),
        ("copyright notice and this", None),
        (None, None),
        ("", None),
        ("Copyright 2020 Me", None),
    ]
    more = [
        ("x\n * Licensed under the Apache Licence, Version 2.0\r\nReleased under the MIT License.\n", ["Apache-2.0", "MIT"]),
        ("Released under CC0 1.0\n\n# SPDX-License-Identifier: GPL-3.0-or-later", ["CC0-1.0", "GPL-3.0"]),
        ("this project is licenced under the  mozilla public license, version 2.0!", ["MPL-2.0"]),
        ("We licensed nothing. Licensed under the MIT License, see below.", []),
    ]
    df = table(spark, [t for t, _ in texts] + [t for t, _ in more]).withColumn("digest", F.lit(1)).withColumn("license_id", F.lit("x")).withColumn("T", F.lit(0)).withColumn("Canonical_sha256", F.lit("y"))
    got = license_scan.scan(df).orderBy("doc_id").collect()
    assert [r.license_id for r in got] == [i for _, i in texts] + [None] * len(more)
    assert [r.notice_ids for r in got[len(texts) :]] == [i for _, i in more] and got[0].notice_ids == [] and got[0].T == 0
    assert license_scan.scan(edge(spark)).count() == edge(spark).count()
    own = spark.createDataFrame([("b", "My own terms"), ("a", "my, OWN terms!"), ("z", None)], "license_id string, text string")
    assert [r.license_id for r in license_scan.scan(table(spark, ["MY own Terms.", ""]), own).orderBy("doc_id").collect()] == ["a", None]


def test_long_licences(spark):
    """Whole licences as systems keep them, where there are any."""
    import pathlib

    place = pathlib.Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}
    there = [n for n in names if (place / n).is_file()]
    if not there:
        pytest.skip("no licence files here")
    df = table(spark, ["# " + (place / n).read_text().replace("\n", "\r\n# ") for n in there])
    assert [r.license_id for r in license_scan.scan(df).orderBy("doc_id").collect()] == [names[n] for n in there]


def test_every_notice_has_a_telling_word():
    from quillmark.llm.license_texts import notices

    words = license_scan.telling_words(notices())
    assert len(words) < 30 and all(any(w in n.lower() for w in words) for n in notices())


def test_scratch_tables_go(spark):
    import pathlib

    from quillmark.llm.storage import Scratch, clear

    one, two = Scratch(spark, "one"), Scratch(spark, "two")
    for s in (one, two):
        s.table(spark.range(3), "t")
    places = [pathlib.Path(s.path.removeprefix("file://")) for s in (one, two)]
    assert all(p.is_dir() for p in places)
    Scratch.every[:], before = [one, two], [s for s in Scratch.every if s not in (one, two)]
    clear()
    assert not any(p.exists() for p in places)
    Scratch.every[:] = before


def test_every_operator_takes_empty_tables(spark):
    none = table(spark, []).withColumn("id", F.lit(1))
    assert simhash.near_duplicates(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert quality_rules.rules(none).count() == 0
    assert license_scan.scan(none).count() == 0
    assert decontaminate.contained_items(none, spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")).count() == 0
