"""String helpers against Python itself, over all code points."""

import itertools
import re

from pyspark.sql import functions as F

from quillmark.functions import text as T

POINTS = [c for c in itertools.chain(range(0xD800), range(0xE000, 0x110000))]


def _rows(spark, make):
    return spark.createDataFrame([(c, make(chr(c))) for c in POINTS], "cp int, s string")


def test_strip_and_lines(spark):
    df = _rows(spark, lambda c: f"{c}a{c}b{c}").select("cp", "s", T.py_strip(F.col("s")).alias("strip"), F.size(T.py_lines(F.col("s"))).alias("n"), T.blank(F.substring("s", 1, 1)).alias("blank"))
    bad = [r.cp for r in df.collect() if r.strip != r.s.strip() or r.n != len(r.s.splitlines()) or r.blank != (not chr(r.cp).strip())]
    assert bad == []


def test_word_boundary(spark):
    df = _rows(spark, lambda c: f"{c}bug").select("cp", F.col("s").rlike(f"{T.NOT_AFTER_WORD}bug").alias("hit"))
    bad = [r.cp for r in df.collect() if r.hit != bool(re.search(r"\bbug", f"{chr(r.cp)}bug"))]
    assert len(bad) < 8000 and all(c > 0x7F for c in bad)  # letters newer than the JVM's tables


def test_lines_cases(spark):
    cases = ["", "\n", "a", "a\n", "a\r\n", "\r\n\r\n", "a\n\n", "a\rb\x0bc\x1dd\u2029e", "\n\na"]
    df = spark.createDataFrame([(s,) for s in cases], "s string").select("s", T.py_lines(F.col("s")).alias("l"), T.py_count(F.col("s"), "\n").alias("n"))
    assert all(r.l == r.s.splitlines() and r.n == r.s.count("\n") for r in df.collect())


def test_long_texts_take_linear_time(spark):
    """Padding inside a text and very many fenced lines."""
    import time

    from quillmark.functions.markdown import prose_of

    padded = f"a{' ' * 1_000_000}b"
    fenced = "\n".join(["`x` out", "```", "in", "```"] * 25_000 + ["```", "open"])
    df = spark.createDataFrame([(padded, fenced)], "p string, f string").select(
        T.py_strip(F.concat(F.lit(" 　"), F.col("p"), F.lit("\x85\n"))).alias("p"), T.py_rstrip(F.col("p")).alias("r"), prose_of(F.col("f")).alias("f")
    )
    df.first()
    began = time.perf_counter()
    row = df.first()
    assert time.perf_counter() - began < 5
    assert row.p == padded and row.r == padded and row.f == "\n".join([" out", "", "", ""] * 25_000 + ["", ""])


def test_fences(spark):
    from quillmark.functions.markdown import prose_of

    def plain(text):
        out, code = [], False
        for line in text.splitlines():
            fence = line.strip().startswith("```") and line.lstrip().startswith("```")
            out.append("" if fence or code else re.sub(r"`[^`\n]*`", "", line))
            code ^= fence
        return "\n".join(out)

    parts = ["```", "a `b` c", "", "  ```py", "x", "`"]
    cases = ["\n".join(x) for n in range(5) for x in itertools.product(parts, repeat=n)]
    rows = spark.createDataFrame([(s,) for s in cases], "s string").select("s", prose_of(F.col("s")).alias("p")).collect()
    assert all(r.p == plain(r.s) for r in rows)
