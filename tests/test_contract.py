"""Parsing as Python does it, and validation."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quillmark.operators import contract
from quillmark.plans.registry import QUERY
from quillmark.sources import synth


def _read(spark, values, dtype):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return {r.v: r.x for r in df.select("v", contract.parse(F.col("v"), dtype).alias("x")).collect()}


def _python(value, read):
    try:
        return read(value)
    except ValueError:
        return None


INTS = ["1", "-7", "+3", " 12\n", "1_000", "1__0", "_1", "12.0", "1e3", "", "٣٤", "0x1", "007", "--1", "９"]
FLOATS = ["1", "1.5", ".5", "5.", "1e3", "1d", "1f", "nan", "-inf", "Infinity", "1_0.5", "1__0", "", "e3", " 2.5 ", "+.5e-1", "0x1"]
DATES = [
    "2026-01-05", "2026-1-5", "20260105", "2026", "2026-W01-1", "2026W011", "2026-W01", "2026-W54-1", "2026-02-30", "2026-01-05 09:00:00", "2026-01-05T09:00", "20260105T0900",
    "2026-01-05T09", "2026-01-05T25:00", "2026-01-05 09:00:00.123456", "2026-01-05T09:00:00Z", "2026-01-05T09:00:00+09:00", "9:00:00", "", "2026-01-05T", "2026-01-05 9:00",
]


def test_int(spark):
    got = _read(spark, INTS, "int")
    assert {v: None if x is None else int(x) for v, x in got.items()} == {v: _python(v, int) for v in INTS}


def test_float(spark):
    got = _read(spark, FLOATS, "float")
    assert {v: None if x is None else repr(x) for v, x in got.items()} == {v: None if _python(v, float) is None else repr(_python(v, float)) for v in FLOATS}


@pytest.mark.parametrize("value", DATES)
def test_datetime(spark, value):
    assert (_read(spark, [value], "datetime")[value] is not None) == (_python(value, datetime.fromisoformat) is not None)


def test_generated_log_meets_the_contract(spark):
    found = contract.validate(synth.generate(spark, 300, 1))
    assert found.ok and found.notes == []


def test_findings(spark):
    log = synth.generate(spark, 50, 1)
    assert contract.validate(log.where("false")).violations == [f"{'input':<24}: 0 rows"]
    assert contract.validate(log.drop(QUERY)).violations == [f"{QUERY:<24}: column missing"]
    blank = log.withColumn(QUERY, F.lit(" NA "))
    assert contract.validate(blank).violations == [f"{QUERY:<24}: 50 nulls but nullable=False"]
    other = contract.validate(log.drop("job").withColumn("zz", F.lit(1)).withColumn("rag_yn", F.lit("maybe")).withColumn("feedback_score", F.lit("x")))
    assert other.ok and [n.split(":")[0].strip() for n in other.notes] == ["job", "rag_yn", "feedback_score", "(schema)"]


def test_allowed_shows_five(spark):
    spec = (contract.FieldSpec("c", "category", allowed=("x",), used=True),)
    df = spark.range(8).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("c"))
    assert contract.validate(df, spec).violations == [f"{'c':<24}: unexpected values ['v0', 'v1', 'v2', 'v3', 'v4'] (+3 more)"]


def test_range_is_inclusive(spark):
    spec = (contract.FieldSpec("c", "int", bounds=(1, 3)),)
    df = spark.createDataFrame([("0",), ("1",), ("3",), ("4",), (None,), ("x",)], "c string")
    assert {(r.kind, r.n) for r in contract.findings(df, spec).collect()} == {("dtype", 1), ("range", 2)}
