"""The column contract of a chat log and its validation in one scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions.text import WS, D, py_strip
from quillmark.plans.registry import ANSWER, QUERY

NULLS = ("", "NA", "N/A", "null", "NULL", "None", "-")


@dataclass(frozen=True)
class FieldSpec:
    """dtype: int, float, str, datetime or category. ``used``: rules read it, so a mismatch is a violation."""

    name: str
    dtype: str = "str"
    nullable: bool = True
    allowed: tuple[str, ...] | None = None
    bounds: tuple[float, float] | None = None
    used: bool = False


# The declared columns, their kinds, and which of them rules read.
FIELDS: tuple[FieldSpec, ...] = (
    FieldSpec(QUERY, nullable=False, used=True),
    FieldSpec(ANSWER, used=True),
    FieldSpec("log_table"),
    FieldSpec("db_route_result"),
    FieldSpec("assist_name"),
    FieldSpec("model_name"),
    FieldSpec("prompt_template_name"),
    FieldSpec("db_dept_name"),
    FieldSpec("db_position_name"),
    FieldSpec("db_id"),
    FieldSpec("dept_div_name"),
    FieldSpec("div_name"),
    FieldSpec("dept_name"),
    FieldSpec("user_name"),
    FieldSpec("user_id"),
    FieldSpec("user_type"),
    FieldSpec("job_grade"),
    FieldSpec("job"),
    FieldSpec("chat_id"),
    FieldSpec("input_msg_id"),
    FieldSpec("turn_start_week"),
    FieldSpec("turn_start_weekday"),
    FieldSpec("turn_start_date", "datetime"),
    FieldSpec("input_msg_start_time", "datetime"),
    FieldSpec("output_msg_end_time", "datetime"),
    FieldSpec("rag_yn", "category", allowed=("true", "false")),
    FieldSpec("rag_decide_yn", "category", allowed=("true", "false")),
    FieldSpec("input_msg_type"),
    FieldSpec("input_msg_sub_type"),
    FieldSpec("output_msg_type"),
    FieldSpec("output_msg_sub_type"),
    FieldSpec("feedback_type"),
    FieldSpec("feedback_score", "int"),
    FieldSpec("feedback_category"),
    FieldSpec("feedback_content"),
    FieldSpec("feedback_detail_content"),
)


def is_null(c: Column) -> Column:
    return c.isNull() | py_strip(c.cast("string")).isin(*NULLS)


def _digits(c: Column) -> Column:
    """Decimal digits of any script to ASCII: only those that Spark's casts would refuse need it, and none can be cast otherwise."""
    zeros = [0x660, 0x6F0, 0x7C0, 0x966, 0x9E6, 0xA66, 0xAE6, 0xB66, 0xBE6, 0xC66, 0xCE6, 0xD66, 0xE50, 0xED0, 0xF20, 0xFF10]
    old = "".join(chr(z + i) for z in zeros for i in range(10))
    return F.translate(c, old, "0123456789" * len(zeros))


def parse_int(c: Column) -> Column:
    """Python's ``int``: digits with single underscores between, a sign, blanks around."""
    text = _digits(py_strip(c))
    return F.when(text.rlike(r"^[+-]?[0-9]+(?:_[0-9]+)*\z"), F.replace(text, F.lit("_"), F.lit("")).try_cast("decimal(38,0)"))


def parse_float(c: Column) -> Column:
    """Python's ``float``."""
    text = F.lower(_digits(py_strip(c)))
    n = "[0-9]+(?:_[0-9]+)*"
    number = text.rlike(rf"^[+-]?(?:{n}\.?(?:{n})?|\.{n})(?:e[+-]?{n})?\z")
    special = F.when(text.rlike(r"^[+-]?inf(?:inity)?\z"), F.concat(F.regexp_extract(text, r"^(-?)", 1), F.lit("Infinity"))).when(text.rlike(r"^[+-]?nan\z"), "NaN")
    return F.coalesce(F.when(number, F.replace(text, F.lit("_"), F.lit(""))), special).try_cast("double")


def parse_datetime(c: Column) -> Column:
    """Python's ``datetime.fromisoformat``: calendar or week dates, basic or extended, with or without a time."""
    two = "[0-9]{2}"
    date = rf"(?:[0-9]{{4}}-{two}-{two}|[0-9]{{8}}|[0-9]{{4}}-?W{two}(?:-?[1-7])?)"
    time = rf"(?:{two}(?::?{two}(?::?{two}(?:[.,][0-9]+)?)?)?)"
    zone = rf"(?:Z|[+-]{two}(?::?{two}(?::?{two}(?:[.,][0-9]+)?)?)?)?"
    shaped = c.rlike(rf"(?s)^{date}(?:.{time}{zone})?\z")
    plain = c.rlike(r"^[0-9]{4}-?[0-9]{2}-?[0-9]{2}")
    squeezed = F.regexp_replace(F.substring(c, 1, 10), r"^([0-9]{4})-?([0-9]{2})-?([0-9]{2}).*$", "$1-$2-$3")
    year = F.substring(c, 1, 4)
    week = F.regexp_extract(c, r"^[0-9]{4}-?W([0-9]{2})", 1).try_cast("int")
    day = F.coalesce(F.regexp_extract(c, r"^[0-9]{4}-?W[0-9]{2}-?([1-7])", 1).try_cast("int"), F.lit(1))
    fourth = F.try_to_timestamp(F.concat(year, F.lit("-01-04")), F.lit("yyyy-MM-dd")).cast("date")
    monday = F.date_sub(fourth, F.weekday(fourth))
    weeks = F.weekofyear(F.concat(year, F.lit("-12-28")).try_cast("date"))
    by_week = F.when((week >= 1) & (week <= weeks), F.date_add(monday, (week - 1) * 7 + day - 1))
    date_part = F.when(plain, squeezed.try_cast("date")).otherwise(by_week)
    rest = F.regexp_replace(c, rf"(?s)^{date}(?:.|\z)", "")
    clock = F.regexp_replace(F.regexp_replace(rest, r"(?:Z|[+-][0-9:.,]*)$", ""), "[:]", "")
    padded = F.rpad(F.regexp_extract(clock, "^([0-9]*)", 1), 6, "0")
    hour, minute, second = (F.substring(padded, i, 2).try_cast("int") for i in (1, 3, 5))
    ok = (hour <= 23) & (minute <= 59) & (second <= 59)
    return F.when(shaped & date_part.isNotNull() & (date_part >= F.lit("0001-01-01").cast("date")) & ok, date_part.cast("timestamp"))


def parse(c: Column, dtype: str) -> Column:
    """The value, null if it can't be read as ``dtype``."""
    readers = {"int": parse_int, "float": parse_float, "datetime": parse_datetime}
    return readers.get(dtype, lambda x: x)(c.cast("string"))


def _is_odd(f: FieldSpec) -> Column:
    c = F.col(f"`{f.name}`")
    return ~is_null(c) & ~c.cast("string").isin(*f.allowed)


def _unexpected(df: DataFrame, fields: list[FieldSpec]) -> dict[str, tuple[int, list[str]]]:
    """How many distinct unexpected values each field has, and the first five of them. Values meet by (field, value), never as one set."""
    cells = F.array(*[F.struct(F.lit(f.name).alias("field"), F.when(_is_odd(f), F.col(f"`{f.name}`").cast("string")).alias("value")) for f in fields])
    values = df.select(F.explode(cells).alias("x")).where("x.value is not null").select("x.field", "x.value").distinct()
    first = values.withColumn("k", F.row_number().over(Window.partitionBy("field").orderBy("value"))).where("k <= 5")
    first = first.groupBy("field").agg(F.sort_array(F.collect_list("value")).alias("first"))
    rows = values.groupBy("field").agg(F.count("*").alias("n")).join(first, "field").collect()  # one row for each field
    return {r.field: (r.n, r.first) for r in rows}


def _counters(f: FieldSpec) -> dict[str, Column]:
    c = F.col(f"`{f.name}`")
    null, value = is_null(c), parse(c, f.dtype)
    out = {"nulls": F.count_if(null)}
    if f.dtype in ("int", "float", "datetime"):
        out["bad"] = F.count_if(~null & value.isNull())
    if f.allowed is not None:
        out["odd"] = F.count_if(_is_odd(f))
    if f.bounds is not None:
        low, high = f.bounds
        out["outside"] = F.count_if(~null & value.isNotNull() & ~value.between(low, high))
    return out


def findings(df: DataFrame, fields: tuple[FieldSpec, ...] = FIELDS) -> DataFrame:
    """(seq, severity, field, kind, n, detail): what the contract finds, in order. One scan, one aggregate row.

    Where a field has unexpected values, a second scan counts the distinct ones
    and takes the first five of them for ``detail``.
    """
    spark = df.sparkSession
    here = [f for f in fields if f.name in df.columns]
    columns = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(here):
        for k, value in _counters(f).items():
            columns.append(value.alias(f"{k}_{i}"))
    row = df.agg(*columns).first()
    out: list[tuple] = []
    odd = [f for i, f in enumerate(here) if f.allowed is not None and row[f"odd_{i}"]]
    unexpected = _unexpected(df, odd) if odd else {}

    def add(f: FieldSpec, kind: str, n: int, detail: str) -> None:
        out.append((len(out), "violation" if f.used else "note", f.name, kind, n, detail))

    if not row["rows"]:
        return spark.createDataFrame([(0, "violation", "input", "rows", 0, "0 rows")], _FINDINGS)
    for f in fields:
        if f not in here:
            add(f, "missing", 0, "column missing")
            continue
        i = here.index(f)
        got = row.asDict(recursive=True)
        if got[f"nulls_{i}"] and not f.nullable:
            add(f, "nulls", got[f"nulls_{i}"], f"{got[f'nulls_{i}']:,} nulls but nullable=False")
        if got.get(f"bad_{i}"):
            add(f, "dtype", got[f"bad_{i}"], f"dtype {f.dtype} expected, {got[f'bad_{i}']:,} rows failed to parse")
        if f.name in unexpected:
            n, first = unexpected[f.name]
            add(f, "allowed", n, f"unexpected values {first}" + (f" (+{n - 5} more)" if n > 5 else ""))
        if got.get(f"outside_{i}"):
            add(f, "range", got[f"outside_{i}"], f"{got[f'outside_{i}']:,} rows outside {f.bounds}")
    extra = sorted(set(df.columns) - {f.name for f in fields})
    if extra:
        out.append((len(out), "note", "(schema)", "undeclared", len(extra), f"undeclared columns {extra}"))
    return spark.createDataFrame(out, _FINDINGS)


_FINDINGS = "seq int, severity string, field string, kind string, n long, detail string"
_LABEL = 24


@dataclass(frozen=True)
class Report:
    violations: list[str]
    notes: list[str]

    @property
    def ok(self) -> bool:
        return not self.violations


def validate(df: DataFrame, fields: tuple[FieldSpec, ...] = FIELDS) -> Report:
    """Violations and notes, a line for each."""
    lines: dict[str, list[str]] = {"violation": [], "note": []}
    for r in findings(df, fields).orderBy("seq").collect():  # a few lines for each declared field
        lines[r.severity].append(f"{r.field:<{_LABEL}}: {r.detail}")
    return Report(lines["violation"], lines["note"])
