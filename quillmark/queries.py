"""Queries over the test tables, and the SQL each is held against.

The turns are all documents (the text as answer to one fixed question), the
questions and answers of all conversations, and the hand-made turns. A query without SQL can't be expressed there; tests hold it
against plain Python.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark import report
from quillmark import sqltext as S
from quillmark.fixtures import QUESTION, TURNS
from quillmark.functions import language, links, markdown, pii
from quillmark.functions.text import blank, py_lines, py_strip, tally, text_of
from quillmark.operators import contract, pack_a, pack_b, tagging
from quillmark.plans.registry import ANSWER, QUERY, RETRIEVED_DOCS, SEARCH_QUERY
from quillmark.session import shared_dir, spread
from quillmark.sources import conversations, logs, sinks, synth

Query = Callable[[SparkSession, str], DataFrame]

_COLUMNS = ("id", QUERY, ANSWER, SEARCH_QUERY, RETRIEVED_DOCS)


#: Turns of conversations are numbered from here on, by conversation and turn.
_PAIRS_FROM = 10**12


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, pairs of conversations and hand-made turns, with a numeric id."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(F.col("doc_id").alias("id"), F.lit(QUESTION).alias(QUERY), F.col("text").alias(ANSWER), F.lit("x").alias(SEARCH_QUERY), F.lit("x").alias(RETRIEVED_DOCS))
    pairs = conversations.question_answer_pairs(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    pairs = pairs.select((_PAIRS_FROM + 1000 * F.col("conv_id") + F.col("turn")).alias("id"), *_COLUMNS[1:])
    made = spark.createDataFrame([(-i - 1, *t) for i, t in enumerate(TURNS)], ", ".join(["id long", *(f"{c} string" for c in _COLUMNS[1:])]))
    return docs.union(pairs).union(made)


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with a flag column of lists written as text."""
    old = F.when(F.col("id") < -40, "[]").when(F.col("id") < 0, "['kept', 'invalid_link', 'kept']").otherwise("")
    return turns(spark, sf_dir).withColumn("Flags", old)


def _rule(pack, name: str) -> Query:
    return lambda spark, sf: pack.hits(turns(spark, sf), only=[name]).select("id", F.col(name).alias("hit"))


def _value(name: str, of: Callable[[Column], Column], column: str = ANSWER) -> Query:
    return lambda spark, sf: turns(spark, sf).select("id", of(F.col(column)).alias(name))


def _stripped(of: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda c: of(py_strip(text_of(c)))


def _prose(of: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return _stripped(lambda c: of(markdown.prose_of(c)))


def _round_trip(write, read) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{shared_dir(spark)}/trip-{uuid.uuid4().hex}"
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        write(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "source"), path)
        return read(spark, path).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source")

    return run


def _by_part(df: DataFrame, n: int, write, path: str) -> list[str]:
    """``df`` written as ``n`` tables, each with some of the rows."""
    places = [f"{path}/{k}" for k in range(n)]
    for k, place in enumerate(places):
        write(df.where(F.pmod(F.hash("doc_id"), F.lit(n)) == k), place)
    return places


def _union_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as three CSV tables, the last without a column, and united again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("string").alias("doc_id"), "source", "lang")
    places = _by_part(docs, 3, sinks.write_csv, f"{shared_dir(spark)}/parts-{uuid.uuid4().hex}")
    parts = [logs.read_csv(spark, p) for p in places]
    back = logs.union_parts([*parts[:2], parts[2].drop("lang").withColumn("lang", F.lit("none"))])
    return back.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids"))


def _append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents appended to one CSV table in two steps, read in splits."""
    path = f"{shared_dir(spark)}/append-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("string").alias("doc_id"), "source")
    half = F.pmod(F.hash("doc_id"), F.lit(2)) == 0
    sinks.write_csv(docs.where(half), path)
    sinks.write_csv(docs.where(~half), path, append=True)
    return logs.read_csv(spark, path, line_breaks=False)


def _limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows come for some limits; 0 is no limit."""
    path = f"{shared_dir(spark)}/limits-{uuid.uuid4().hex}"
    sinks.write_csv(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), path)
    out = None
    for n in (0, 1, 7, 10**9):
        one = logs.read_csv(spark, path, limit=n).agg(F.lit(n).cast("long").alias("rows_wanted"), F.count("*").alias("rows_read"))
        out = one if out is None else out.union(one)
    return out


def _tag_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that a run prints; as many as there are rules."""
    counts = tagging.tag_counts(turns(spark, sf_dir)).collect()
    return spark.createDataFrame([(x,) for x in report.tag_lines(counts)], "line string")


def _column_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each pack-A rule, whether it can run on tables that lack the optional columns."""
    rows = []
    for columns in ((QUERY, ANSWER), (QUERY, ANSWER, SEARCH_QUERY), _COLUMNS):
        there = {r.name for r in pack_a.PACK.present(columns)}
        rows += [(len(columns), n, n in there) for n in pack_a.PACK.names()]
    return spark.createDataFrame(rows, "columns long, rule string, runs boolean")


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exit status of the contract on the log as it is and without what breaks it."""
    log = _log(spark, sf_dir)
    good = log.where("key <> ' NA ' and status = 'O'").drop("more")
    rows = [(name, int(not contract.validate(df, _SPECS).ok)) for name, df in (("as it is", log), ("cleaned", good), ("empty", good.where("false")))]
    return spark.createDataFrame(rows, "log string, status long")


def _pii_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = turns(spark, sf_dir).select(F.explode(pii.find_pii(F.col(ANSWER))).alias("p"))
    return found.groupBy(F.col("p.kind").alias("kind")).agg(F.count("*").alias("n"))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a log of strings, with values that break the contract below."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey")
    return o.select(
        F.when(F.pmod(k, F.lit(97)) == 0, " NA ").otherwise(k.cast("string")).alias("key"),
        F.when(F.pmod(k, F.lit(89)) == 0, "12.0").when(F.pmod(k, F.lit(83)) == 0, "1_000").otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        F.when(F.pmod(k, F.lit(79)) == 0, "2026-1-5").when(F.pmod(k, F.lit(73)) == 0, "20260105").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.col("o_orderstatus").alias("status"),
        F.lit("x").alias("more"),
    )


_SPECS = (
    contract.FieldSpec("key", "int", nullable=False, used=True),
    contract.FieldSpec("customer", "int", bounds=(1, 500)),
    contract.FieldSpec("day", "datetime"),
    contract.FieldSpec("status", "category", allowed=("O",), used=True),
    contract.FieldSpec("gone", "str"),
)


def _findings(*kinds: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = contract.findings(_log(spark, sf_dir), _SPECS)
        return out.where(F.col("kind").isin(*kinds)).select("severity", "field", "kind", "n")

    return run


_VAL = """with r as (
  select case when o_orderkey % 97 = 0 then ' NA ' else o_orderkey::varchar end as key,
    case when o_orderkey % 89 = 0 then '12.0' when o_orderkey % 83 = 0 then '1_000' else o_custkey::varchar end as customer,
    case when o_orderkey % 79 = 0 then '2026-1-5' when o_orderkey % 73 = 0 then '20260105' else strftime(o_orderdate, '%Y-%m-%d') end as day,
    o_orderstatus as status from orders),
f as (
  select 'violation' as severity, 'key' as field, 'nulls' as kind, count(*) filter (where trim(key) = 'NA') as n from r
  union all select 'note', 'customer', 'dtype', count(*) filter (where customer = '12.0') from r
  union all select 'note', 'customer', 'range', count(*) filter (where customer <> '12.0' and replace(customer, '_', '')::int not between 1 and 500) from r
  union all select 'note', 'day', 'dtype', count(*) filter (where day = '2026-1-5') from r
  union all select 'violation', 'status', 'allowed', count(distinct status) filter (where status <> 'O') from r
  union all select 'note', 'gone', 'missing', 0
  union all select 'note', '(schema)', 'undeclared', 1)
select severity, field, kind, n from f where (n > 0 or kind = 'missing') and kind in ({})"""


def _val(*kinds: str) -> tuple[Query, str]:
    return _findings(*kinds), _VAL.format(", ".join(f"'{k}'" for k in kinds))


def _synth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and hits of each rule over both kinds of generated logs, as large as the orders table."""
    n = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    out = None
    for mode in ("normal", "adversarial"):
        one = tagging.summarize(synth.generate(spark, n, 7, mode)).withColumn("mode", F.lit(mode))
        out = one if out is None else out.union(one)
    return out


def _apply_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tagging.apply_flags(_flagged(spark, sf_dir))
    return out.select("id", F.array_join("Flags", ",").alias("flags"))


def _existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir).select("id", F.array_join(tagging.existing_flags(F.col("Flags")), ",").alias("flags"))


def _tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.row_tags(turns(spark, sf_dir)).select("id", F.array_join("Flags", ",").alias("flags"))


def _format_part(of) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return turns(spark, sf_dir).select("id", text_of(F.col(ANSWER)).alias("t")).select("id", of(F.col("t")).alias("hit"))

    return run


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of all pages, as they are and cut short."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    url = F.explode(F.array("url", F.regexp_replace("url", "^https?://", "www."), F.concat(F.lit("/"), F.col("url")), F.substring("url", 1, 12)))
    return pages.select("page_id", url.alias("url")).select("page_id", "url", links.invalid_url(F.col("url")).alias("hit"))


def _sixteen() -> Column:
    return F.lpad(F.concat(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")), 16, "0")


_TAG_CASES = ", ".join(f"case when {n} then '{n}' end" for n in S.B_ORDER)
_OLD = "case when id < -40 then '' when id < 0 then 'kept,invalid_link,kept' else '' end"
_NEW_ONLY = ", ".join(f"case when {n} and not (id >= -40 and id < 0 and '{n}' = 'invalid_link') then '{n}' end" for n in S.B_ORDER)
_DOCS = "select doc_id::varchar as doc_id, coalesce(text, '') as text, source from documents"


def _table() -> dict[str, tuple[Query, str | None]]:
    out: dict[str, tuple[Query, str | None]] = {}
    csv = _round_trip(sinks.write_csv, logs.read_csv)
    out["src_csv"] = csv, _DOCS
    out["src_csv_pandas"] = _round_trip(sinks.write_csv, lambda s, p: logs.read_csv(s, p, na_tokens=True)), f"select doc_id, case when text in ({', '.join(S.lit(x) for x in logs.PANDAS_NA)}) then '' else text end as text, source from ({_DOCS})"
    out["src_csv_chunked"] = _round_trip(sinks.write_csv, lambda s, p: logs.read_csv(s, p, columns=["doc_id", "text", "source"], partitions=8)), _DOCS
    out["src_synth"] = _synth, None
    out["snk_csv"] = csv, _DOCS
    out["snk_parquet"] = _round_trip(sinks.write_parquet, lambda s, p: s.read.parquet(p)), _DOCS
    out["prj_keepcols"] = (lambda s, d: sinks.keep_columns(s.read.parquet(f"{d}/documents.parquet"), ["source", "nothing", "doc_id"])), "select source, doc_id from documents"
    out["prj_usecols"] = (lambda s, d: s.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")), "select doc_id, lang from documents"
    out["agg_union_parts"] = _union_parts, "select source, count(*) as n, count(distinct doc_id) as ids from documents group by source"
    out["snk_csv_append"] = _append, "select doc_id::varchar as doc_id, source from documents"
    out["flt_limit"] = _limits, "select rows_wanted::bigint as rows_wanted, case when rows_wanted = 0 then n else least(n, rows_wanted) end as rows_read from (values (0), (1), (7), (1000000000)) as l(rows_wanted), (select count(*) as n from documents)"
    out["prj_pair"] = (lambda s, d: turns(s, d).select("id", QUERY, ANSWER)), f"with {S._turns()} select id, query as {QUERY}, answer as {ANSWER} from turns"
    out["fn_column_missing"] = _column_missing, "select n::bigint as columns, rule, not (rule = 'empty_retrieved_docs' and n < 5) and not (rule = 'empty_search_query' and n < 3) as runs from (values " + ", ".join(f"('{n}')" for n in S.A_ORDER) + ") as r(rule), (values (2), (3), (5)) as c(n)"
    out["val_status"] = _status, "select log, status::bigint as status from (values ('as it is', 1), ('cleaned', 0), ('empty', 1)) as x(log, status)"

    out["fn_text_a"] = _value("text", _stripped(lambda c: c)), S.turns_part("text", "text")
    out["fn_safe_str"] = _value("text", text_of), S.turns_part("raw", "text")
    out["flt_blank_b"] = _value("hit", lambda c: blank(text_of(c))), S.turns_part(f"not {S.m('raw', S.NWS)}", "hit")
    out["fn_query_head"] = _value("head", lambda c: F.substring(text_of(c), 1, pack_b.QUERY_HEAD), QUERY), S.turns_part("head", "head")
    out["fn_scripts_in"] = _value("scripts", _stripped(lambda c: F.array_join(language.scripts_in(c), ","))), S.turns_part("concat_ws(',', " + ", ".join(f"case when {S.m('text', p)} then '{n}' end" for n, p in language.SCRIPTS.items()) + ")", "scripts")
    out["fn_dominant_script"] = _value("script", _stripped(language.dominant_script)), S.turns_part(S.PARTS["dominant"]("text"), "script")
    out["fn_prose_of"] = _value("prose", _stripped(markdown.prose_of)), S.prose_part("prose", "prose")
    out["fn_lines"] = _value("n", lambda c: F.size(py_lines(text_of(c))).cast("long")), S.turns_part(f"len({S.lines('raw')})", "n")
    out["fn_strip_noise"] = _value("clean", lambda c: language.strip_noise(text_of(c))), S.clean_part("clean", "clean")
    out["fn_detect_language"] = _value("lang", language.detect_language), S.clean_part("lang", "lang")
    out["fn_find_pii"] = _value("found", lambda c: F.to_json(pii.find_pii(c))), None
    out["fn_mask_pii"] = _value("masked", pii.mask_pii), None
    out["fn_mask_pii_tail"] = _value("masked", lambda c: pii.mask_pii(c, "#", 4)), None
    out["fn_valid_ipv4"] = (lambda s, d: s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", pii.valid_ipv4(F.concat_ws(".", F.col("o_orderkey") % 300, F.lit(1), F.lit(2), F.lit(3))).alias("hit"))), "select o_orderkey, o_orderkey % 300 <= 255 as hit from orders"
    digits = "lpad(o_orderkey::varchar || o_custkey::varchar, 16, '0')"
    out["fn_luhn16"] = (lambda s, d: s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", pii.luhn16(_sixteen()).alias("hit"))), f"select o_orderkey, list_sum([case when k % 2 = 1 and 2 * {digits}[k]::int > 9 then 2 * {digits}[k]::int - 9 when k % 2 = 1 then 2 * {digits}[k]::int else {digits}[k]::int end for k in range(1, 17)]) % 10 = 0 as hit from orders"
    out["fn_flags_existing"] = _existing, f"with {S._turns()} select id, {_OLD} as flags from t"
    out["fn_tally"] = (lambda s, d: s.read.parquet(f"{d}/orders.parquet").groupBy("o_orderstatus").agg(tally(F.count_if(F.col("o_custkey") > 10), F.count("*")).alias("tally"))), "select o_orderstatus, format('{:,} / {:,}', count(*) filter (where o_custkey > 10), count(*)) as tally from orders group by o_orderstatus"
    out["fn_is_null"] = (lambda s, d: _log(s, d).select("key", contract.is_null(F.col("key")).alias("hit"))), f"{_VAL.partition('f as (')[0].rstrip().rstrip(',')} select key, trim(key) = 'NA' as hit from r"
    out["fn_parse"] = (lambda s, d: _log(s, d).select("key", contract.parse_int(F.col("customer")).cast("long").alias("customer"), contract.parse_float(F.col("customer")).alias("share"), contract.parse_datetime(F.col("day")).isNotNull().alias("day"))), f"{_VAL.partition('f as (')[0].rstrip().rstrip(',')} select key, try_cast(case when customer = '12.0' then null else replace(customer, '_', '') end as bigint) as customer, replace(customer, '_', '')::double as share, day <> '2026-1-5' as day from r"

    for name in pack_a.PACK.names():
        out[f"a_{name}"] = _rule(pack_a.PACK, name), S.rule_a(name)
    out["a_fmt_corruption"] = _value("hit", _stripped(markdown.corrupt)), S.turns_part(S.PARTS["corrupt"], "hit")
    for part, of in (("table", markdown.broken_table), ("heading", markdown.broken_heading), ("emphasis", markdown.unpaired_emphasis), ("link", markdown.broken_link)):
        out[f"a_fmt_{part}"] = _value("hit", _prose(of)), S.prose_part(S.PARTS[part], "hit")
    out["a_template"] = (lambda s, d: turns(s, d).select("id", pack_a.any_null(turns(s, d)).alias("hit"))), f"with {S._turns()} select id, " + " or ".join(f"({c} is null or {S.strip(c)} in ('', 'NA', 'N/A', 'null', 'NULL', 'None', '-'))" for c in ("query", "answer", "search_query", "retrieved_docs")) + " as hit from turns"

    short = {"include_error_keyword": "b_error", "truncated_answer": "b_trunc", "language_mixing": "b_mix", "format_violation": "b_format", "contains_pii": "b_pii", "qa_language_mismatch": "b_lang_mismatch", "invalid_link": "b_link"}
    for name in pack_b.PACK.names():
        out[short[name]] = _rule(pack_b.PACK, name), S.rule_b(name)
    out["b_pii_counts"] = _pii_counts, None
    counted = S._count_lines
    out["b_fmt_table"] = _format_part(pack_b.is_table), S.clean_part(f"({counted("x like '|%' and x like '%|'")} >= 2 or {S.m('raw', f'(?i)<table(?:{S.WS}|>)')})", "hit")
    out["b_fmt_single_line"] = _format_part(pack_b.is_single_line), S.clean_part("len(ls) <= 1", "hit")
    out["b_fmt_bullets"] = _format_part(pack_b.is_bulleted), S.clean_part(f"{counted(S.m('x', f'^(?:[-*•·▪]|{S.D}+[.)]){S.WS}+'))} >= 2", "hit")
    out["b_fmt_numbered"] = _format_part(pack_b.is_numbered), S.clean_part(f"{counted(S.m('x', f'^{S.D}+[.)]{S.WS}+'))} >= 2", "hit")
    bare = S.strip(S.sub(S.strip("raw"), "(?m)^```(?:json)?|```$"))
    out["b_fmt_json"] = _format_part(pack_b.is_json), S.clean_part(f"({S.m(bare, r'^[\[{]')} and {S.m(bare, r'[\]}]$')})", "hit")
    out["b_url_invalid"] = _urls, f"with u0 as (select page_id, unnest([url, regexp_replace(url, '^https?://', 'www.'), '/' || url, substr(url, 1, 12)]) as url from pages), u1 as (select *, {S.strip('url')} as u, lower({S.strip('url')}) as low from u0) select page_id, url, {S._INVALID_B} as hit from u1"

    sums = ", ".join(f"count(*) filter (where {n}) as {n}" for n in pack_a.PACK.names())
    out["agg_features"] = (lambda s, d: tagging.summarize(turns(s, d))), f"{S.base_a()} select count(*) as rows, {sums} from ha"
    out["row_tags"] = _tags, f"{S.base_b()} select id, concat_ws(',', {_TAG_CASES}) as flags from hb"
    out["row_overwrite_flags"] = (lambda s, d: tagging.row_tags(_flagged(s, d)).select("id", F.array_join("Flags", ",").alias("flags"))), out["row_tags"][1]
    out["row_apply_flags"] = _apply_flags, f"{S.base_b()} select id, concat_ws(',', nullif({_OLD}, ''), {_NEW_ONLY}) as flags from hb"
    each = " union all ".join(f"select '{n}' as tag, count(*) filter (where {n}) as n, round(100.0 * count(*) filter (where {n}) / count(*), 4) as pct from hb" for n in S.B_ORDER)
    wide = max(map(len, S.B_ORDER))
    out["snk_tagcounts"] = _tag_lines, f"{S.base_b()}, counts as ({each}) select rpad(tag, {wide}, ' ') || '  ' || lpad(format('{{:,}}', n), 10, ' ') || ' (' || printf('%.2f', pct) || '%)' as line from counts"
    out["agg_tag_counts"] = (lambda s, d: tagging.tag_counts(turns(s, d))), f"{S.base_b()} {each}"

    for name, kinds in {"val_validate": ("nulls", "dtype", "range", "allowed", "missing", "undeclared"), "val_nulls": ("nulls",), "val_dtype": ("dtype",), "val_range": ("range",), "val_allowed": ("allowed",), "val_missing": ("missing",), "val_undeclared": ("undeclared",)}.items():
        out[name] = _val(*kinds)
    return out


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in _table().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _table().items() if sql}
