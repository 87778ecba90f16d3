"""Licence scans by canonical digests of entire texts.

A text is made canonical as the matching guidelines for licence lists ask: lower
case, one form of quotes and dashes, copyright lines and "all rights reserved"
dropped, punctuation, marks of comments and runs of blanks to one space,
equivalent spellings to one. Its SHA-256 is joined with the digests of known
licences, so a text is that licence or it isn't. Lines that may name a licence
are looked up in the same way among known notices: a line can only be one if it
has a word out of a set of which every notice has one, found from the notices.

Known texts are the built-in ones or a table ``(license_id, text)``; only digests
take part in the joins. Texts without a notice aren't moved by the lines' join as
long as its side of matches is small enough for Spark to send it to all tasks.

Defined results: a null text counts as empty; an empty canonical text has no
licence. A text that two entries share names the least id. Equal rows get equal
results each; an empty table gives no rows. Output columns take the place of
input columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.license_texts import DIGESTS, EQUIVALENT, known_texts, notices
from quillmark.llm.native import Columns

_MARGIN = r"[ \t/*#;!<>%-]*"
#: Words after "copyright" in the running text of licences; a line that goes on otherwise names an owner.
_RUNNING = "notices?|holders?|owners?|licen[cs]es?|laws?|statements?|interests?|rights?|protection|permissions?|disclaimer|infringement|claims?|treaty|treaties|act|and|or|in|is|of|on|to|that|which|shall|under|as|will|may|also|the[ \t]+software"
_OWNED = rf"{_MARGIN}(?:copyright|copr\.)"
_OWNED_NOT = rf"(?:ed\b|s\b|able\b|[ \t]+(?:{_RUNNING})\b)"
_SIGNED = rf"{_MARGIN}(?:\(c\)[ \t]|©)"
_COPYRIGHT = rf"(?md)^(?:{_OWNED}(?!{_OWNED_NOT})|{_SIGNED}).*$|\ball rights reserved\.?"


def canonical(text: Column) -> Column:
    """The canonical form; words are parted by one space."""
    out = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("\r"), F.lit("\n"))
    some = out.contains("copyright") | out.contains("copr.") | out.contains("(c)") | out.contains("©") | out.contains("all rights reserved")
    out = F.when(some, F.regexp_replace(out, _COPYRIGHT, " ")).otherwise(out)
    out = F.regexp_replace(F.replace(out, F.lit("https://"), F.lit("http://")), r"[^\p{L}\p{N}]+", "  ")
    out = F.concat(F.lit(" "), out, F.lit(" "))
    spelled = out
    for old, new in EQUIVALENT.items():
        spelled = F.replace(spelled, F.lit(f" {old} "), F.lit(f" {new} "))
    out = F.when(out.rlike(" (?:" + "|".join(sorted(EQUIVALENT)) + ") "), spelled).otherwise(out)
    return F.btrim(F.replace(out, F.lit("  "), F.lit(" ")))


def _digest(form: Column) -> Column:
    return F.sha2(form.cast("binary"), 256)


def digests(licenses: DataFrame) -> DataFrame:
    """``licenses(license_id, text)`` -> (license_id, digest), one for each digest."""
    rows = licenses.select("license_id", canonical(F.col("text")).alias("form")).where("form <> ''")
    return rows.groupBy(_digest(F.col("form")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def known(spark: SparkSession) -> DataFrame:
    """(license_id, digest) of the built-in licences: short ones as texts, with and without a title, long ones as digests."""
    texts = digests(spark.createDataFrame(known_texts(), "license_id string, text string"))
    return texts.unionByName(spark.createDataFrame([(i, d) for i, each in sorted(DIGESTS.items()) for d in each], "license_id string, digest string"))


def telling_words(lines: Iterable[str]) -> list[str]:
    """Words of which every line has one in its canonical form, few and long ones first; with their other spellings."""
    forms = [set(_form(x).split()) for x in lines]
    out: list[str] = []
    while forms := [f for f in forms if f]:
        counts: dict[str, int] = {}
        for f in forms:
            for w in f:
                counts[w] = counts.get(w, 0) + 1
        best = max(sorted(counts), key=lambda w: (counts[w] * (len(w) > 3), len(w)))
        out += [best, *(old for old, new in EQUIVALENT.items() if new == best)]
        forms = [f for f in forms if best not in f]
    return out


def _form(text: str) -> str:
    """The canonical form of a short notice in code: ASCII, without copyright lines."""
    bare = "".join(c if c.isalnum() else " " for c in text.lower().replace("https://", "http://"))
    return " ".join(EQUIVALENT.get(w, w) for w in bare.split())


def scan(docs: DataFrame, licenses: DataFrame | None = None, named: dict[str, str] | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with canonical_sha256, license_id (null: none) and notice_ids (those of lines, in order, each once)."""
    spark = docs.sparkSession
    given = Columns(docs)
    text = F.coalesce(given[text_col], F.lit(""))
    table = (known(spark) if licenses is None else digests(licenses)).select(F.col("digest").alias("whole_of"), "license_id")
    lines = named if named is not None else notices()
    own = F.md5(text.cast("binary"))
    telling = "(?i)" + "|".join(rf"\Q{w}\E" for w in telling_words(lines))
    # lines of which one may be a notice, once for each different text
    found = given.frame.select(own.alias("t"), F.explode(F.array_distinct(F.filter(F.split(text, "[\r\n]"), lambda x: x.rlike(telling)))).alias("line"))
    found = found.select("t", _digest(canonical(F.col("line"))).alias("digest")).distinct()
    known_lines = digests(spark.createDataFrame(sorted((i, t) for t, i in lines.items()), "license_id string, text string"))
    found = found.join(known_lines, "digest").groupBy("t").agg(F.array_sort(F.collect_set("license_id")).alias("ids"))
    out = given.frame.select("*", own.alias("own"), _digest(canonical(text)).alias("whole"))
    out = out.join(table, F.col("whole") == F.col("whole_of"), "left").join(found, F.col("own") == F.col("t"), "left")
    return given.back(out, {"canonical_sha256": F.col("whole"), "license_id": F.col("license_id"), "notice_ids": F.coalesce("ids", F.array().cast("array<string>"))})


def op5(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).select("doc_id", "canonical_sha256", "license_id", F.array_join("notice_ids", ",").alias("notice_ids"))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    """The same in SQL, which has no look-ahead: copyright lines are found line by line."""
    owner = f"regexp_matches(x, '^{_OWNED}') and not regexp_matches(x, '^{_OWNED}{_OWNED_NOT}') or regexp_matches(x, '^{_SIGNED}')"
    out = f"array_to_string([case when {owner} then ' ' else x end for x in string_split(replace(lower({text}), chr(13), chr(10)), chr(10))], chr(10))"
    out = f"regexp_replace({out}, '\\ball rights reserved\\.?', ' ', 'g')"
    out = f"' ' || regexp_replace(replace({out}, 'https://', 'http://'), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || ' '"
    for old, new in EQUIVALENT.items():
        out = f"replace({out}, ' {old} ', ' {new} ')"
    return f"trim(replace({out}, '  ', ' '), ' ')"


def op5_sql() -> str:
    values = ", ".join(f"({_sql_text(i)}, {_sql_text(t)})" for i, t in known_texts())
    long = ", ".join(f"('{i}', '{d}')" for i, each in sorted(DIGESTS.items()) for d in each)
    named = ", ".join(f"({_sql_text(i)}, {_sql_text(_form(t))})" for t, i in sorted(notices().items()))
    return f"""
with licenses(license_id, text) as (values {values}),
long(license_id, digest) as (values {long}),
named(notice_id, form) as (values {named}),
known as (select digest, min(license_id) as license_id from (
  select license_id, sha256({_sql_canonical("text")}) as digest from licenses union all select license_id, digest from long) group by digest),
lines as (select doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '[\\r\\n]')) as line from documents),
few as (select * from lines where length(line) < 400),
found as (
  select doc_id, string_agg(distinct notice_id, ',' order by notice_id) as ids
  from (select doc_id, {_sql_canonical("line")} as form from few) l join named using (form) group by doc_id),
docs as (select doc_id, sha256({_sql_canonical("coalesce(text, '')")}) as canonical_sha256 from documents)
select doc_id, canonical_sha256, license_id, coalesce(ids, '') as notice_ids
from docs left join known on canonical_sha256 = digest left join found using (doc_id)
"""
