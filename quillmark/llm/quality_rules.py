"""Quality rules: word and line statistics of a text, and lines common to a host.

Line frequency: a line is normalised (lower case, runs of blanks to one space)
and hashed. Per host the distinct documents with that hash are counted; copies of
one text are one document, else a page that is mirrored would lose all its lines.
A line is common if more than ``max_documents`` of the host's documents have it,
or, on small hosts, ``min_documents`` or more and over ``max_share`` of all.
Common lines are removed from the text, and a document of which fewer than
``min_words`` words or less than ``min_share`` of its words remain is rejected.

Only built-in expressions are used. Per line 36 bytes are written and shuffled,
never its text; a line that a third of all documents share is one key, counted by
partial sums. A document's text moves once, to meet the numbers of its common
lines, and not at all where ``clean_text`` isn't asked for.

Defined results: a null or empty text has no words and fails the base rules; a
null text stays null. A null host is a host. Equal rows get equal results each,
also without an id. An empty table gives no rows. Output columns take the place
of input columns of their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.native import BLANKS, Columns, let, words
from quillmark.llm.storage import Scratch

WINDOW = 5
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_DOCUMENTS = 100
MIN_DOCUMENTS = 5
MAX_SHARE = 0.1
MIN_SHARE = 0.3
#: What isn't a single space inside a line.
_UNEVEN = r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]"


def _windows(w: Column) -> Column:
    """A hash of the five words from each position on."""
    at = F.sequence(F.lit(0), F.size(w) - WINDOW)
    return F.when(F.size(w) >= WINDOW, F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])))


def _covered(h: Column) -> Column:
    """Words in windows whose hash is there more than once."""
    ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def twice(p: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
        found = F.filter(p, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    def total(q: Column) -> Column:
        parts = F.transform(q, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(q, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(parts, F.lit(0), lambda a, b: a + b)

    return let(let(ordered, twice), total)


def _word_statistics(text: Column) -> Column:
    def repeats(h: Column) -> Column:
        return F.when(h.isNull() | (F.size(F.array_distinct(h)) == F.size(h)), F.lit(0)).otherwise(_covered(h))

    def all_of(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), let(_windows(w), repeats).cast("long").alias("n_repeat_words"))

    return let(words(text), all_of)


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, "")).cast("long")


def _base(text: Column) -> dict[str, Column]:
    """The base statistics of a text that isn't null."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return {
        "w": _word_statistics(text),
        "word_chars": _without(text, BLANKS),
        "n_symbols": F.length(text) - _without(text, SYMBOLS),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def _line_rows(text: Column) -> Column:
    """(number, hash, words) of each line with a word."""
    even = F.regexp_replace(F.lower(text), _UNEVEN, " ")

    def row(line: Column, i: Column) -> Column:
        return let(F.btrim(line, F.lit(BLANKS)), lambda b: F.struct(i.alias("i"), F.xxhash64(b).alias("h"), (F.length(b) - F.length(F.replace(b, F.lit(" "), F.lit(""))) + 1).alias("n"), (b != "").alias("on")))

    return F.filter(F.transform(F.split(even, "\n"), row), lambda x: x["on"])


def _without_lines(text: Column, at: Column) -> Column:
    """The text without the lines numbered ``at``, sorted: what lies between them is taken in slices, so the work is linear."""

    def cut(lines: Column) -> Column:
        def piece(k: Column) -> Column:
            begin = F.coalesce(F.get(at, k - 1) + 1, F.lit(0))
            return F.slice(lines, begin + 1, F.coalesce(F.get(at, k), F.size(lines)) - begin)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(at)), piece)), "\n")

    return let(F.split(text, "\n"), cut)


def common_lines(lines: DataFrame, max_documents: int, min_documents: int, max_share: float) -> DataFrame:
    """``lines(t, host, h)`` -> (host, h) of the lines above the limits; ``t`` tells documents apart."""
    counts = lines.groupBy("host", "h").agg(F.countDistinct("t").alias("docs")).where(F.col("docs") >= min(min_documents, max_documents + 1))
    hosts = lines.groupBy("host").agg(F.countDistinct("t").alias("of")).select(F.col("host").alias("host_of"), "of")
    above = (F.col("docs") > max_documents) | ((F.col("docs") >= min_documents) & (F.col("docs") > max_share * F.col("of")))
    return counts.join(hosts, F.col("host").eqNullSafe(F.col("host_of"))).where(above).select("host", "h")


def rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    min_documents: int = MIN_DOCUMENTS,
    max_share: float = MAX_SHARE,
    min_words: int = MIN_WORDS,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_common_lines, n_common_words, kept and clean_text (the text without common lines)."""
    given = Columns(docs)
    raw, name, host = given[text_col], given[id_col], given[host_col]
    text = F.coalesce(raw, F.lit(""))
    # all uses read the same small table, so texts are parted into lines once
    rows = given.frame.select(name.alias("id"), F.xxhash64(text).alias("t"), host.alias("host"), F.explode(_line_rows(text)).alias("x"))
    lines = Scratch(docs.sparkSession, "lines").table(rows.select("id", "t", "host", "x.i", "x.h", "x.n"), "lines")
    common = common_lines(lines, max_documents, min_documents, max_share).select(F.col("host").alias("host2"), F.col("h").alias("h2"))
    hits = lines.join(common, F.col("host").eqNullSafe(F.col("host2")) & (F.col("h") == F.col("h2")))
    # rows repeated under an id have the same lines
    hits = hits.groupBy("id", "t", "host", "i").agg(F.max("n").alias("n"))
    hits = hits.groupBy("id", "t", "host").agg(F.sum("n").cast("long").alias("common_words"), F.sort_array(F.collect_list("i")).alias("at"))
    hits = hits.select(F.col("id").alias("id2"), F.col("t").alias("t2"), F.col("host").alias("host3"), "common_words", "at")
    base = given.frame.select("*", F.xxhash64(text).alias("own"), *[c.alias(n) for n, c in _base(text).items()])
    # the hashed side has one small row for a document at most, so no task gets many of them
    same = name.eqNullSafe(F.col("id2")) & (F.col("own") == F.col("t2")) & host.eqNullSafe(F.col("host3"))
    out = base.join(hits.hint("shuffle_hash"), same, "left")
    n, repeated = F.col("w.n_words"), F.col("w.n_repeat_words")
    gone = F.coalesce("common_words", F.lit(0)).cast("long")
    failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)
    depleted = (n - gone < min_words) | (n - gone < min_share * n)
    made = {
        "n_words": n,
        "word_chars": F.col("word_chars"),
        "n_symbols": F.col("n_symbols"),
        "n_dup_lines": F.col("n_dup_lines"),
        "n_repeat_words": repeated,
        "base_failed": failed,
        "n_common_lines": F.when(F.col("at").isNull(), 0).otherwise(F.size("at")).cast("long"),
        "n_common_words": gone,
        "kept": ~failed & ~depleted,
        "clean_text": F.when(F.col("at").isNull(), raw).otherwise(_without_lines(raw, F.col("at"))),
    }
    return given.back(out, made)


def op4(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return rules(docs).drop("text", "source", "clean_text")


OP4_SQL = rf"""
with w as (
  select doc_id, source, coalesce(text, '') as text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
  from documents),
windows as (
  select doc_id, p, array_to_string(words[p:p + 4], ' ') as win
  from (select doc_id, words, unnest(range(1, len(words) - 3)) as p from w)),
repeated as (
  select doc_id, count(distinct p + o) as n from (
    select doc_id, p, count(*) over (partition by doc_id, win) as c from windows), range(0, 5) r(o)
  where c > 1 group by doc_id),
rows as (
  select doc_id, source, md5(text) as t, line, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') as bare
  from (select doc_id, source, text, unnest(string_split(text, chr(10))) as line from w)),
lines as (select *, len(string_split(bare, ' ')) as n from rows where bare <> ''),
hosts as (select source, count(distinct t) as of from lines group by source),
counts as (select source, bare, count(distinct t) as docs from lines group by source, bare),
common as (
  select c.source, c.bare from counts c join hosts h on c.source is not distinct from h.source
  where docs > {MAX_DOCUMENTS} or (docs >= {MIN_DOCUMENTS} and docs > {MAX_SHARE} * of)),
hits as (
  select doc_id, sum(n) as n, count(*) as k from lines l join common c on l.bare = c.bare and l.source is not distinct from c.source group by doc_id),
dups as (select doc_id, count(*) - count(distinct line) as n from lines group by doc_id),
base as (
  select w.doc_id, len(words)::bigint as n_words, length(array_to_string(words, '')) as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(dups.n, 0) as n_dup_lines, coalesce(repeated.n, 0) as n_repeat_words, coalesce(hits.n, 0)::bigint as n_common, coalesce(hits.k, 0)::bigint as n_common_lines
  from w left join dups using (doc_id) left join repeated using (doc_id) left join hits using (doc_id)),
failed as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed from base)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_common_lines, n_common as n_common_words,
       not base_failed and n_words - n_common >= {MIN_WORDS} and n_words - n_common >= {MIN_SHARE} * n_words as kept
from failed
"""
