"""Packs over tables: summaries, tag lists, flag columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quillmark.operators import pack_a, pack_b
from quillmark.plans.registry import ANSWER, QUERY, Pack

ABSENT = "n/a (컬럼 없음)"


def summarize(df: DataFrame, pack: Pack = pack_a.PACK) -> DataFrame:
    """One row: the number of rows and of hits of each rule, in one scan; null for rules whose column is absent."""
    there = {r.name for r in pack.present(df.columns)}
    hits = pack.hits(df)
    return hits.agg(F.count(F.lit(1)).alias("rows"), *[(F.count_if(F.col(f"`{n}`")) if n in there else F.lit(None).cast("long")).alias(n) for n in pack.names()])


def metrics(df: DataFrame, pack: Pack = pack_a.PACK) -> dict[str, str]:
    """Rule name to ``hits / rows``, in the pack's order; ``rows`` comes last."""
    row = summarize(df, pack).first()
    out = {n: ABSENT if row[n] is None and row["rows"] else f"{row[n] or 0:,} / {row['rows']:,}" for n in pack.names()}
    return {**out, "rows": f"{row['rows']:,}"}


def tags(pack: Pack = pack_b.PACK) -> Column:
    """Over the columns of :meth:`Pack.hits`: the names of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(F.col(f"`{n}`"), F.lit(n)) for n in pack.names()]))


def _as_turns(df: DataFrame, query_col: str, answer_col: str) -> DataFrame:
    pick = lambda c: F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string")
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), pick(query_col).alias(QUERY), pick(answer_col).alias(ANSWER))


def row_tags(df: DataFrame, query_col: str = QUERY, answer_col: str = ANSWER, out_col: str = "Flags", pack: Pack = pack_b.PACK) -> DataFrame:
    """``df`` with the list of tags in ``out_col``, whatever was there."""
    out = pack.hits(_as_turns(df, query_col, answer_col))
    return out.select(*[F.col("__row")[c].alias(c) for c in df.columns if c != out_col], tags(pack).alias(out_col))


def existing_flags(c: Column) -> Column:
    """A flag cell as a list: the text form of a list is read, other text is one flag."""
    s = F.coalesce(c.cast("string"), F.lit(""))
    bare = F.btrim(s)
    quoted = r"""^[\[(]\s*(?:(?:'[^'\\]*'|"[^"\\]*")\s*(?:,\s*|(?=[\])])))*[\])]$"""
    inside = F.regexp_extract_all(bare, F.lit(r"""'([^'\\]*)'|"([^"\\]*)\""""), F.lit(0))
    listed = F.transform(inside, lambda x: F.substring(x, F.lit(2), F.length(x) - 2))
    return F.when(bare.isin("", "[]", "nan"), F.array().cast("array<string>")).when(bare.rlike(quoted), listed).otherwise(F.array(s))


def apply_flags(df: DataFrame, query_col: str = QUERY, answer_col: str = ANSWER, flag_col: str = "Flags", append: bool = True, pack: Pack = pack_b.PACK) -> DataFrame:
    """``df`` with the tags added to those in ``flag_col``, in order and each once; what is there stays as it is."""
    if flag_col not in df.columns or not append:
        return row_tags(df, query_col, answer_col, flag_col, pack)
    is_list = df.schema[flag_col].dataType.simpleString().startswith("array")
    hits = pack.hits(_as_turns(df, query_col, answer_col))
    old = F.col("__row")[flag_col]
    old = F.coalesce(old, F.array().cast("array<string>")) if is_list else existing_flags(old)
    out = hits.select("__row", old.alias("__old"), tags(pack).alias("__new"))
    merged = F.concat("__old", F.array_except("__new", "__old"))
    return out.select(*[(merged if c == flag_col else F.col("__row")[c]).alias(c) for c in df.columns])


def tag_counts(df: DataFrame, query_col: str = QUERY, answer_col: str = ANSWER, pack: Pack = pack_b.PACK) -> DataFrame:
    """(tag, n, pct) for every tag of the pack, also those without a hit; in one scan."""
    hits = pack.hits(_as_turns(df, query_col, answer_col))
    counted = hits.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f"`{n}`")).alias(n) for n in pack.names()])
    pairs = F.array(*[F.struct(F.lit(n).alias("tag"), F.col(f"`{n}`").alias("n")) for n in pack.names()])
    out = counted.select("rows", F.explode(pairs).alias("x"))
    share = F.when(F.col("rows") > 0, F.round(100 * F.col("x.n") / F.col("rows"), 4)).otherwise(F.lit(0.0))
    return out.select("x.tag", "x.n", share.alias("pct"))


def observed_counts(df: DataFrame, flag_col: str = "Flags", pack: Pack = pack_b.PACK) -> tuple[DataFrame, Observation]:
    """``df`` and counts that the job which writes it gathers on the way."""
    seen = Observation("tags")
    counts = [F.count_if(F.array_contains(F.col(f"`{flag_col}`"), n)).alias(n) for n in pack.names()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen
