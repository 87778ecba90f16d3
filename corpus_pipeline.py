"""From documents to token ids in five stages, each written as Parquet and read again.

Every stage works on all that the one before it kept. The first four return the
columns of documents; where a stage changes the text, n_chars follows. Defined
results: the stages keep those of the operators they call. Documents without an
id pass or fail each by itself, but never stand for a group that has ids. Extra
columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.llm import bloom, bpe, decontaminate, line_dedup, quality_rules, simhash
from quillmark.llm.storage import Scratch

#: SimHash groups can't be expressed in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with numbered columns, so that none is named like one an operator adds, and the number of each name."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _documents(out: DataFrame, text: str, names: dict[str, str], docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with the text from column ``text`` of ``out``, and its length."""
    size = F.length(F.col(text)).cast(docs.schema["n_chars"].dataType) if "n_chars" in names else None
    made = {"text": F.col(text), "n_chars": size}
    return out.select(*[made.get(c, F.col(i)).alias(f"out_{i}") for c, i in names.items()]).toDF(*docs.columns)


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines common to a host go, and documents that the quality rules reject."""
    frame, names = _numbered(docs)
    out = quality_rules.rules(frame, names["doc_id"], names["text"], names["source"]).where("kept")
    return _documents(out, "clean_text", names, docs)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents have go, but for one document; all documents stay."""
    frame, names = _numbered(docs)
    return _documents(line_dedup.dedup_lines(frame, names["doc_id"], names["text"]), names["text"], names, docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that with the least id, or if none has an id, with the least digest.

    Rows repeated under one id are one document, and so are equal texts without
    an id; of these the row whose columns come first as JSON stays.
    """
    scratch = Scratch(spark, "groups")
    keys = [F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))]
    row = F.struct(keys[0].isNull().alias("n"), keys[0].alias("i"), keys[1].alias("t"))  # a null id comes last
    classes = scratch.table(simhash.near_duplicates(docs.select(row.alias("row"), "text"), "row"), "classes")
    heads = classes.where("row = component_id").groupBy("row.i", "row.t").agg(F.count("*").alias("n"))
    first = heads.groupBy("i", F.when(F.col("i").isNull(), F.col("t")).alias("g")).agg(F.min("t").alias("t"), F.min_by("n", "t").alias("n"))
    first = scratch.table(first.select("i", "t", "n"), "first")
    every = classes.select("row.i", "row.t").distinct()
    gone = scratch.table(every.join(first, every.i.eqNullSafe(first.i) & (every.t == first.t), "left_anti"), "gone")
    kept = bloom.without(docs, keys, gone)
    again = scratch.table(first.where("n > 1").select("i", "t"), "again")
    once = bloom.without(kept, keys, again)
    if once is kept:
        return kept
    frame, names = _numbered(kept)
    own = F.xxhash64(F.coalesce(F.col(names["text"]), F.lit("")))
    same = F.col(names["doc_id"]).eqNullSafe(F.col("i")) & (own == F.col("t"))
    order = Window.partitionBy(names["doc_id"], own).orderBy(F.to_json(F.struct(*names.values())))
    twice = frame.join(again, same, "left_semi").withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")
    return once.union(twice.toDF(*docs.columns))


def leaks_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the digest of what they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN, bytes_col="decoded")
    return coded.select("doc_id", "lang", "source", "ids", *bpe.digests(coded))


STAGES = [
    ("quality rules", rules_stage),
    ("line dedup", lines_stage),
    ("near dedup", near_stage),
    ("decontamination", leaks_stage),
    ("tokens", tokens_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), str(i))
        if i:
            scratch.drop(str(i - 1))  # its rows are in the table of this stage
    return docs
