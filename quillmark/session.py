"""Session settings that the engine expects."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(cores: int | None = None, settings: dict[str, str] | None = None) -> SparkSession:
    """The running session, or a new one: the cluster's master if it names one, else local cores."""
    builder = SparkSession.builder.appName("quillmark")
    if SparkSession.getActiveSession() is None:
        from pyspark import SparkConf

        if not SparkConf().contains("spark.master"):
            builder = builder.master(f"local[{cores or '*'}]").config("spark.sql.shuffle.partitions", "8")
    for name, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        **(settings or {}),
    }.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it; a temporary one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="quillmark-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def spread(df: DataFrame) -> DataFrame:
    """An input with fewer splits than cores is dealt over all of them; any other is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
