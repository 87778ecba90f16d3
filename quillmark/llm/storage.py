"""Scratch tables in the folder that all executors share.

Long plans are cut by writing a Parquet table to ``spark.checkpoint.dir`` and
reading it again: every later stage can then be recomputed after an executor is
lost without running the expensive steps before it once more.
"""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from quillmark.session import shared_dir


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application.

    Texts are long, so batches of rows for Python are made smaller than Spark's
    default, unless the session has its own size: the JVM and the worker each hold
    one or two for each task.
    """
    sc = spark.sparkContext
    name, default, own = _BATCH
    if spark.conf.get(name) == default:
        spark.conf.set(name, own)
    if getattr(sc, "_quillmark_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="quillmark-code-")
    target = os.path.join(folder, "quillmark_code.zip")
    with zipfile.ZipFile(target, "w") as out:
        for place, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    whole = os.path.join(place, name)
                    out.write(whole, os.path.relpath(whole, os.path.dirname(top)))
    sc.addPyFile(target)
    sc._quillmark_shipped = True


class Scratch:
    """Tables of one query. They go when the driver ends, or earlier by :meth:`drop` and :func:`clear`."""

    every: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str) -> None:
        ship(spark)
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.every.append(self)
        atexit.register(self._remove, self.path)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Writes ``df`` and returns it as read from the written files."""
        path = f"{self.path}/{name}"
        schema = df.schema
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, name: str) -> None:
        self._remove(f"{self.path}/{name}")

    def free(self) -> None:
        """Lets Spark remove the shuffle files of plans that are no longer held; else they stay until the driver's heap is full."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def _remove(self, path: str) -> None:
        try:
            sc = self.spark.sparkContext
            place = sc._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # the session has already ended; the folder is the cluster's to clear
            pass


def clear() -> None:
    """Removes the tables of all queries so far; for long sessions, once their results are written."""
    while Scratch.every:
        one = Scratch.every.pop()
        atexit.unregister(one._remove)
        one._remove(one.path)
