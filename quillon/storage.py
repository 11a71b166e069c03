"""Lineage cuts that survive the loss of executors.

Iterative operators write each round's table as Parquet below the shared folder
named by ``spark.checkpoint.dir``; only where that setting is absent and everything
runs on one machine is a local folder chosen, on a cluster its absence is an error.  Parquet rather than ``checkpoint()`` because
the reader gets column pruning and real size statistics for the next join.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a private one if the session names none and runs on one machine."""
    found = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {_SETTING} to a folder that all executors of {master} share")
        found = "file://" + tempfile.mkdtemp(prefix="quillon-")
        spark.conf.set(_SETTING, found)
        _delete_on_exit(spark, found)
    return found.rstrip("/")


def _fs_path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.deleteOnExit(p)


class Scratch:
    """Tables of one operator call; ``drop`` frees a round that is no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        _fs_path(spark, self.root)[0].mkdirs(_fs_path(spark, self.root)[1])
        _delete_on_exit(spark, self.root)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: the plan of the result is a plain scan."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def append(self, df: DataFrame, name: str) -> None:
        """Add rows to a table; whoever reads it later sees a single scan."""
        df.write.mode("append").parquet(f"{self.root}/{name}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        fs, p = _fs_path(self.spark, f"{self.root}/{name}")
        fs.delete(p, True)
