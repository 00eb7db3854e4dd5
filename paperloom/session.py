"""Where jobs may put intermediate tables.

Everything intermediate goes to the shared folder that the cluster names in
``spark.checkpoint.dir``. Where it is unset, a local master, whose executors are
threads of the driver, gets a folder of its own; a cluster has to name one.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Spark then deletes the shuffle files of a write at its end, not when the driver's JVM happens
#: to collect the objects that stand for them.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SLICE = "_slice"


def shared_dir(spark: SparkSession) -> str:
    """Return the shared folder for intermediate data, without a trailing slash."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a folder that all executors can reach"
            )
        configured = tempfile.mkdtemp(prefix="paperloom-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so never overwritten."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each write inside at its end."""
    before = spark.conf.get(CLEANUP_CONF, "false")
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_CONF, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back with its own schema.

    Later stages start from the files, so lost executors cost at most the stage that runs.
    Size estimates are those of the files; a checkpoint would keep the estimates of the plan
    it came from, which multiply with every join of a loop. The shuffle files of the write go
    with it, since nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete a table made by ``written`` that no later plan reads."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        remove(spark, spark._jvm.org.apache.hadoop.fs.Path(file).getParent().toString())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared one that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


class Slices:
    """``df`` as a table in the shared folder, dealt to ``n`` slices by a number.

    Each slice is a folder of its own, so that it can be read and deleted without the others.
    """

    def __init__(self, df: DataFrame, number: Column, n: int, name: str) -> None:
        self.spark, self.schema = df.sparkSession, df.schema
        self.path = scratch_path(self.spark, name)
        dealt = df.withColumn(SLICE, F.pmod(number, F.lit(n)).cast("int"))
        with shuffles_dropped(self.spark):
            dealt.write.partitionBy(SLICE).option("compression", "zstd").parquet(self.path)

    def all(self) -> DataFrame:
        """The rows of all slices, with the number of their slice."""
        schema = StructType([*self.schema.fields, StructField(SLICE, IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self, slices: list[int]) -> DataFrame:
        folders = [f for f in map(self._folder, slices) if path_exists(self.spark, f)]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def drop(self, slices: list[int]) -> None:
        for k in slices:
            remove(self.spark, self._folder(k))

    def _folder(self, k: int) -> str:
        return f"{self.path}/{SLICE}={k}"
