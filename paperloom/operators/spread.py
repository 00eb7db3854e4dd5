"""Rows of few, large pieces dealt over the cores of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tasks per core: enough that a core with short texts takes over from one with long texts.
TASKS_PER_CORE = 4
# Bytes of files in a task at most. Searching long texts takes seconds a megabyte, so the work of a
# task is bounded whatever the size of the table, of its files and of their row groups.
TASK_BYTES = 8 << 20
# From this many files per core on, the reader itself keeps all cores busy, since every file has a
# row group of its own.
FILES_PER_CORE = 16


def tasks_with_rows(df: DataFrame) -> int:
    """How many tasks of a scan get rows; a Parquet scan tells from the footers alone.

    A file is cut by bytes, but a row group goes whole to the task that its middle falls to, so a
    file of one row group is one task however many splits it has.
    """
    return df.select(F.spark_partition_id().alias("task")).distinct().count()


def scan_bytes(df: DataFrame) -> tuple[int, int]:
    """Bytes of files behind a scan: in all, and those of its largest task.

    A file counts in each task by its share of rows there; footers tell these as well.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")]
    shares = (
        df.select(F.spark_partition_id().alias("task"), *place)
        .groupBy("file", "size", "task")
        .agg(F.count("*").alias("n"))
    )
    whole = shares.groupBy("file").agg(F.sum("n").alias("of"))
    tasks = (
        shares.join(whole, "file")
        .groupBy("task")
        .agg(F.sum(F.col("size") * F.col("n") / F.col("of")).alias("bytes"))
    )
    total, largest = tasks.agg(F.sum("bytes"), F.max("bytes")).first()
    return int(total or 0), int(largest or 0)


def spread(df: DataFrame) -> DataFrame:
    """The same rows of a table of files, dealt out if its scan leaves cores idle or tasks large.

    For dear work per row, such as searching long texts: no task gets more than about
    ``TASK_BYTES``, so its time does not grow with the table. Columns that nothing reads are not
    shuffled. A scan that fills the cluster with small tasks by itself stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    total, largest = scan_bytes(df)
    filled = len(df.inputFiles()) >= FILES_PER_CORE * cores or tasks_with_rows(df) >= cores
    if filled and largest <= TASK_BYTES:
        return df
    return df.repartition(max(TASKS_PER_CORE * cores, -(-total // TASK_BYTES)))
