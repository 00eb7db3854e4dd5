"""Tables laid out for the questions asked of them: partitioned by state, bucketed by id.

A selection by state reads the folders of that state only, and tables with the same buckets join
and aggregate by id without a shuffle. Buckets are a property of a table of the session's catalog;
``attach`` tells another session of files that are already there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_layout(
    df: DataFrame,
    name: str,
    path: str,
    buckets: int,
    key: str = "document_id",
    partition: str | None = None,
) -> DataFrame:
    """Write ``df`` as table ``name`` below ``path``; returns the table.

    Rows are dealt by the hash that buckets use, so each task writes one bucket and there is one
    file per bucket and state. All rows of a key are in one bucket, those without a key too; rows of
    one state are in all of them, so a state that holds most rows is no hot spot. Buckets do not
    split: choose their number so that one fits a task. ``name`` and files must be new.
    """
    writer = df.repartition(buckets, key).write.format("parquet").mode("error")
    if partition:
        writer = writer.partitionBy(partition)
    writer.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def attach(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType,
    buckets: int,
    key: str = "document_id",
    partition: str | None = None,
) -> DataFrame:
    """Files of ``write_layout`` as table ``name`` of this session; the numbers must be theirs."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by_state = f"PARTITIONED BY (`{partition}`)" if partition else ""
    spark.sql(
        f"CREATE TABLE `{name}` ({columns}) USING parquet {by_state} CLUSTERED BY (`{key}`) "
        f"SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    if partition:
        spark.sql(f"ALTER TABLE `{name}` RECOVER PARTITIONS")
    return spark.table(name)
