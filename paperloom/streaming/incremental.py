"""Incremental ingest of landed responses with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from paperloom import schemas
from paperloom.sources.bucketed import BucketedTable
from paperloom.sources.files import SnapshotTable, path_exists
from paperloom.sources.mappers import Source, map_responses

ARRIVAL = "_arrival"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: str = schemas.LANDED,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of landed JSON files.

    Without ``files_per_batch`` a run takes everything new as one batch, which suits sinks
    that rewrite a snapshot per batch.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def document_stream(landed: DataFrame, source: Source, rank: int = 0) -> DataFrame:
    """Mapped documents of a stream of landed responses; stateless."""
    return map_responses(landed, source, rank)


def first_seen(
    docs: DataFrame, keys: list[str], event_time: str | None = None, delay: str = "1 day"
) -> DataFrame:
    """Documents whose key has not been seen before.

    With ``event_time`` the watermark bounds the state, and rows more than ``delay`` behind the
    latest one are dropped. Without it the state holds every key and no row is too late.
    """
    if event_time is None:
        return docs.dropDuplicates(keys)
    return docs.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def first_seen_stream(
    docs: DataFrame, keys: list[str], path: str, checkpoint: str, keep: str = "1 hour"
) -> StreamingQuery:
    """Write the first document of each key to ``path``, with bounded state and without loss.

    The stream's state holds the keys that arrived within the last ``keep``, in RocksDB. Time is
    that of arrival, so however old a document is, it is not too late; what must hold is that the
    clock of a restarted driver is not behind by ``keep`` or more. A key that comes again later
    passes the state once more and is settled against the keys already written, by an anti join
    per batch. Documents without a key are alike.

    Batch n is the folder ``batch=n``; one that is run again after a failure is settled against the
    batches before it only and written anew. ``read_first_seen`` reads what is complete.
    """
    spark = docs.sparkSession
    recent = (
        docs.withColumn(ARRIVAL, F.current_timestamp())
        .withWatermark(ARRIVAL, keep)
        .dropDuplicatesWithinWatermark(keys)
        .drop(ARRIVAL)
    )

    def settle(batch: DataFrame, batch_id: int) -> None:
        earlier = read_first_seen(batch.sparkSession, path, batch.schema).where(
            F.col("batch") < batch_id
        )
        known = earlier.select(*[F.col(k).alias(f"_{n}") for n, k in enumerate(keys)])
        same = reduce(
            lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{n}")) for n, k in enumerate(keys)]
        )
        fresh = batch.join(known, same, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        # A stream keeps the settings that it started with.
        return (
            recent.writeStream.foreachBatch(settle)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def read_first_seen(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Documents written by ``first_seen_stream``, with the number of their batch."""
    whole = StructType([*schema.fields, StructField("batch", LongType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", path).parquet(path)


def upsert_stream(
    docs: DataFrame,
    table: SnapshotTable | BucketedTable,
    checkpoint: str,
    order: str = "ingest_seq",
    after_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Merge each micro-batch into the snapshot table; a bucketed one writes only what changes.

    Values are folded by ``order``, which the snapshot remembers per value, so files may be
    cut into batches in any way and may arrive late; only the ids follow the arrival.

    Batch n writes version n + 1 from version n. A batch that is run again after a failure
    finds its version complete and does nothing, or rewrites it from the same input. A table
    therefore belongs to one checkpoint folder. A stream that was stopped or failed goes on from
    its checkpoint, and every response is merged exactly once.

    ``after_batch`` is called with the number of a batch once its version is complete, before the
    stream notes the batch as done; what it raises ends the stream.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id + 1, order)
        if after_batch is not None:
            after_batch(batch_id)

    return (
        docs.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
