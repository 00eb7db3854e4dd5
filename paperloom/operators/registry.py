"""Per-source counts, registry refresh and run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def source_counts(sources: DataFrame, docs: DataFrame, key: str = "source_id") -> DataFrame:
    """Documents per source name, 0 for sources without any.

    Documents are counted before the join, so what is joined has one row per source.
    """
    counts = docs.groupBy(key).agg(F.count("document_id").alias("_n"))
    return (
        sources.join(counts, key, "left")
        .groupBy("name")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("doc_count"))
    )


def with_grand_total(counts: DataFrame) -> DataFrame:
    """Counts per source plus one row with a null name for all of them."""
    return counts.rollup("name").agg(F.sum("doc_count").alias("doc_count"))


def refresh_registry(
    registry: DataFrame, counts: DataFrame, crawled_at: Column | None = None
) -> DataFrame:
    """Registry with counts filled in; every row is marked as crawled now."""
    counted = counts.select(F.col("name").alias("source"), F.col("doc_count").alias("_n"))
    stamp = crawled_at if crawled_at is not None else F.current_timestamp()
    return (
        registry.drop("new_entries_from_last_crawl")
        .join(counted, "source", "left")
        .withColumns(
            {
                "crawled": F.lit(True),
                "last_crawled_at": stamp,
                "new_entries_from_last_crawl": F.coalesce(F.col("_n"), F.lit(0)),
            }
        )
        .drop("_n")
    )


def discovery_counts() -> dict[str, Column]:
    """Counts over a document table, as a run log has them.

    A document counts as discovered in any state, as fetched once it is past discovery
    and did not fail.
    """
    fetched = ~F.col("pipeline_status").isin("DISCOVERED", "FAILED")
    return {"discovered_count": F.count(F.lit(1)), "fetched_count": F.count_if(fetched)}


def write_counted(
    df: DataFrame, path: str, counts: dict[str, Column], mode: str = "error"
) -> dict[str, int]:
    """Write ``df`` as Parquet and return aggregates over its rows, taken by the job that writes.

    Nothing is read twice. The rows are observed right below the writer, in the last stage, whose
    tasks count once each, however often they are tried or a lost executor makes others run again.
    An empty table gives the aggregates of no rows.
    """
    seen = Observation()
    columns = [column.alias(name) for name, column in counts.items()]
    df.observe(seen, *columns).write.mode(mode).parquet(path)
    return dict(seen.get)


def stage_metrics(docs: DataFrame) -> DataFrame:
    """Documents per state."""
    return docs.groupBy("pipeline_status").agg(F.count("*").alias("n_documents"))


def removed_duplicates(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: records before and after the removal of duplicates, and their difference."""
    counts = [
        df.agg(F.count("*").alias(name)).withColumn("_row", F.lit(1))
        for df, name in ((before, "n_before"), (after, "n_after"))
    ]
    return counts[0].join(counts[1], "_row").select(
        "n_before", "n_after", (F.col("n_before") - F.col("n_after")).alias("n_removed")
    )


def run_log_row(
    docs: DataFrame,
    inserted: DataFrame,
    run_id: int,
    started_at: Column,
    status: str = "DONE",
    error: str | None = None,
) -> DataFrame:
    """One run-log row with real counts: those of ``discovery_counts``, and the inserted rows."""
    per_run = docs.agg(*[c.alias(name) for name, c in discovery_counts().items()]).withColumn(
        "run_id", F.lit(run_id).cast("bigint")
    )
    loaded = inserted.agg(F.count("*").alias("inserted_count")).withColumn(
        "run_id", F.lit(run_id).cast("bigint")
    )
    return _run_row(per_run.join(loaded, "run_id"), started_at, status, error)


def counted_run_row(
    spark: SparkSession,
    counts: dict[str, int],
    run_id: int,
    started_at: Column,
    status: str = "DONE",
    error: str | None = None,
) -> DataFrame:
    """One run-log row from counts that ``write_counted`` gave; a count that is missing is 0."""
    names = ("discovered_count", "fetched_count", "inserted_count")
    known = {name: F.lit(counts.get(name, 0)).cast("bigint") for name in names}
    row = spark.range(1).select(F.lit(run_id).cast("bigint").alias("run_id"))
    return _run_row(row.withColumns(known), started_at, status, error)


def _run_row(counted: DataFrame, started_at: Column, status: str, error: str | None) -> DataFrame:
    return counted.select(
        "run_id",
        F.lit(None).cast("int").alias("source_id"),
        started_at.alias("started_at"),
        F.current_timestamp().alias("finished_at"),
        F.lit(status).alias("status"),
        "discovered_count",
        "fetched_count",
        "inserted_count",
        F.lit(error).cast("string").alias("error_message"),
    )
