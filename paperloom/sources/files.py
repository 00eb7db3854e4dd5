"""Readers and writers. Tables are versioned folders; nothing is overwritten while read."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import schemas
from paperloom.functions.exprs import evaluated
from paperloom.operators.merge import upsert_slices
from paperloom.session import forget, path_exists, shuffles_dropped, written

# The columns of an export, in order.
EXPORT_COLUMNS = [
    "document_id",
    "title",
    "doi",
    "pmid",
    "pmcid",
    "journal_or_site",
    "publication_date",
    "source_url",
    "lipid_mix_text",
    "lipid_reagents_json",
    "lipid_ratios_text",
    "cells_or_organisms",
    "payload",
    "administration_route",
    "other_relevant_info",
    "evidence_span",
    "extraction_confidence",
]

# A write with this option leaves no success marker.
UNMARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}

# Most bytes of an export that is one JSON array.
ARRAY_BYTES = 256 << 20

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Source registry: files of one JSON array each, or of one JSON object a line.

    Lines are read in splits. An array over several lines has to be read by one task. What does
    not parse costs its own row only, or its array, and comes out of ``rejected_registry``.
    """
    parsed = _parsed_registry(spark, path)
    return parsed.where(~_unreadable(parsed)).drop("_corrupt")


def rejected_registry(spark: SparkSession, path: str) -> DataFrame:
    """Text (``rejected``) of the lines and arrays that ``read_registry`` leaves out."""
    parsed = _parsed_registry(spark, path)
    return parsed.where(_unreadable(parsed)).select(F.col("_corrupt").alias("rejected"))


def _parsed_registry(spark: SparkSession, path: str) -> DataFrame:
    schema = f"{schemas.REGISTRY}, _corrupt STRING"
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt")
    # A line that begins an array and is none by itself: the array goes over several lines.
    begun = F.col("value").rlike(r"^\s*\[") & F.try_parse_json("value").isNull()
    text = spark.read.text(path)
    arrays = text.where(begun).select(F.col("_metadata.file_path").alias("file")).distinct()
    spread_out = {r["file"] for r in arrays.collect()}
    by_line = [f for f in text.inputFiles() if _same_place(f) not in map(_same_place, spread_out)]
    parts = []
    if by_line:
        parts.append(reader.json([unquote(f) for f in by_line]))
    if spread_out:
        parts.append(reader.option("multiLine", True).json([unquote(f) for f in sorted(spread_out)]))
    if not parts:
        return spark.createDataFrame([], schema)
    # A filter that reaches the parser skips a line before all of it is read.
    return evaluated(reduce(DataFrame.unionByName, parts))


def _same_place(file: str) -> str:
    """A file's address without the difference between ``file:/x`` and ``file:///x``."""
    return re.sub(r"^(\w+):/+", r"\1:/", file)


def _unreadable(parsed: DataFrame) -> Column:
    """Whether nothing of a line was read; a single field of another type is only null."""
    fields = [F.col(c).isNull() for c in parsed.columns if c != "_corrupt"]
    return reduce(lambda a, b: a & b, fields) & F.col("_corrupt").isNotNull()


def write_registry(registry: DataFrame, path: str) -> None:
    """Registry as JSON lines in a new folder; ``read_registry`` reads it back."""
    registry.write.mode("error").json(path)


def read_jsonl(
    spark: SparkSession, path: str, schema: str, optional: bool = False
) -> DataFrame:
    """JSON lines; blank lines are skipped. A missing optional input has no rows."""
    if optional and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", False).json(path)


def write_json_array(
    df: DataFrame, path: str, order: list[str], max_bytes: int = ARRAY_BYTES
) -> None:
    """One file with one JSON array of all rows, in the order of the named columns.

    An array is one value of one task, so this is for small exports: more than ``max_bytes`` of
    JSON are refused, and ``write_jsonl`` takes them.
    """
    text = F.to_json(F.struct(*[f"`{c}`" for c in df.columns]), {"ignoreNullFields": "false"})
    rows = written(df.select(F.struct(*[f"`{c}`" for c in order]).alias("at"), text.alias("row")), "array")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("row") + 2), F.lit(0))).first()[0]
    if size > max_bytes:
        raise ValueError(f"{size} bytes are too many for one JSON array; use write_jsonl")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("at", "row"))), lambda r: r["row"])
    array = rows.agg(F.concat(F.lit("[\n"), F.array_join(listed, ",\n"), F.lit("\n]")).alias("value"))
    array.write.mode("overwrite").option("lineSep", "\n").text(path)
    forget(rows)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of files that are one JSON array each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; quotes are doubled and line breaks stay inside quotes."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", True).csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report of one row."""
    report.write.mode("overwrite").json(path)


def append_runs(runs: DataFrame, path: str) -> None:
    """Add rows to the run log."""
    runs.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run log; a log that nothing was added to yet has no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.CRAWL_RUNS)
    return spark.read.schema(schemas.CRAWL_RUNS).parquet(path)


def write_payloads(payloads: DataFrame, path: str) -> DataFrame:
    """Store raw payloads; returns the documents' place and hash (document_id, full_text_path,
    raw_hash) as a change set for the document table."""
    payloads.select(*[F.col(c) for c in PAYLOAD_COLUMNS]).write.mode("error").parquet(path)
    return read_payloads(payloads.sparkSession, path).select(
        "document_id", F.lit(path).alias("full_text_path"), "raw_hash"
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STORED_PAYLOADS).parquet(path)


PAYLOAD_COLUMNS = [c.split()[0] for c in schemas.STORED_PAYLOADS.split(", ")]


def prepare_records(records: DataFrame, batch_id: int, now: Column | None = None) -> DataFrame:
    """Record rows as they are stored: defaults, review state, batch and time stamps."""
    stamp = now if now is not None else F.current_timestamp()
    return records.withColumns(
        {
            "extraction_confidence": F.coalesce(F.col("extraction_confidence"), F.lit(0.0)),
            "reviewer_status": F.lit("unreviewed"),
            "batch_id": F.lit(batch_id).cast("bigint"),
            "created_at": stamp,
            "updated_at": stamp,
        }
    )


def load_records(records: DataFrame, table: str, batch_id: int) -> None:
    """Insert a batch. Repeating the batch replaces its rows instead of adding them again."""
    prepare_records(records, batch_id).drop("batch_id").write.mode("overwrite").parquet(
        f"{table}/batch_id={batch_id}"
    )


def read_records(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(schemas.RECORDS).parquet(table)


def export_view(records: DataFrame, docs: DataFrame) -> DataFrame:
    """Records with their document's bibliographic data, in order of document id.

    Several records of one document follow in the order of their other columns.
    """
    rest = [c for c in EXPORT_COLUMNS if c != "document_id"]
    return records.join(docs, "document_id").select(*EXPORT_COLUMNS).orderBy("document_id", *rest)


class SnapshotTable:
    """A table as a series of complete versions, each in a folder of its own.

    A version counts once its success marker is there, so a failed write leaves the
    previous version in place.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version:012d}"

    def has(self, version: int) -> bool:
        return path_exists(self.spark, f"{self._folder(version)}/_SUCCESS")

    def latest_version(self) -> int | None:
        if not path_exists(self.spark, self.path):
            return None
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        versions = [int(n.split("=")[1]) for n in names if n.startswith("version=")]
        return max((v for v in versions if self.has(v)), default=None)

    def read(self, version: int | None = None) -> DataFrame:
        version = self.latest_version() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._folder(version))

    def write(self, df: DataFrame, version: int) -> None:
        with shuffles_dropped(df.sparkSession):
            df.write.mode("overwrite").option("compression", "zstd").parquet(self._folder(version))

    def upsert(self, batch: DataFrame, version: int, order: str = "ingest_seq") -> None:
        """Write ``version``: the one before it, or else the latest, after the batch.

        A version that is complete stays as it is. A large one is made slice by slice, and counts
        once the last of them is written.
        """
        if self.has(version):
            return
        current = self.read(version - 1 if self.has(version - 1) else None)
        mode = "overwrite"
        for merged, is_last in upsert_slices(current, batch, order=order):
            with shuffles_dropped(merged.sparkSession):
                merged.select(*current.columns).write.mode(mode).options(
                    compression="zstd", **({} if is_last else UNMARKED)
                ).parquet(self._folder(version))
            mode = "append"
