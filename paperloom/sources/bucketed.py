"""A keyed table in hash buckets, of which a merge rewrites only those its batch has keys of.

A version is a manifest: the folder that holds each bucket, and the largest id in it. A merge reads
the buckets that its batch touches, writes their next state to new folders and then a manifest that
names these and, for all other buckets, the folders of the version before. No file is changed, so
every version stays readable, and one that was not finished does not count.

Rows without a complete key match nothing and are never merged again. They have folders outside the
buckets, one per merge, which are joined to one folder when there are as many as buckets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.merge import DOCUMENT_KEY, fold_updates, has_key, merge_folded
from paperloom.session import forget, written
from paperloom.sources.files import SnapshotTable

MANIFEST = "bucket INT, folder STRING, last_id BIGINT"
UNKEYED = -1
#: A merge of scattered keys touches every bucket once it has a few times as many keys as there are
#: buckets; a bucket should hold what a few tasks can rewrite. The manifest, which the driver reads,
#: has at most twice as many rows.
BUCKETS = 1_024


class BucketedTable:
    """Versions of one table. Its number of buckets and its key are those it was begun with."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: str,
        key: list[str] | None = None,
        buckets: int = BUCKETS,
    ) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.buckets = key or DOCUMENT_KEY, buckets
        self._manifest = SnapshotTable(spark, f"{self.path}/manifest", MANIFEST)

    def has(self, version: int) -> bool:
        return self._manifest.has(version)

    def latest_version(self) -> int | None:
        return self._manifest.latest_version()

    def folders(self, version: int | None = None) -> dict[int, list[str]]:
        """Where the rows of each bucket are."""
        found: dict[int, list[str]] = {}
        for entry in self._manifest.read(version).collect():
            found.setdefault(entry["bucket"], []).append(entry["folder"])
        return found

    def read(self, version: int | None = None) -> DataFrame:
        folders = self.folders(version)
        return self._rows([f for found in folders.values() for f in found])

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/{folder}" for folder in sorted(folders)]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _bucket(self) -> Column:
        dealt = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        return F.when(has_key(self.key), dealt).otherwise(F.lit(UNKEYED))

    def upsert(self, batch: DataFrame, version: int, order: str = "ingest_seq") -> None:
        """Write ``version``: the one before it, or else the latest, after the batch.

        The rules are those of ``upsert_documents``. A version that is complete stays as it is.
        """
        if self.has(version):
            return
        base = version - 1 if self.has(version - 1) else self.latest_version()
        entries = [] if base is None else self._manifest.read(base).collect()
        folded = written(fold_updates(batch, self.key, order), "folded")
        # At most one row per bucket comes to the driver.
        touched = {r[0] for r in folded.select(self._bucket()).distinct().collect()}
        loose = [e for e in entries if e["bucket"] == UNKEYED]
        joined = UNKEYED in touched and len(loose) >= self.buckets
        replaced = (touched - {UNKEYED}) | ({UNKEYED} if joined else set())

        current = self._rows([e["folder"] for e in entries if e["bucket"] in replaced])
        last_id = max((e["last_id"] for e in entries), default=0)
        merged = merge_folded(current, folded, self.key, last_id)
        folder = f"data/version={version:012d}"
        columns = [f"`{field.name}`" for field in current.schema]
        (
            merged.select(*columns, self._bucket().alias("bucket"))
            # Rows of a bucket meet; large ones, above all that of rows without key, are cut by size.
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{self.path}/{folder}")
        )
        forget(folded)
        self._write_manifest([e for e in entries if e["bucket"] not in replaced], folder, version)

    def _write_manifest(self, kept: list, folder: str, version: int) -> None:
        rows = self.spark.read.schema("document_id BIGINT, bucket INT").parquet(
            f"{self.path}/{folder}"
        )
        added = rows.groupBy("bucket").agg(F.max("document_id").alias("last_id")).select(
            "bucket",
            F.concat(F.lit(f"{folder}/bucket="), F.col("bucket").cast("string")).alias("folder"),
            "last_id",
        )
        kept_rows = [(e["bucket"], e["folder"], e["last_id"]) for e in kept]
        parts = [self.spark.createDataFrame(kept_rows, MANIFEST), added]
        self._manifest.write(reduce(DataFrame.unionByName, parts).coalesce(1), version)
