from pyspark.sql import functions as F

from paperloom import schemas
from paperloom.operators.merge import upsert_documents
from paperloom.sources.bucketed import UNKEYED, BucketedTable
from paperloom.sources.files import SnapshotTable
from paperloom.sources.mappers import SOURCES
from paperloom.streaming.incremental import document_stream, landed_stream, upsert_stream
from test_streaming import land

COLUMNS = "source_name string, external_id string, title string, abstract_text string, ingest_seq bigint"


def rows(df):
    return sorted((tuple(r) for r in df.drop("value_seq").collect()), key=repr)


def batches(spark):
    first = [("s", f"k{n}", f"t{n}", f"a{n}", n) for n in range(200)]
    first += [("s", None, f"none{n}", None, 1_000 + n) for n in range(20)]
    second = [("s", "k7", "new", None, 2_000), ("s", "k500", "fresh", "f", 2_001), (None, "x", "", "n", 2_002)]
    return [spark.createDataFrame(b, COLUMNS) for b in (first, second)]


def files_of(table, version):
    root = table.spark._jvm.java.io.File
    return {
        bucket: sorted(f for folder in folders for f in root(f"{table.path}/{folder}").list())
        for bucket, folders in table.folders(version).items()
    }


def test_same_rows_as_a_whole_snapshot_and_untouched_files_stay(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), schemas.DOCUMENTS, buckets=32)
    whole = spark.createDataFrame([], schemas.DOCUMENTS)
    for n, batch in enumerate(batches(spark), 1):
        table.upsert(batch, n)
        whole = upsert_documents(whole, batch).select(*whole.columns)
        assert rows(table.read(n)) == rows(whole)
    before, after = files_of(table, 1), files_of(table, 2)
    changed = {b for b in after if after[b] != before.get(b)}
    assert changed - {UNKEYED} and len(changed - {UNKEYED}) <= 2
    # What had no key before is not written again, it only gets company.
    assert set(before[UNKEYED]) <= set(after[UNKEYED])
    assert table.read(1).count() == 220


def test_a_version_that_counts_is_not_written_again(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), schemas.DOCUMENTS, buckets=4)
    first, second = batches(spark)
    table.upsert(first, 1)
    table.upsert(second, 1)
    assert table.latest_version() == 1 and table.read().count() == 220


def test_an_unfinished_version_is_written_from_the_one_before(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), schemas.DOCUMENTS, buckets=4)
    first, second = batches(spark)
    table.upsert(first, 1)
    # Data of a merge that ended before its manifest.
    second.withColumn("document_id", F.lit(9).cast("bigint")).withColumn("bucket", F.lit(1)).write.partitionBy(
        "bucket"
    ).parquet(f"{table.path}/data/version={2:012d}")
    assert table.latest_version() == 1
    table.upsert(second, 2)
    whole = spark.createDataFrame([], schemas.DOCUMENTS)
    for batch in (first, second):
        whole = upsert_documents(whole, batch).select(*whole.columns)
    assert rows(table.read()) == rows(whole)


def test_folders_of_rows_without_key_are_joined(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), schemas.DOCUMENTS, buckets=2)
    for n in range(1, 5):
        table.upsert(spark.createDataFrame([("s", None, f"t{n}", None, n)], COLUMNS), n)
    assert [len(table.folders(n)[UNKEYED]) for n in range(1, 5)] == [1, 2, 1, 2]
    assert sorted(r["title"] for r in table.read().collect()) == ["t1", "t2", "t3", "t4"]
    assert sorted(r["document_id"] for r in table.read().collect()) == [1, 2, 3, 4]


def test_empty_table_and_empty_batch(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), schemas.DOCUMENTS, buckets=4)
    assert table.read().count() == 0
    table.upsert(spark.createDataFrame([], COLUMNS), 1)
    assert table.read().count() == 0 and table.latest_version() == 1
    table.upsert(batches(spark)[0], 2)
    assert table.read().count() == 220


def test_stream_into_either_table(spark, tmp_path):
    landing = tmp_path / "landing"
    for n in range(6):
        land(landing, f"{n}.json", n, {"doi": f"d{n % 4}", "title": f"T{n}", "abstract": "" if n > 3 else f"A{n}"})
    found = []
    for kind in (SnapshotTable, BucketedTable):
        table = kind(spark, str(tmp_path / kind.__name__), schemas.DOCUMENTS)
        docs = document_stream(landed_stream(spark, str(landing), files_per_batch=2), SOURCES["bioRxiv"])
        upsert_stream(docs, table, str(tmp_path / f"c-{kind.__name__}")).awaitTermination()
        found.append(rows(table.read().drop("document_id")))
    assert found[0] == found[1] and len(found[0]) == 4
