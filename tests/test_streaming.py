import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from paperloom import schemas
from paperloom.plans import catalog_linkage
from paperloom.session import path_exists, scratch_path
from paperloom.sources.files import SnapshotTable
from paperloom.sources.mappers import SOURCES
from paperloom.streaming.incremental import (
    document_stream,
    first_seen,
    first_seen_stream,
    landed_stream,
    read_first_seen,
    upsert_stream,
)


def land(folder, name, seq, *items):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"response_seq": seq, "response": json.dumps({"collection": items})}))


def test_upsert_stream_resumes_and_repeats_nothing(spark, tmp_path):
    landing = tmp_path / "landing"
    table = SnapshotTable(spark, str(tmp_path / "docs"), schemas.DOCUMENTS)
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        docs = document_stream(landed_stream(spark, str(landing)), SOURCES["bioRxiv"])
        upsert_stream(docs, table, checkpoint).awaitTermination()
        return {r["document_id"]: (r["external_id"], r["title"], r["abstract_text"]) for r in table.read().collect()}

    land(landing, "1.json", 1, {"doi": "a", "title": "A", "abstract": "old"}, {"doi": "a", "title": "A1"})
    assert run() == {1: ("a", "A1", "old")}
    land(landing, "2.json", 2, {"doi": "b", "title": "B"}, {"doi": "a", "title": "A2"})
    expected = {1: ("a", "A2", "old"), 2: ("b", "B", None)}
    assert run() == expected
    version = table.latest_version()
    assert run() == expected and table.latest_version() == version


def test_first_seen_across_batches(spark, tmp_path):
    landing = tmp_path / "landing"
    out = str(tmp_path / "out")
    checkpoint = scratch_path(spark, "seen")

    def run():
        docs = document_stream(landed_stream(spark, str(landing)), SOURCES["bioRxiv"])
        stamped = docs.withColumn("at", F.lit("2024-01-01").cast("timestamp"))
        query = (
            first_seen(stamped, ["source_name", "external_id"], "at")
            .select("external_id", "title")
            .writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema("external_id string, title string").parquet(out).collect())

    land(landing, "1.json", 1, {"doi": "a", "title": "A"})
    assert run() == [("a", "A")]
    land(landing, "2.json", 2, {"doi": "a", "title": "again"}, {"doi": "b", "title": "B"})
    assert run() == [("a", "A"), ("b", "B")]


def test_first_seen_of_documents_with_distant_ids(spark, tmp_path, monkeypatch):
    landed = tmp_path / "landing"
    for seq in (60_000, 1, 50_000, 2, 3, 70_000, 5, 4, 6, 7):
        land(landed, f"{len(list(landed.glob('*'))) if landed.exists() else 0}.json", seq, {"doi": f"d{seq}"}, {"doi": "same"})

    def streams(spark, sf_dir, files_per_batch):
        return document_stream(landed_stream(spark, sf_dir, files_per_batch=1), SOURCES["bioRxiv"])

    monkeypatch.setattr(catalog_linkage, "_document_streams", streams)
    got = catalog_linkage.stream_uid_dedup(spark, str(landed)).collect()
    expected = ["same", *(f"d{n}" for n in (1, 2, 3, 4, 5, 6, 7, 50_000, 60_000, 70_000))]
    assert sorted(r["external_id"] for r in got) == sorted(expected)


def test_result_does_not_depend_on_batches_or_arrival(spark, tmp_path):
    """Files of one key in any order and batch size leave the values of the latest response."""
    files = {
        1: [{"doi": "a", "title": "t1", "abstract": "first"}, {"doi": "a", "title": "t2"}],
        2: [{"doi": "b", "title": "", "abstract": "B"}, {"doi": "a", "title": "t3", "date": "2020"}],
        3: [{"doi": "b", "title": "late", "date": "2021"}],
        4: [{"doi": "a", "title": "t4"}],
    }

    def run(name, order, files_per_batch, at_once):
        landing = tmp_path / name
        landing.mkdir()
        table = SnapshotTable(spark, str(tmp_path / f"{name}-docs"), schemas.DOCUMENTS)
        for n in order:
            land(landing, f"{n}.json", n, *files[n])
            if not at_once or n == order[-1]:
                landed = landed_stream(spark, str(landing), files_per_batch=files_per_batch)
                docs = document_stream(landed, SOURCES["bioRxiv"])
                upsert_stream(docs, table, str(tmp_path / f"{name}-check")).awaitTermination()
        columns = ["external_id", "title", "abstract_text", "publication_date", "doi"]
        return sorted(tuple(r[c] for c in columns) for r in table.read().collect())

    expected = [("a", "t4", "first", "2020", "a"), ("b", "late", "B", "2021", "b")]
    assert run("one", [1, 2, 3, 4], None, True) == expected
    assert run("many", [1, 2, 3, 4], 1, True) == expected
    assert run("late", [4, 2, 3, 1], None, False) == expected


def test_a_stream_that_fails_after_a_batch_goes_on_without_repeating_it(spark, tmp_path):
    landing = tmp_path / "landing"
    table = SnapshotTable(spark, str(tmp_path / "docs"), schemas.DOCUMENTS)
    checkpoint = str(tmp_path / "checkpoint")
    for n in range(3):
        land(landing, f"{n}.json", n, {"doi": f"d{n}", "title": f"T{n}"}, {"doi": "all", "title": f"A{n}"})

    def fail(batch_id):
        raise RuntimeError(f"stopped after {batch_id}")

    def run(after_batch=None):
        docs = document_stream(landed_stream(spark, str(landing), files_per_batch=1), SOURCES["bioRxiv"])
        upsert_stream(docs, table, checkpoint, after_batch=after_batch).awaitTermination()

    with pytest.raises(StreamingQueryException, match="stopped after 0"):
        run(fail)
    assert table.latest_version() == 1
    first = sorted(map(tuple, table.read().collect()), key=repr)
    done = []
    run(done.append)
    assert done == [0, 1, 2] and table.latest_version() == 3
    assert sorted(map(tuple, table.read(1).collect()), key=repr) == first  # version 1 was not written again
    titles = {r["external_id"]: r["title"] for r in table.read().collect()}
    assert titles == {"d0": "T0", "d1": "T1", "d2": "T2", "all": "A2"}


@pytest.mark.parametrize("keep", ["1 millisecond", "1 hour"])
def test_first_seen_with_bounded_state_loses_and_repeats_nothing(spark, tmp_path, keep):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    checkpoint = str(tmp_path / "checkpoint")
    batches = [(60, ["a", "same"]), (1, ["b", "same", "same"]), (50, ["a", "c"]), (2, ["same", "d"])]

    def run():
        docs = document_stream(landed_stream(spark, str(landing), files_per_batch=1), SOURCES["bioRxiv"])
        # Documents without an id are alike.
        ids = docs.select("source_name", F.when(F.col("external_id") != "d", F.col("external_id")).alias("id"))
        first_seen_stream(ids, ["source_name", "id"], out, checkpoint, keep).awaitTermination()
        return sorted(str(r["id"]) for r in read_first_seen(spark, out, ids.schema).collect())

    for n, (seq, ids) in enumerate(batches):
        land(landing, f"{n}.json", seq, *[{"doi": i} for i in ids])
    assert run() == ["None", "a", "b", "c", "same"]
    land(landing, "9.json", 3, {"doi": "a"}, {"doi": "d"}, {"doi": "e"})
    assert run() == ["None", "a", "b", "c", "e", "same"]
    assert run() == ["None", "a", "b", "c", "e", "same"]


def test_a_batch_of_first_seen_that_is_run_again_is_written_anew(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    land(landing, "0.json", 1, {"doi": "a"}, {"doi": "b"})
    docs = document_stream(landed_stream(spark, str(landing)), SOURCES["bioRxiv"]).select("external_id")
    # The batch was written, but the stream did not come to note it as done.
    spark.createDataFrame([("a",)], docs.schema).write.parquet(f"{out}/batch=0")
    first_seen_stream(docs, ["external_id"], out, str(tmp_path / "c")).awaitTermination()
    assert sorted(r[0] for r in read_first_seen(spark, out, docs.schema).collect()) == ["a", "b"]


def several_files(spark, folder):
    """Documents of a dozen responses, as rows of as many files."""
    rows = spark.range(600).selectExpr(
        "id AS doc_id", "concat('Title ', id, '. Body') AS text", "'en' AS lang",
        "concat('src', id % 3) AS source", "10L AS n_chars",
    )
    rows.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_landed_files_are_compressed_and_whole(spark, tmp_path):
    from paperloom.plans.catalog_sources import landed_responses

    folder = several_files(spark, tmp_path)
    landings = catalog_linkage._landed(spark, folder)
    assert len(landings) == 8
    for name in ("PubMed", "OpenAlex"):
        read = spark.read.schema(schemas.LANDED).json(landings[name])
        assert all(f.endswith(".gz") for f in read.inputFiles())
        assert sorted(map(tuple, read.collect()), key=str) == sorted(
            map(tuple, landed_responses(spark, folder, name).collect()), key=str
        )


def test_the_rest_of_a_stopped_stream_is_one_batch(spark, tmp_path, monkeypatch):
    """A snapshot per batch of files would take disk with the square of the files."""
    conf = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "2k",
        "spark.sql.files.openCostInBytes": "2k",
    }
    before = {c: spark.conf.get(c) for c in conf}
    versions = []
    upsert = SnapshotTable.upsert

    def counted(self, batch, version, order="ingest_seq"):
        versions.append(version)
        upsert(self, batch, version, order)

    monkeypatch.setattr(SnapshotTable, "upsert", counted)
    monkeypatch.setattr(catalog_linkage, "RESTART_FILES", 1)
    try:
        for c, value in conf.items():
            spark.conf.set(c, value)
        rows = catalog_linkage.stream_restart(spark, several_files(spark, tmp_path)).collect()
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
    assert versions == [1, 1, 2]
    assert sum(r["source_name"] == "PubMed" for r in rows) == 600


@pytest.mark.parametrize("name", ["stream_upsert", "stream_restart"])
def test_landed_files_go_once_they_are_merged(spark, tmp_path, monkeypatch, name):
    """The rows of the result are in the snapshot; its readers need no second copy of the texts."""
    land_all, folders = catalog_linkage._landed, []

    def landed(spark, sf_dir):
        landings = land_all(spark, sf_dir)
        folders.extend(landings.values())
        return landings

    monkeypatch.setattr(catalog_linkage, "_landed", landed)
    rows = getattr(catalog_linkage, name)(spark, several_files(spark, tmp_path))
    assert len(folders) == 8 and not any(path_exists(spark, f) for f in folders)
    assert rows.where("source_name = 'PubMed'").count() == 600
