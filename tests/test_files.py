import json

import pytest
from pyspark.sql import functions as F

from paperloom import schemas
from paperloom.operators.quality import qa_report
from paperloom.operators.registry import (
    refresh_registry,
    run_log_row,
    source_counts,
    stage_metrics,
    with_grand_total,
)
from paperloom.plans.etl import documents_to_records, status_changes
from paperloom.session import scratch_path, shared_dir
from paperloom.sources import files


def test_registry_array_file(spark, tmp_path):
    path = tmp_path / "registry.json"
    path.write_text(json.dumps([{"source": "A", "crawled": True}, {"source": "B", "extra": 1}], indent=2))
    rows = files.read_registry(spark, str(path)).orderBy("source").collect()
    assert [(r["source"], r["crawled"]) for r in rows] == [("A", True), ("B", None)]
    files.write_registry(files.read_registry(spark, str(path)), str(tmp_path / "next"))
    assert files.read_jsonl(spark, str(tmp_path / "next"), schemas.REGISTRY).count() == 2


def test_registry_of_all_forms_and_with_broken_lines(spark, tmp_path):
    (tmp_path / "r").mkdir()
    forms = {
        "lines.json": '{"source": "A"}\n{"source": "B", "crawl\n\n{"source": "C", "crawled": "maybe"}\n',
        "array.json": '[{"source": "D"}, {"source": "E"}]\n',
        "spaced name.json": '[\n  {"source": "F", "tags": [1]},\n  {"source": "G"}\n]\n',
        "broken.json": '[{"source": "H", "tags": [1]\n, {"source"',
        "empty.json": "",
    }
    for name, text in forms.items():
        (tmp_path / "r" / name).write_text(text)
    path = str(tmp_path / "r")
    assert sorted(r["source"] for r in files.read_registry(spark, path).collect()) == list("ACDEFG")
    rejected = sorted(r["rejected"] for r in files.rejected_registry(spark, path).collect())
    assert len(rejected) == 2 and '"H"' in rejected[0] and '"B"' in rejected[1]


def test_json_array_of_a_small_export(spark, tmp_path):
    rows = [(3, "c\n\"x\"", None), (1, None, [1.5]), (2, "é", [])]
    df = spark.createDataFrame(rows, "id int, `a b` string, xs array<double>").repartition(3)
    path = str(tmp_path / "out")
    files.write_json_array(df, path, ["id"])
    (part,) = (tmp_path / "out").glob("part-*")
    got = json.loads(part.read_text())
    assert got == [dict(zip(["id", "a b", "xs"], r)) for r in sorted(rows)]
    assert sorted(files.read_json_array(spark, path, "id int, `a b` string, xs array<double>").collect()) == sorted(
        df.collect()
    )
    files.write_json_array(df.limit(0), path, ["id"])
    (part,) = (tmp_path / "out").glob("part-*")
    assert json.loads(part.read_text()) == []
    with pytest.raises(ValueError, match="write_jsonl"):
        files.write_json_array(df, path, ["id"], max_bytes=10)


def test_jsonl_skips_blank_lines_and_appends(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1}\n\n  \n{"a": 2, "b": "é"}\n')
    df = files.read_jsonl(spark, str(path), "a int, b string")
    assert sorted(r["a"] for r in df.collect()) == [1, 2]
    out = str(tmp_path / "out")
    files.write_jsonl(df, out)
    files.write_jsonl(df, out, append=True)
    assert files.read_jsonl(spark, out, "a int, b string").count() == 4


def test_optional_input(spark, tmp_path):
    missing = str(tmp_path / "none")
    assert files.read_jsonl(spark, missing, "a int", optional=True).count() == 0
    with pytest.raises(Exception):
        files.read_jsonl(spark, missing, "a int").count()


def test_csv_keeps_quotes_newlines_and_spaces(spark, tmp_path):
    rows = [(1, 'a "b", c', " x\ny "), (2, "\\", None)]
    df = spark.createDataFrame(rows, "n int, s string, t string")
    files.write_csv(df, str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), "n int, s string, t string")
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_loading_a_batch_twice_stores_it_once(spark, tmp_path):
    records = spark.createDataFrame([(1, "mRNA", None), (2, None, 0.5)], "document_id bigint, payload string, extraction_confidence double")
    table = str(tmp_path / "records")
    files.load_records(records, table, 1)
    files.load_records(records, table, 1)
    files.load_records(records, table, 2)
    rows = files.read_records(spark, table).collect()
    assert len(rows) == 4 and {r["reviewer_status"] for r in rows} == {"unreviewed"}
    assert {r["extraction_confidence"] for r in rows} == {0.0, 0.5}
    assert all(r["created_at"] == r["updated_at"] for r in rows)


def test_snapshots(spark, tmp_path):
    table = files.SnapshotTable(spark, str(tmp_path / "t"), "a int")
    assert table.latest_version() is None and table.read().count() == 0
    table.write(spark.createDataFrame([(1,)], "a int"), 1)
    table.write(table.read().union(table.read()), 2)
    (tmp_path / "t" / "version=000000000009").mkdir()
    assert table.latest_version() == 2
    assert (table.read().count(), table.read(1).count()) == (2, 1)


@pytest.mark.parametrize(
    "values,total,missing,pct,passed",
    [
        ([], 0, 0, 0.0, True),
        (["", None, "[]", '["a"]'], 4, 2, 50.0, False),
        ([None] + ["x"] * 4, 5, 1, 20.0, True),
        ([None] + ["x"] * 2, 3, 1, 33.33, False),
    ],
)
def test_qa_report(spark, tmp_path, values, total, missing, pct, passed):
    df = spark.createDataFrame([(v,) for v in values], "lipid_reagents_json string")
    report = qa_report(df)
    assert tuple(report.first()) == (total, missing, pct, 20.0, passed)
    files.write_report(report, str(tmp_path / "qa"))
    assert spark.read.json(str(tmp_path / "qa")).first()["missing_lipid_fields_pct"] == pct


def test_counts_registry_and_runs(spark):
    sources = spark.createDataFrame([(1, "A"), (2, "B")], "source_id int, name string")
    docs = spark.createDataFrame(
        [(1, 1, "DISCOVERED"), (2, 1, "LOADED"), (3, 1, "FAILED")],
        "document_id bigint, source_id int, pipeline_status string",
    )
    counts = source_counts(sources, docs)
    assert {tuple(r) for r in with_grand_total(counts).collect()} == {("A", 3), ("B", 0), (None, 3)}
    registry = spark.createDataFrame(
        [("A", False, None, 9), ("Z", False, None, 9)],
        "source string, crawled boolean, last_crawled_at timestamp, new_entries_from_last_crawl bigint",
    )
    rows = refresh_registry(registry, counts).collect()
    assert {(r["source"], r["crawled"], r["new_entries_from_last_crawl"]) for r in rows} == {("A", True, 3), ("Z", True, 0)}
    assert all(r["last_crawled_at"] is not None for r in rows)
    assert {tuple(r) for r in stage_metrics(docs).collect()} == {("DISCOVERED", 1), ("LOADED", 1), ("FAILED", 1)}
    run = run_log_row(docs, docs.limit(1), 5, F.current_timestamp(), "FAILED", "boom")
    row = spark.createDataFrame(run.collect(), schemas.CRAWL_RUNS).first()
    assert (row["run_id"], row["status"], row["error_message"]) == (5, "FAILED", "boom")
    assert (row["discovered_count"], row["fetched_count"], row["inserted_count"]) == (3, 1, 1)


def test_documents_to_export(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "Lipid nanoparticles", "10.1/a", "FETCHED"), (2, "Lipid nanoparticle", "10.1/b", "FETCHED"),
         (3, "Another topic altogether", "10.1/c", "FETCHED"), (4, "Unfetched", None, "FAILED")],
        "document_id bigint, title string, doi string, pipeline_status string",
    )
    raw = docs.select(
        "document_id", "doi", F.lit(None).cast("string").alias("pmcid"),
        F.lit("DSPC and chol with mRNA").alias("abstract"), F.lit(None).cast("string").alias("fulltext"),
    )
    records = documents_to_records(docs, raw)
    files.load_records(records.drop("title", "doi", "sections", "abstract_or_body"), str(tmp_path / "r"), 1)
    full = docs.selectExpr(
        "document_id", "title", "doi", "cast(null AS string) AS pmid", "cast(null AS string) AS pmcid",
        "'j' AS journal_or_site", "'2024' AS publication_date", "'u' AS source_url",
    )
    out = files.export_view(files.read_records(spark, str(tmp_path / "r")), full)
    assert out.columns == files.EXPORT_COLUMNS
    assert [(r["document_id"], r["lipid_reagents_json"], r["payload"]) for r in out.collect()] == [
        (1, '["DSPC", "cholesterol"]', "mRNA"), (3, '["DSPC", "cholesterol"]', "mRNA"),
    ]
    assert status_changes(records, "LOADED").first()["pipeline_status"] == "LOADED"


def test_intermediate_data_goes_to_the_configured_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
