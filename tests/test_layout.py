import re

import pytest
from pyspark.sql import functions as F

from paperloom.operators.merge import apply_changes
from paperloom.operators.registry import counted_run_row, discovery_counts, write_counted
from paperloom.sources.layout import attach, write_layout

SCHEMA = "document_id bigint, title string, pipeline_status string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def laid_out(spark, tmp_path):
    states = ["DISCOVERED", "FETCHED", "FETCHED", "FAILED"]
    rows = [(i, f"t{i}", states[i % 4]) for i in range(200)] + [(None, "no id", "FETCHED"), (7, "t7", "FAILED")]
    docs = spark.createDataFrame(rows, SCHEMA)
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(0, 250)], "document_id bigint, text string")
    name = re.sub(r"\W", "_", str(tmp_path))
    yield (
        docs,
        write_layout(docs, f"docs{name}", f"{tmp_path}/d", 4, partition="pipeline_status"),
        write_layout(texts, f"texts{name}", f"{tmp_path}/t", 4),
        name,
    )
    spark.sql(f"DROP TABLE docs{name}")
    spark.sql(f"DROP TABLE texts{name}")


def test_rows_stay(laid_out):
    given, docs, _, _ = laid_out
    columns = given.columns
    assert sorted(map(tuple, docs.select(*columns).collect()), key=repr) == sorted(
        map(tuple, given.collect()), key=repr
    )


def test_a_state_reads_its_folder_and_joins_without_a_shuffle(laid_out, no_broadcast):
    _, docs, texts, _ = laid_out
    fetched = docs.where(F.col("pipeline_status") == "FETCHED")
    joined = fetched.join(texts, "document_id")
    text = plan(joined)
    assert "Exchange" not in text and re.search(r"PartitionFilters: \[[^\]]*FETCHED", text)
    assert joined.count() == 100


def test_an_update_needs_no_shuffle(laid_out, no_broadcast):
    given, docs, texts, _ = laid_out
    changes = texts.select("document_id", F.lit("LOADED").alias("pipeline_status"))
    changed = apply_changes(docs, changes)
    assert "Exchange" not in plan(changed)
    expected = apply_changes(given, changes).select(*given.columns)
    assert sorted(map(tuple, changed.select(*given.columns).collect()), key=repr) == sorted(
        map(tuple, expected.collect()), key=repr
    )


def test_another_session_attaches_the_files(spark, laid_out, no_broadcast, tmp_path):
    _, docs, texts, name = laid_out
    again = attach(spark, f"again{name}", f"{tmp_path}/d", docs.schema, 4, partition="pipeline_status")
    assert sorted(map(str, again.collect())) == sorted(map(str, docs.collect()))
    assert "Exchange" not in plan(again.join(texts, "document_id"))
    spark.sql(f"DROP TABLE again{name}")


def test_counts_of_the_job_that_writes(spark, tmp_path):
    rows = [(i, "t", ["DISCOVERED", "FETCHED", "FAILED", None][i % 4]) for i in range(103)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    counts = write_counted(docs, f"{tmp_path}/some", discovery_counts())
    assert counts == {"discovered_count": 103, "fetched_count": 26}
    assert spark.read.parquet(f"{tmp_path}/some").count() == 103
    none = write_counted(spark.createDataFrame([], SCHEMA), f"{tmp_path}/none", discovery_counts())
    assert none == {"discovered_count": 0, "fetched_count": 0}
    row = counted_run_row(spark, counts, 3, F.current_timestamp(), "FAILED", "no space").first()
    assert (row["run_id"], row["fetched_count"], row["inserted_count"]) == (3, 26, 0)
    assert (row["status"], row["error_message"]) == ("FAILED", "no space")
