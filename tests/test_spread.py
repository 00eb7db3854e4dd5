from pyspark.sql import functions as F

from paperloom.operators import spread as spreading
from paperloom.operators.spread import FILES_PER_CORE, scan_bytes, spread, tasks_with_rows


def test_rows_of_one_row_group_reach_all_cores(spark, tmp_path):
    path = str(tmp_path / "one")
    spark.range(10_000).withColumn("text", F.lit("x")).coalesce(1).write.parquet(path)
    one = spark.read.parquet(path)
    assert tasks_with_rows(one) == 1
    dealt = spread(one)
    assert tasks_with_rows(dealt) > spark.sparkContext.defaultParallelism
    assert dealt.agg(F.count("*"), F.sum("id")).first() == one.agg(F.count("*"), F.sum("id")).first()


def test_a_scan_that_fills_the_cores_stays(spark, tmp_path):
    path = str(tmp_path / "many")
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, 10_000, 1, FILES_PER_CORE * cores).write.parquet(path)
    many = spark.read.parquet(path)
    assert spread(many) is many


def test_columns_that_nothing_reads_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(100).select("id", F.lit("t").alias("text"), F.lit("o").alias("other")).coalesce(
        1
    ).write.parquet(path)
    plan = spread(spark.read.parquet(path)).select(F.upper("text"))._jdf.queryExecution()
    assert "ReadSchema: struct<text:string>" in plan.executedPlan().toString()


def test_an_empty_table_stays_empty(spark, tmp_path):
    path = str(tmp_path / "empty")
    spark.range(0).write.parquet(path)
    assert spread(spark.read.parquet(path)).count() == 0


def test_large_tasks_are_dealt_out_by_bytes(spark, tmp_path, monkeypatch):
    """A scan that keeps all cores busy, but with tasks that grow with the table."""
    path = str(tmp_path / "large")
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, 40_000, 1, FILES_PER_CORE * cores).write.parquet(path)
    large = spark.read.parquet(path)
    total, largest = scan_bytes(large)
    assert 0 < largest <= total
    assert spread(large) is large
    monkeypatch.setattr(spreading, "TASK_BYTES", total // (10 * cores))
    monkeypatch.setattr(spreading, "TASKS_PER_CORE", 1)
    assert scan_bytes(large)[1] > spreading.TASK_BYTES
    dealt = spread(large)
    assert dealt.rdd.getNumPartitions() >= 10 * cores
    assert dealt.agg(F.count("*"), F.sum("id")).first() == large.agg(F.count("*"), F.sum("id")).first()
