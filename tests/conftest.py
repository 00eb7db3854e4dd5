import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import paperloom  # noqa: E402

cloudpickle.register_pickle_by_value(paperloom)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluate a one-argument column function on Python values, in one job."""
    from pyspark.sql import functions as F

    def run(fn, values, dtype="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"n int, v {dtype}").coalesce(1)
        out = rows.select("n", fn(F.col("v")).alias("r")).orderBy("n").collect()
        return [r["r"] for r in out]

    return run
