"""Helpers of the operators in this subpackage: written tables, row ids, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.session import forget, written

#: White space that separates words, as a Java character class body.
SPACE = r"\x20\x09-\x0D"


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, every other character as it is."""
    pure = F.octet_length(text) == F.char_length(text)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def word_count(text: Column) -> Column:
    """Number of words of a text as bigint, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("bigint")


def buckets_for(n_rows: Column, per_bucket: int) -> Column:
    """Number of buckets that keeps about ``per_bucket`` rows in each, at least 1."""
    return F.greatest(F.lit(1), F.ceil(n_rows / F.lit(per_bucket))).cast("bigint")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (node, component) per node.

    ``component`` is the smallest node reachable. Large-star and small-star rounds: every
    node hands the smallest neighbour to its larger, then to its smaller neighbours, until
    nothing changes. Minima are aggregated before the shuffle, and both sides of every join
    are plain tables, so adaptive execution can split a hub. Each round is a written table;
    the driver sees only whether a round changed anything. Null ends and loops are ignored.
    """
    spark = edges.sparkSession
    kept = edges.where((F.col("a") != F.col("b"))).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = written(kept.distinct(), "components")
    seen = _signature(current)
    while seen[0]:
        after = written(_small_star(_large_star(current)), "components")
        now = _signature(after)
        forget(current)
        current = after
        if now == seen:
            break
        seen = now
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots) if seen[0] else spark.createDataFrame([], members.schema)


def _signature(edges: DataFrame) -> tuple:
    """Number of edges and two order-free sums over them: equal only if nothing changed."""
    h = F.xxhash64("a", "b")
    row = edges.agg(
        F.count("*"),
        F.sum(F.shiftrightunsigned(h, 32)),
        F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))),
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = edges.select(F.col("b").alias("hub"), F.col("a").alias("far"))
    linked = larger.join(smallest, F.col("hub") == F.col("a")).select(
        F.col("far").alias("a"), F.col("m").alias("b")
    )
    return written(linked.distinct(), "large-star")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    near = (
        edges.join(smallest, "a")
        .where(F.col("b") != F.col("m"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    return near.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
