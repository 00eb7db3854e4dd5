"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Within each source the keys are cut into equal ranges
and sorted, token counts become prefix sums (sums per range first, then inside the range), and
the order is cut where a source's exact budget is reached. A budget above the source's size
repeats whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.shared import buckets_for, word_count
from paperloom.session import written

DOCS_PER_RANGE = 5_000  # documents that one window sorts, on average


def source_targets(
    sources: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Target per source, from ``sources`` (source, source_size): adds ``target``.

    The sources in order of code points, null last, weigh ``weights`` in turn. Together they
    get ``share`` of all sizes in proportion to weight; a target stops at ``most`` times its
    source's size, and what is over goes to the others by weight until none is above. Each
    pass is one aggregate over the sources; the driver sees two sums.
    """
    n = len(weights)
    ranked = _ranked(sources)
    by_turn = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % n + 1).cast("int")
    )
    table = written(
        ranked.select(
            "source", "source_size", by_turn.alias("w"), (F.col("source_size") * most).alias("cap")
        ),
        "targets",
    )
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    level, full = 0.0, -1
    # `level` is the target per unit of weight; it only grows, as more sources are full.
    while True:
        is_full = F.col("cap") <= F.col("w") * level
        row = table.agg(
            F.coalesce(F.sum(F.when(is_full, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~is_full, F.col("w"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(is_full, 1)), F.lit(0)),
        ).first()
        if row[1] == 0.0 or row[2] == full:
            break
        full, level = row[2], (total - row[0]) / row[1]
    return table.select(
        "source",
        "source_size",
        F.when(F.col("cap") <= F.col("w") * level, F.col("cap"))
        .otherwise(F.least(F.col("w") * level, F.col("cap")))
        .alias("target"),
    )


def _ranked(sources: DataFrame) -> DataFrame:
    """Position of each source by code point, null last: counts per range, then inside it."""
    placed = written(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn(
            "part", F.spark_partition_id()
        ),
        "sources",
    )
    # One row per range partition, of which there are a few hundred.
    starts = (
        placed.groupBy("part")
        .agg(F.count("*").alias("n"))
        .select(
            "part",
            (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"),
        )
    )
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return (
        placed.withColumn("at", F.row_number().over(inside) - 1)
        .join(starts, "part")
        .select("source", "source_size", (F.col("start") + F.col("at")).alias("rank"))
    )


def mix(
    docs: DataFrame,
    weights: list[float],
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``, without its text: what the mix takes of it.

    Columns: doc_id, text_hash (of the text), source, size (words), source_size, target,
    epochs (whole repeats), part (words of the last, cut repeat) and taken = epochs * size +
    part. The words taken from a source are its target rounded down, to the word: only the
    document on the cut gives part of its words. The order depends on the ids and ``seed``
    alone, for rows without an id on their texts, so reruns agree. Null texts have size 0; null
    sources are one source; repeated rows are taken as separate rows in a row. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    sized = written(
        docs.select(
            doc_id.alias("doc_id"),
            F.xxhash64(text).alias("text_hash"),
            F.col(f"`{source_col}`").alias("source"),
            word_count(text).alias("size"),
            # Rows without an id would share one key, and so one range.
            F.xxhash64(F.lit(seed), doc_id, F.when(doc_id.isNull(), text)).alias("key"),
        ),
        "sizes",
    )
    per_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    per_source = written(per_source, "per-source")
    ranges = per_source.select(
        F.col("source").alias("s"), buckets_for(F.col("n_docs"), DOCS_PER_RANGE).alias("n_ranges")
    )
    targets = source_targets(per_source.select("source", "source_size"), weights, share, most)
    # Equal ranges of the key's unsigned top 31 bits.
    top = F.shiftrightunsigned("key", 33)
    place = F.floor(top * F.col("n_ranges") / F.lit(float(1 << 31))).cast("int")
    placed = written(
        sized.join(ranges, F.col("source").eqNullSafe(F.col("s")))
        .select("doc_id", "text_hash", "source", "size", top.alias("key"), place.alias("range"))
        .repartitionByRange("source", "range"),
        "ranges",
    )
    of_source = Window.partitionBy("source").orderBy("range")
    starts = (
        placed.groupBy("source", "range")
        .agg(F.sum("size").alias("in_range"))
        .select(
            F.col("source").alias("s"),
            F.col("range").alias("r"),
            (F.sum("in_range").over(of_source) - F.col("in_range")).alias("range_start"),
        )
        .join(targets, F.col("s").eqNullSafe(F.col("source")))
        .drop("source")
    )
    in_range = Window.partitionBy("source", "range").orderBy("key", "doc_id", "text_hash")
    sums = placed.withColumn(
        "upto", F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, 0))
    )
    joined = sums.join(
        starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    left = budget - F.col("epochs") * F.col("source_size")
    start = F.col("range_start") + F.col("upto") - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - start)).cast("bigint")
    return (
        joined.withColumn("epochs", epochs.cast("bigint"))
        .withColumn("part", part)
        .select(
            "doc_id",
            "text_hash",
            "source",
            "size",
            "source_size",
            "target",
            "epochs",
            "part",
            (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"),
        )
    )


def repeats(size: Column, epochs: Column, part: Column) -> Column:
    """Whole copies of a document in the mix: the cut copy counts if at least half is taken."""
    return (epochs + F.when((part * 2 >= size) & (part > 0), 1).otherwise(0)).cast("int")
