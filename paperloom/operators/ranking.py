"""First-wins selection, top-k per group and consecutive ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import written

SALTS = 64
# Bits in which the keys that come again are marked, 64 to a row of a table that is broadcast.
MARK_BITS = 26


def first_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The earliest row of each key.

    An aggregate rather than a window: it combines before the shuffle, so a key with a
    third of all rows costs one row per map task.
    """
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.col(order)).alias("_row"))
    return kept.select("_row.*")


def first_wins_wide(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``first_wins`` for wide rows: only those whose key comes again are shuffled.

    Hashes of the keys are counted first, and those that come more than once marked in a bitmap of fixed
    size. A row whose hash is not marked is the only one of its key; where so many keys come again that
    all bits are set, all rows are shuffled as by ``first_wins``. ``df`` is computed three times, and
    has to give the same keys each time.
    """
    place = F.pmod("_hash", F.lit(1 << MARK_BITS))
    hashed = df.withColumn("_hash", F.xxhash64(*keys)).withColumns(
        {"_word": F.shiftright(place, 6), "_bit": F.pmod(place, F.lit(64)).cast("int")}
    )
    marks = (
        hashed.groupBy("_hash", "_word", "_bit")
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
        .groupBy("_word")
        .agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    )
    marked = hashed.join(F.broadcast(marks), "_word", "left")
    again = F.coalesce(F.getbit("_bits", "_bit") == 1, F.lit(False))
    alone = marked.where(~again).select(*df.columns)
    return alone.unionByName(first_wins(marked.where(again).select(*df.columns), keys, order))


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.col(order)).alias("_row"))
    return kept.select("_row.*")


def top_k(df: DataFrame, groups: list[str], order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of each group in the given order.

    Up to the optimizer's threshold Spark already limits each group before the shuffle.
    Beyond it a first ranking inside salted parts of the group does the same, so a hot
    group is never sorted as a whole by one task.
    """
    limit_before_shuffle = int(
        df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    )
    if k > limit_before_shuffle:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))
        df = _ranked(df.withColumn("_part", part), [*groups, "_part"], order, k).drop("_part")
    return _ranked(df, groups, order, k)


def _ranked(df: DataFrame, groups: list[str], order: list[Column], k: int) -> DataFrame:
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k).drop(
        "_rank"
    )


def assign_ids(df: DataFrame, seq: str, id_name: str, start: int = 1) -> DataFrame:
    """Consecutive ids in the order of a unique column.

    Rows are split into ranges of equal size and sorted inside them; only the number of
    rows per range goes through a running total. Range borders come from a sample, so the
    numbered rows are written before the totals are taken of them.
    """
    placed = written(
        df.repartitionByRange(seq)
        .sortWithinPartitions(seq)
        .withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    # The upper bits of a monotonically increasing id are the number of the partition.
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per partition of the shuffle above, so this is small however large df is.
    return (
        placed.join(F.broadcast(offsets), "_range")
        .withColumn(id_name, F.col("_offset") + inside + F.lit(start))
        .drop("_range", "_at", "_offset")
    )
