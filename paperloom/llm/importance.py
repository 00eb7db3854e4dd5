"""Importance resampling of documents towards a target distribution of word n-grams.

Features are hashed into a fixed number of buckets by crc32, which is computed for all features
of many texts at once: a table holds what a byte contributes at a distance from the end, the
contributions of a feature are combined by exclusive or, and a constant of the length is added
(see ``words``). Bucket counts of the corpus and of the target give every bucket its gain, and
documents with the highest sum of gains plus Gumbel noise are drawn without replacement.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from paperloom.llm.arrow import map_texts, pieces
from paperloom.llm.words import crc32_of_spans, words_of
from paperloom.session import written

BUCKETS = 10_000
UNIT = 1000  # gains and scores are whole multiples of 1 / UNIT


def feature_buckets(texts: pa.Array, sizes: tuple[int, int], buckets: int) -> tuple:
    """Buckets of all features of the texts, the number of each text's features, and of its words.

    Features are the runs of ``sizes[0]`` to ``sizes[1]`` words of a text, joined by one space.
    They come text by text, in a text by their number of words.
    """
    words = words_of(texts)
    n_words, lengths = len(words.starts) - 1, np.diff(words.starts)
    # The words of a text, each followed by a space: a run of words is one span of this.
    starts = words.starts[:-1] + np.arange(n_words)
    data = np.full(len(words.data) + n_words, ord(" "), dtype=np.uint8)
    data[np.arange(len(words.data)) + np.repeat(np.arange(n_words), lengths)] = words.data
    text_of = words.text_of()
    found, owner = [], []
    for size in range(sizes[0], sizes[1] + 1):
        last = np.arange(size - 1, n_words)
        first = last - size + 1
        inside = text_of[first] == text_of[last]
        first, last = first[inside], last[inside]
        spans = starts[last] + lengths[last] - starts[first]
        found.append((crc32_of_spans(data, starts[first], spans) % np.uint32(buckets)).astype(np.int64))
        owner.append(text_of[first])
    all_buckets, all_owners = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(all_owners, kind="stable") if len(found) > 1 else slice(None)
    return all_buckets[order], np.bincount(all_owners, minlength=len(texts)), words.per_text


def bucket_counts(docs: DataFrame, text_col: str, sizes: tuple[int, int], buckets: int) -> np.ndarray:
    """Number of features in every bucket over all texts; a task gives each bucket once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                found, _, _ = feature_buckets(piece.column("text"), sizes, buckets)
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    counted = texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()  # at most as many rows as there are buckets
    counts = np.zeros(buckets, dtype=np.int64)
    counts[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Logarithm of how much likelier each bucket is in the target, in whole units, rounded down."""
    of_corpus, of_target = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    gains = [
        math.floor(UNIT * math.log(((t + 1.0) * of_corpus) / ((s + 1.0) * of_target)))
        for s, t in zip(corpus.tolist(), target.tolist())
    ]
    return np.array(gains, dtype=np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of an id in whole units, rounded down; a null id counts as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.substring(F.sha2(F.encode(text, "utf-8"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(F.lit(-float(UNIT)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def draw(
    docs: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = (10, 100),
    least_words: int = 20,
    sizes: tuple[int, int] = (1, 1),
    buckets: int = BUCKETS,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_features, weight, score, rank.

    Of the documents with ``least_words`` words or more, the part ``share`` (numerator and
    denominator, rounded down) with the highest scores is drawn; ``rank`` counts these from 1,
    ties by smaller id, null ids last, and is null for the others. Null texts have no words
    and no features. Rows that repeat an id share its noise, and each can be drawn; whole
    repeats are ranked one after the other. Reruns agree. An empty table gives no rows.
    """
    gains = bucket_gains(
        bucket_counts(docs, text_col, sizes, buckets),
        bucket_counts(target, target_text_col, sizes, buckets),
    )
    sent = docs.sparkSession.sparkContext.broadcast(gains)
    fields = [StructField(n, LongType(), False) for n in ("n_features", "weight", "n_words")]

    def prepare():
        def work(texts: list) -> list[pa.Array]:
            found, per_text, n_words = feature_buckets(pa.array(texts, pa.large_string()), sizes, buckets)
            weight = np.zeros(len(per_text), dtype=np.int64)
            some = np.flatnonzero(per_text)
            if len(some):
                starts = (np.cumsum(per_text) - per_text)[some]
                weight[some] = np.add.reduceat(sent.value[found], starts)
            return [pa.array(x.astype(np.int64)) for x in (per_text, weight, n_words)]

        return work

    keyed = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.xxhash64(f"`{text_col}`").alias("text_hash"),
        F.col(f"`{text_col}`").alias("text"),
    )
    weighed = map_texts(keyed, "text", ["doc_id", "text_hash"], fields, prepare)
    scored = written(
        weighed.select(
            "row.*",
            "n_features",
            "weight",
            (F.col("weight") + gumbel(F.col("row.doc_id"), seed)).alias("score"),
            (F.col("n_words") >= least_words).alias("able"),
        ),
        "scored",
    )
    n_able = scored.where("able").count()
    return ranked(scored, n_able * share[0] // share[1])


def ranked(scored: DataFrame, n_drawn: int) -> DataFrame:
    """The rank of the first ``n_drawn`` of the rows that are ``able``.

    Rows are sorted in ranges of the score; a running total of the rows of each range, one row a
    task, places them. What lies beyond the last range that is needed keeps no rank.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("text_hash").asc()]
    placed = written(
        scored.where("able")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()),
        "in-order",
    )
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("part"))
        .count()
        .select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    )
    rank = F.col("start") + inside + 1
    numbered = (
        placed.withColumn("part", part)
        .join(F.broadcast(starts), "part")  # one row for each partition of the sort
        .withColumn("rank", F.when(rank <= n_drawn, rank))
    )
    columns = ["doc_id", "text_hash", "n_features", "weight", "score", "rank"]
    rest = scored.where(~F.col("able")).withColumn("rank", F.lit(None).cast("bigint"))
    return numbered.select(columns).unionByName(rest.select(columns))
