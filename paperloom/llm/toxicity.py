"""Toxicity by two Kneser-Ney models of bytes, one of toxic and one of ordinary texts.

A text is its words, A-Z lower-cased, each with a space in front. In either class the next byte
depends on the four before it (counts less a discount), then on the two before it (continuation
counts of the class, less the discount), then on the one before it. That last distribution is
shared by both classes and comes from the continuation counts of the whole corpus, so what is
rare in a class is as likely in the other. The difference of the two log-likelihoods, divided by
the length, becomes a probability by a monotone fit on labelled documents that neither model saw.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from paperloom.llm.arrow import map_texts, pieces
from paperloom.llm.words import Words, words_of
from paperloom.session import written

ORDERS = (5, 3)  # bytes of the grams of a class, the longest first
DISCOUNT = 2.0
FLOOR = 0.05  # added to every continuation count of the corpus
SHORT = 50  # bytes added to a length, so that a few bytes decide little
BINS = 2_000  # steps of the difference that the fit tells apart
RANGE = 2.0  # differences beyond this are as good as this
IN_STEP = 0.02  # share of the score that orders texts within a step of the fit
CLASSES = (1, 0)


@dataclass(frozen=True)
class Grams:
    """Counts of the grams of one order, with the sums of their contexts."""

    keys: np.ndarray  # sorted
    kept: np.ndarray  # counts less the discount
    contexts: np.ndarray  # sorted
    total: np.ndarray
    taken: np.ndarray  # what the discount took from a context

    @staticmethod
    def of(keys: np.ndarray, counts: np.ndarray) -> Grams:
        off = np.minimum(counts, DISCOUNT)
        contexts, first = np.unique(keys >> 8, return_index=True)
        if not len(keys):
            return Grams(keys, off, contexts, off, off)
        total, taken = (np.add.reduceat(x.astype(float), first) for x in (counts, off))
        return Grams(keys, counts - off, contexts, total, taken)

    def probability(self, keys: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Of the last byte of every key after the others, with ``lower`` to back off to."""
        if not len(self.keys):
            return lower
        at = _found(self.contexts, keys >> 8)
        total = np.where(at >= 0, self.total[at], 1.0)
        taken = np.where(at >= 0, self.taken[at], 1.0)
        place = _found(self.keys, keys)
        return (np.where(place >= 0, self.kept[place], 0.0) + taken * lower) / total


def _found(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the wanted keys, -1 for none."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@dataclass(frozen=True)
class Model:
    """``steps`` and ``share``: from which difference on what share of texts is toxic."""

    shared: np.ndarray  # probabilities by pair of bytes
    grams: dict[int, tuple[Grams, ...]]
    steps: np.ndarray
    share: np.ndarray

    def differences(self, keys: np.ndarray) -> np.ndarray:
        """Log-likelihood of the last byte of every long gram: toxic less ordinary."""
        logs = {}
        for c in CLASSES:
            likely = self.shared[keys & 0xFFFF]
            for order, grams in reversed(list(zip(ORDERS, self.grams[c]))):
                likely = grams.probability(keys & ((1 << 8 * order) - 1), likely)
            logs[c] = np.log(likely)
        return logs[1] - logs[0]

    def score(self, difference: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.steps, difference, side="right") - 1
        fitted = self.share[np.maximum(at, 0)]
        return (1 - IN_STEP) * fitted + IN_STEP / (1 + np.exp(-8 * np.clip(difference, -5, 5)))


def byte_grams(words: Words, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at every byte of the texts, as a number, and each text's length.

    Zero bytes stand before the beginning of a text.
    """
    n_words = len(words.starts) - 1
    sizes = np.diff(words.starts)
    flat = np.full(len(words.data) + n_words, ord(" "), dtype=np.uint8)
    flat[np.arange(len(words.data)) + np.repeat(np.arange(1, n_words + 1), sizes)] = words.data
    borders = np.append(0, np.cumsum(sizes + 1))[np.append(0, np.cumsum(words.per_text))]
    lengths = np.diff(borders)
    keys = flat.astype(np.int64)
    for back in range(1, order):
        before = np.zeros(len(flat), dtype=np.int64)
        before[back:] = flat[:-back]
        for i in range(back):  # the first bytes of a text have nothing so far before them
            first = borders[:-1][lengths > i] + i
            before[first] = 0
        keys |= before << (8 * back)
    return keys, lengths


def mean_differences(model: Model, texts: pa.Array) -> np.ndarray:
    """Difference of the log-likelihoods of each text, divided by its length; 0 for no word."""
    keys, lengths = byte_grams(words_of(texts), ORDERS[0])
    encoded = pa.array(keys).dictionary_encode()
    by_gram = model.differences(encoded.dictionary.to_numpy())
    each = by_gram[encoded.indices.to_numpy()]
    sums = np.zeros(len(lengths))
    some = np.flatnonzero(lengths)
    if len(some):
        sums[some] = np.add.reduceat(each, (np.cumsum(lengths) - lengths)[some])
    return sums / (lengths + SHORT)


# --- training --------------------------------------------------------------------------


def shared_continuations(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """P(byte | byte before it) of the whole corpus, at 256 * byte before + byte.

    A pair counts as often as there are different bytes before it in some document, so every
    task gives each of its grams of three bytes once. At most 65,536 rows come to the driver.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << 24, dtype=bool)
        for batch in batches:
            for piece in pieces(batch, "text"):
                seen[byte_grams(words_of(piece.column("text")), 3)[0]] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen).astype(np.int32))], ["gram"])

    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    grams = texts.mapInArrow(run, "gram int").distinct()
    pairs = grams.groupBy(F.col("gram").bitwiseAND(F.lit(0xFFFF)).alias("pair")).count().toArrow()
    counts = np.full(1 << 16, FLOOR)
    counts[pairs.column("pair").to_numpy()] += pairs.column("count").to_numpy()
    table = counts.reshape(256, 256)
    return (table / table.sum(axis=1, keepdims=True)).reshape(-1)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    docs_per_class: int,
    seed: int,
    id_col: str,
    text_col: str,
    label_col: str,
) -> DataFrame:
    """Rows (label, half, weight, text): about ``docs_per_class`` different documents of a class.

    Chosen by hash of id and text. Ids with several labels have the largest. ``half`` deals the
    documents out in two; ``weight`` is how many documents of its class one stands for.
    """
    given = (
        labels.where(F.col(f"`{label_col}`").isNotNull())
        .groupBy(F.col(f"`{id_col}`").alias("id"))
        .agg((F.max(f"`{label_col}`") > 0).cast("int").alias("label"))
    )
    text = F.col(f"`{text_col}`")
    keyed = docs.where(usable & text.isNotNull()).select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )
    known = written(keyed.select("id", "text_hash").distinct().join(given, "id"), "labelled")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = F.create_map(
        *[F.lit(x) for c in CLASSES for x in (c, min(1.0, docs_per_class / max(1, counts.get(c, 0))))]
    )[F.col("label")]
    place = F.xxhash64(F.lit(seed), "id", "text_hash")
    chosen = known.select(
        "id",
        "text_hash",
        "label",
        F.pmod(place, F.lit(2)).cast("int").alias("half"),
        (1 / share).alias("weight"),
        (F.shiftrightunsigned(place, 33) / F.lit(float(1 << 31)) < share).alias("taken"),
    ).where("taken")
    # About docs_per_class rows of numbers a class, whatever the corpus is.
    rows = keyed.join(F.broadcast(chosen), ["id", "text_hash"])
    once = rows.dropDuplicates(["id", "text_hash"]).select("label", "half", "weight", "text")
    return written(once, "sample")


def class_grams(sample: DataFrame) -> dict[int, tuple[Grams, ...]]:
    """Counts of both classes in the longest order, and continuation counts below it."""
    order = ORDERS[0]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                labels = np.array(piece.column("label").to_pylist())
                keys, lengths = byte_grams(words_of(piece.column("text")), order)
                of = np.repeat(labels, lengths)
                for c in CLASSES:
                    found, n = np.unique(keys[of == c], return_counts=True)
                    columns = [pa.repeat(pa.scalar(c, pa.int32()), len(found)), pa.array(found), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, ["label", "gram", "n"])

    counted = (
        sample.select("label", "text")
        .mapInArrow(run, "label int, gram bigint, n bigint")
        .groupBy("label", "gram")
        .agg(F.sum("n").alias("n"))
    )
    # As many rows as the bounded sample has different grams.
    rows = counted.toArrow()
    label, gram, n = (rows.column(c).to_numpy() for c in ("label", "gram", "n"))
    out = {}
    for c in CLASSES:
        order_by = np.argsort(gram[label == c])
        keys, counts = gram[label == c][order_by], n[label == c][order_by]
        found = [Grams.of(keys, counts)]
        for shorter in ORDERS[1:]:
            keys, counts = np.unique(keys & ((1 << 8 * shorter) - 1), return_counts=True)
            found.append(Grams.of(keys, counts))
        out[c] = tuple(found)
    return out


def monotone_fit(toxic: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Share of toxic documents by step, never falling: neighbours that fall are pooled.

    One toxic document in the lowest step and one ordinary one in the highest are added, so a
    few documents never make certain.
    """
    toxic, total = toxic.astype(float).copy(), total.astype(float).copy()
    toxic[0] += 1
    total[0] += 1
    total[-1] += 1
    blocks: list[list[float]] = []  # toxic, total, number of steps
    for a, b in zip(toxic, total):
        blocks.append([a, b, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a1, b1, n1 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + a1, blocks[-1][1] + b1, blocks[-1][2] + n1]
    return np.concatenate([np.full(int(n), a / b) for a, b, n in blocks])


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    docs_per_class: int = 6_000,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model | None:
    """Fit on about ``docs_per_class`` whole labelled documents of either class.

    Only documents of ids where ``usable`` (of the columns of ``docs``) holds, with a label that
    is not null and a text that is not null, count towards the classes; the shared backoff
    counts are those of all texts of ``docs``. None if a class has no document to learn from.
    """
    sample = labelled_sample(docs, labels, usable, docs_per_class, seed, id_col, text_col, label_col)
    grams = class_grams(sample)
    if not all(len(grams[c][0].keys) for c in CLASSES):
        return None
    shared = shared_continuations(docs, text_col)
    # Each half is judged by what the other half teaches.
    judged = [
        with_steps(sample.where(F.col("half") == half), Model(shared, other, np.zeros(1), np.zeros(1)))
        for half in (0, 1)
        if all(len((other := class_grams(sample.where(F.col("half") != half)))[c][0].keys) for c in CLASSES)
    ]
    if not judged:
        return Model(shared, grams, np.zeros(1), np.full(1, 0.5))
    # At most BINS + 1 rows of each half.
    rows = pa.concat_tables(judged).group_by("step").aggregate([("toxic", "sum"), ("total", "sum")])
    rows = rows.sort_by("step")
    # A step begins half a step below its middle.
    at = (rows.column("step").to_numpy() - 0.5) * (2 * RANGE / BINS) - RANGE
    share = monotone_fit(rows.column("toxic_sum").to_numpy(), rows.column("total_sum").to_numpy())
    return Model(shared, grams, at, share)


def with_steps(sample: DataFrame, model: Model) -> pa.Table:
    """(step, toxic, total): weights of the toxic and of all documents by step of the difference."""
    sent = sample.sparkSession.sparkContext.broadcast(model)
    fields = [StructField("difference", DoubleType(), False)]

    def prepare():
        return lambda texts: [pa.array(mean_differences(sent.value, pa.array(texts, pa.large_string())))]

    judged = map_texts(sample, "text", ["label", "weight"], fields, prepare)
    inside = F.greatest(F.least("difference", F.lit(RANGE)), F.lit(-RANGE))
    step = F.round((inside + RANGE) * (BINS / (2 * RANGE))).cast("int")
    weight = F.col("row.weight")
    return (
        judged.groupBy(step.alias("step"))
        .agg(F.sum(weight * F.col("row.label")).alias("toxic"), F.sum(weight).alias("total"))
        .toArrow()
    )


def predict(
    docs: DataFrame,
    model: Model | None,
    bar: float = 0.7,
    text_col: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """Rows (row, score, predicted) over whole texts; predicted is 1 from a score of ``bar`` on.

    Null texts and texts without a word have a difference of 0 and its score. Without a model
    every score is 0. ``row`` holds the columns of ``carry`` (all for None) whatever their names
    are; repeated rows are judged alike.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = [
        StructField("score", DoubleType(), False),
        StructField("predicted", IntegerType(), False),
    ]

    def prepare():
        known = sent.value

        def work(texts: list) -> list[pa.Array]:
            score = np.zeros(len(texts))
            if known is not None:
                score = known.score(mean_differences(known, pa.array(texts, pa.large_string())))
            return [pa.array(score), pa.array((score >= bar).astype(np.int32))]

        return work

    return map_texts(docs, text_col, carry, fields, prepare)
