"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of a bounded number of labelled documents per language. The matrix of
log probabilities (buckets x languages) has a fixed size and is broadcast. Scoring gathers, for
each n-gram of a batch of texts, one row of the matrix and sums the rows of each text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from paperloom.llm.arrow import map_texts, pieces

BUCKETS = 1 << 15
SIZES = (1, 2, 3)  # lengths of the n-grams in characters
UNDETERMINED = "und"
MAX_LANGUAGES = 1_000  # the matrix is broadcast, so its size is bounded
TEXT_BYTES = 1 << 20  # text whose n-grams are held at once, unless a single text is larger
ROWS_AT_ONCE = 1 << 22  # numbers of the matrix gathered at once
COUNTS = "lang string, bucket int, n bigint"


NO_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Languages in order, their log priors, and log probabilities (buckets x languages).

    With ``letters_only`` every run of other characters of a text counts as one space.
    """

    langs: tuple[str, ...]
    prior: np.ndarray
    log_prob: np.ndarray
    letters_only: bool = False

    def prepared(self, texts: list[str]) -> list[str]:
        return [only_letters(t) for t in texts] if self.letters_only else texts


def only_letters(text: str) -> str:
    return NO_LETTERS.sub(" ", text).strip()


def ngram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of lower-cased texts, and the number of each text's n-grams.

    Every text is framed by one space on both sides, and n-grams stay inside a text.
    """
    framed = [f" {t.lower()} " for t in texts]
    lengths = np.fromiter(map(len, framed), dtype=np.int64, count=len(framed))
    points = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    text_of = np.repeat(np.arange(len(texts)), lengths)
    buckets, owners = [], []
    rolling = np.zeros(len(points), dtype=np.uint32)
    for n in range(1, max(SIZES) + 1):
        shifted = rolling[: len(points) - n + 1] * np.uint32(0x01000193)
        rolling = (shifted ^ points[n - 1 :]) * np.uint32(0x9E3779B1) + np.uint32(n)
        if n in SIZES and len(rolling):
            inside = text_of[: len(rolling)] == text_of[n - 1 :]
            mixed = rolling ^ (rolling >> np.uint32(15))
            buckets.append((mixed[inside] & np.uint32(BUCKETS - 1)).astype(np.int32))
            owners.append(text_of[: len(rolling)][inside])
    all_buckets = np.concatenate(buckets) if buckets else np.empty(0, np.int32)
    owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
    order = np.argsort(owner, kind="stable")
    return all_buckets[order], np.bincount(owner, minlength=len(texts))


def train(
    docs: DataFrame,
    usable: Column,
    docs_per_lang: int = 2_000,
    smoothing: float = 0.5,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    letters_only: bool = False,
) -> Model | None:
    """Fit on about ``docs_per_lang`` whole documents of each language, chosen by hash of the id.

    Only rows where ``usable`` holds and text and language are not null count. With fewer
    documents than the bound, all are used; None if there is nothing to learn from. Equal
    priors, since the shares of the sample are not those of what is to be judged.
    """
    labelled = docs.where(
        usable & F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull()
    ).select(
        F.col(f"`{lang_col}`").alias("lang"),
        F.col(f"`{text_col}`").alias("text"),
        F.xxhash64(F.lit(seed), F.col(f"`{id_col}`")).alias("key"),
    )
    sizes = labelled.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    if not sizes:
        return None
    # A share of each language's key space gives the wanted number of documents on average.
    shares = [(row["lang"], min(1.0, docs_per_lang / row["count"])) for row in sizes]
    share = F.create_map(*[F.lit(x) for pair in shares for x in pair])[F.col("lang")]
    place = F.shiftrightunsigned("key", 33) / F.lit(float(1 << 31))
    sample = labelled.where(place < share).select("lang", "text")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in pieces(batch, "text", TEXT_BYTES):
                langs = piece.column("lang").to_pylist()
                texts = piece.column("text").to_pylist()
                buckets, lengths = ngram_buckets([only_letters(t) for t in texts] if letters_only else texts)
                ends = np.cumsum(lengths)
                for lang, start, end in zip(langs, ends - lengths, ends):
                    total = found.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    np.add.at(total, buckets[start:end], 1)
        for lang, total in found.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(used), pa.string()),
                    pa.array(used.astype(np.int32)),
                    pa.array(total[used]),
                ],
                ["lang", "bucket", "n"],
            )

    counted = sample.mapInArrow(count, COUNTS).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # At most MAX_LANGUAGES x BUCKETS rows, whatever the corpus is.
    rows = counted.toArrow()
    langs = sorted(set(rows.column("lang").to_pylist()))
    counts = np.full((BUCKETS, len(langs)), smoothing)
    place_of = {lang: i for i, lang in enumerate(langs)}
    columns = np.array([place_of[x] for x in rows.column("lang").to_pylist()], dtype=np.int64)
    counts[rows.column("bucket").to_numpy(), columns] += rows.column("n").to_numpy()
    log_prob = np.log(counts) - np.log(counts.sum(axis=0))
    return Model(tuple(langs), np.full(len(langs), -np.log(len(langs))), log_prob, letters_only)


def log_scores(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of each text in each language (texts x languages), and its n-grams' number."""
    buckets, lengths = ngram_buckets(model.prepared(texts))
    total = np.zeros((len(texts), len(model.langs)))
    owner = np.repeat(np.arange(len(texts)), lengths)
    step = max(1, ROWS_AT_ONCE // len(model.langs))
    for start in range(0, len(buckets), step):
        part = owner[start : start + step]
        rows = model.log_prob[buckets[start : start + step]]
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        total[part[first]] += np.add.reduceat(rows, first, axis=0)
    return total, lengths


def score_texts(model: Model, texts: list[str]) -> np.ndarray:
    """Posterior probability of each language for each text, (texts x languages)."""
    return posterior(model, log_scores(model, texts)[0])


def posterior(model: Model, logs: np.ndarray) -> np.ndarray:
    total = logs + model.prior
    total -= total.max(axis=1, keepdims=True)
    likely = np.exp(total)
    return likely / likely.sum(axis=1, keepdims=True)


def predict(
    docs: DataFrame,
    model: Model | None,
    text_col: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """Rows (row, lang_pred, score, fit) over whole texts; score is the posterior of the prediction.

    The posterior says which language is likeliest, not whether the text is in it: it is near 1
    for any long text. ``fit`` is the text's mean log probability per n-gram in the predicted
    language, less what that language's own texts have on average, and does not depend on the
    length: near 0 for texts of the language, far below for others. It is null for ``und``.

    Null texts, texts without a letter, and every text where there is no model are ``und``
    with score 0. Ties go to the first language in order. ``row`` holds the columns of
    ``carry`` (all for None) whatever their names are; repeated rows are judged alike.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = [
        StructField("lang_pred", StringType(), False),
        StructField("score", DoubleType(), False),
        StructField("fit", DoubleType(), True),
    ]

    def prepare():
        known = sent.value
        if known is not None:
            entropy = -(np.exp(known.log_prob) * known.log_prob).sum(axis=0)

        def work(texts: list) -> list[pa.Array]:
            pred, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            fit = np.full(len(texts), np.nan)
            at = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
            if known is not None and at:
                logs, lengths = log_scores(known, [texts[i] for i in at])
                likely = posterior(known, logs)
                best = likely.argmax(axis=1)
                score[at] = likely[np.arange(len(at)), best]
                fit[at] = logs[np.arange(len(at)), best] / lengths + entropy[best]
                for i, b in zip(at, best):
                    pred[i] = known.langs[b]
            return [pa.array(pred, pa.string()), pa.array(score), pa.array(fit, mask=np.isnan(fit))]

        return work

    return map_texts(docs, text_col, carry, fields, prepare, TEXT_BYTES)
