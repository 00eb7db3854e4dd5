"""A corpus pipeline of five stages; each stage's result is written and read by the next.

Language ID rejects what is in no language, line dedup removes repeated lines, the n-gram
Jaccard join leaves one document of each group of near duplicates, mixing repeats or thins
sources to their target weights, and BPE coding turns the texts into token ids.

All stages but the last return the columns of ``documents``, other columns included. Null and
empty texts are rejected by the first stage; a later stage given such rows keeps them. Empty
tables give empty results. A document without an id is a document of its own, which its copies
meet like any other. Repeated rows are one document to the Jaccard join; mixing gives equal rows
one number of copies.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import bpe, jaccard_join, langid, line_dedup, mixing
from paperloom.llm.queries import held_out_column
from paperloom.llm.shared import SPACE
from paperloom.session import written

MIN_SCORE = 0.5  # least posterior of a document's language
MIN_FIT = -1.5  # least log probability per n-gram against that of the language's own texts
REPEATED_IN = 10  # documents a line occurs in before it counts as repeated
SIMILARITY = (4, 5)
SHINGLE = 5
WEIGHTS = [5, 2, 1]
SHARE = 1.5
MOST = 2.0


def _packed(docs: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def _unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents with a language: letters, a likeliest language, and a fit to it.

    Texts of random letters or of a language that was not learned have a likeliest language too,
    but their n-grams are far from it. Digits and marks do not count.
    """
    model = langid.train(docs, usable=~held_out_column(F.col("doc_id")), letters_only=True)
    found = langid.predict(docs, model)
    certain = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_SCORE)
    return _unpacked(found.where(certain & (F.col("fit") >= MIN_FIT)))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep repeated lines in the first document only; documents left without a word go.

    text and n_chars are those of what is kept.
    """
    kept = line_dedup.dedup_lines(docs, min_docs=REPEATED_IN, keep_first=True)
    filled = (F.col("kept.n_dropped") == 0) | F.col("kept.text").rlike(f"[^{SPACE}]")
    changed = F.col("kept.n_dropped") > 0
    text = F.when(changed, F.col("kept.text")).otherwise(F.col("row.text"))
    n_chars = F.when(changed, F.char_length("kept.text").cast("bigint")).otherwise(
        F.col("row.n_chars")
    )
    row = F.col("row").withField("text", text).withField("n_chars", n_chars)
    return kept.where(filled).select(row.alias("row")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one with the smallest id.

    Rows that repeat id and text are one document. Documents without an id come after all that
    have one, in the order of a hash of their text. Documents without words stay row by row.
    """
    text_hash = F.xxhash64("text")
    keyed = docs.select(
        _packed(docs), text_hash.alias("text_hash"), F.col("doc_id").alias("own_id"), F.col("text")
    )
    # A document without an id gets one beyond all others, so it meets its copies too. Where the
    # ids leave no room for that it keeps none, and stays.
    last = docs.agg(F.greatest(F.max("doc_id"), F.lit(0)).cast("bigint")).first()[0]
    beyond = F.try_add(F.lit(last).cast("bigint"), F.shiftrightunsigned("text_hash", 2) + 1)
    numbered = keyed.withColumn("node", F.coalesce("own_id", beyond))
    found = jaccard_join.join_documents(
        numbered.select("node", "text"), similarity=SIMILARITY, width=SHINGLE, id_col="node"
    )
    first = (
        found.where((F.col("n_shingles") > 0) & (F.col("component_id") == F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("text_hash").alias("hash"))
        .withColumn("alone", F.lit(False))
    )
    alone = found.where("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", F.col("text_hash").alias("hash"), F.lit(True).alias("alone")
    )
    stays = first.unionByName(alone.distinct()).withColumnRenamed("doc_id", "id")
    same = (F.col("text_hash") == F.col("hash")) & F.col("node").eqNullSafe(F.col("id"))
    kept = numbered.join(stays, same)
    # Rows that repeat a kept document are the same document; those without words stay all.
    number = F.when(F.col("alone"), F.monotonically_increasing_id()).otherwise(F.lit(0))
    once = kept.select("row", "text_hash", "node", number.alias("number"))
    return _unpacked(once.dropDuplicates(["text_hash", "node", "number"]))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the document on a cut by its larger part."""
    taken = mixing.mix(docs, weights=WEIGHTS, share=SHARE, most=MOST)
    copies = mixing.repeats(F.col("size"), F.col("epochs"), F.col("part"))
    per_document = (
        taken.withColumn("copies", copies)
        .groupBy(
            F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.col("source").alias("of")
        )
        .agg(F.round(F.avg("copies")).cast("int").alias("copies"))
        .where("copies > 0")
    )
    rows = docs.select(
        _packed(docs),
        F.xxhash64("text").alias("text_hash"),
        F.col("doc_id").alias("own_id"),
        F.col("source").alias("own_source"),
    )
    same = (
        (F.col("text_hash") == F.col("hash"))
        & F.col("own_id").eqNullSafe(F.col("id"))
        & F.col("own_source").eqNullSafe(F.col("of"))
    )
    mixed = rows.join(per_document, same)
    return _unpacked(mixed.select("row", F.explode(F.sequence(F.lit(1), "copies"))))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, decoded again: doc_id, lang, source, n_tokens, ids, decoded_sha256."""
    model = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode_texts(docs, model, carry=["doc_id", "lang", "source"])
    n_tokens = F.size("ids").cast("bigint").alias("n_tokens")
    return coded.select("row.*", n_tokens, "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("tokens", tokens),
]

# Language ID by a trained model is beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, from ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
