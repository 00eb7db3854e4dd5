"""Line deduplication over a corpus, with DataFrame functions only.

Lines are compared by key: all of space and 0x09-0x0D stripped at both ends, A-Z lower-cased.
Occurrences (hash, document, position) are range-partitioned by hash with a secondary sort by
document and position, and windows stream over the sorted runs to find first occurrences. A
hash that fills many documents is split over runs by document, so it never meets in one task.
What comes back is one compressed bitmap per document and no text: 64-bit words of kept
lines, with only the words listed that lose a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.exprs import let
from paperloom.llm.shared import ascii_lower
from paperloom.session import written

BLANKS = " \t\n\x0b\f\r"


def split_lines(text: Column) -> Column:
    """Lines of a text; null and empty text have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_bitmaps(
    docs: DataFrame,
    min_docs: int = 2,
    keep_first: bool = False,
    min_chars: int = 1,
    runs: int = 256,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Keep bitmaps of the documents that lose a line.

    Keys of at least ``min_chars`` code points that occur in at least ``min_docs`` documents
    lose all their lines, or all but the first by document id and position with
    ``keep_first``. Documents are told apart by id; a null id is one document. Rows that
    repeat an id are treated by their own text: a bitmap belongs to (id, hash of the text),
    and equal rows share it.

    Returns doc_id, text_hash, keep_words array<struct<word:int,bits:bigint>>: bit b of word w
    tells whether line 64 * w + b stays; words not listed are all ones. ``runs`` bounds the
    share of a key's occurrences that one task sees.
    """
    text = F.col(f"`{text_col}`")
    lines = docs.select(
        F.col(f"`{id_col}`").alias("doc"),
        F.xxhash64(text).alias("text_hash"),
        F.posexplode(F.transform(split_lines(text), line_key)).alias("pos", "key"),
    )
    occurrences = written(
        lines.where(F.char_length("key") >= min_chars).select(
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), "key").alias("h2"),
            F.pmod(F.xxhash64("doc"), F.lit(runs)).cast("int").alias("run"),
            "doc",
            "text_hash",
            "pos",
        ),
        "lines",
    )
    run_key = ["h1", "h2", "run"]
    sorted_runs = occurrences.repartitionByRange(*run_key)
    in_run = Window.partitionBy(*run_key).orderBy("doc", "pos")
    before = F.lag(F.struct("doc")).over(in_run)
    firsts = sorted_runs.withColumn(
        "new_doc", F.when(before.isNull() | ~before.eqNullSafe(F.struct("doc")), 1).otherwise(0)
    )
    # One row per run, at most `runs` of them per key.
    summary = firsts.groupBy(*run_key).agg(
        F.sum("new_doc").alias("n_docs"), F.min(F.struct("doc", "pos")).alias("first")
    )
    of_key = Window.partitionBy("h1", "h2")
    repeated = (
        summary.withColumn("all_docs", F.sum("n_docs").over(of_key))
        .withColumn("first", F.min("first").over(of_key))
        .where(F.col("all_docs") >= min_docs)
        .select(*run_key, "first")
    )
    dropped = occurrences.join(repeated, run_key)
    if keep_first:
        dropped = dropped.where(~F.struct("doc", "pos").eqNullSafe(F.col("first")))
    per_word = dropped.groupBy(
        "doc", "text_hash", F.floor(F.col("pos") / 64).cast("int").alias("word")
    ).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("lost"))
    return per_word.groupBy(F.col("doc").alias("doc_id"), "text_hash").agg(
        F.sort_array(
            F.collect_list(F.struct("word", F.bitwise_not("lost").alias("bits")))
        ).alias("keep_words")
    )


def dropped_positions(keep_words: Column) -> Column:
    """Positions of the lines that a bitmap drops, in order; null for a null bitmap."""
    return F.flatten(
        F.transform(
            keep_words,
            lambda w: F.transform(
                F.filter(
                    F.sequence(F.lit(0), F.lit(63)),
                    lambda b: F.getbit(w["bits"], b) == 0,
                ),
                lambda b: w["word"] * 64 + b,
            ),
        )
    )


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 2,
    keep_first: bool = False,
    min_chars: int = 1,
    runs: int = 256,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Documents without their repeated lines: every row as struct ``row``, with ``kept``.

    ``kept`` is a struct of text (the lines that stay, joined by ``\\n``), n_lines and
    n_dropped; null and empty texts have one empty line, which always stays, so their kept
    text is empty. Other columns pass through whatever their names are.
    """
    maps = line_bitmaps(docs, min_docs, keep_first, min_chars, runs, id_col, text_col)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_col}`").alias("doc"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("hash_of_text"),
    )
    joined = rows.join(
        maps,
        (F.col("hash_of_text") == F.col("text_hash")) & F.col("doc").eqNullSafe(F.col("doc_id")),
        "left",
    )
    n_lines = F.size(split_lines(F.col(f"row.`{text_col}`"))).cast("bigint")
    lost = F.coalesce(
        dropped_positions(F.col("keep_words")), F.array().cast("array<int>")
    )
    numbered = joined.select("row", "keep_words", n_lines.alias("n_lines"), lost.alias("lost"))
    lines = split_lines(F.col(f"row.`{text_col}`"))
    left = F.array_except(
        F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), F.col("lost")
    )
    without = let(
        lines,
        lambda all_lines: F.array_join(F.transform(left, lambda i: F.get(all_lines, i)), "\n"),
    )
    whole = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    kept = F.when(F.col("keep_words").isNull(), whole).otherwise(without)
    return numbered.select(
        "row",
        F.struct(
            kept.alias("text"), "n_lines", F.size("lost").cast("bigint").alias("n_dropped")
        ).alias("kept"),
    )
