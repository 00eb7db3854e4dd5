"""Word lists and aliases that come as tables instead of code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.exprs import present, strip_space, unique_ignoring_case
from paperloom.functions.normalization import alias_key
from paperloom.functions.patterns import any_of
from paperloom.functions.vocab import DEFAULT_VOCABULARY, RATIO_TAIL, Vocabulary
from paperloom.operators.joins import HOT_ROWS, spread_left_join

VOCABULARY = "field STRING, pattern STRING, ordinal INT, mode STRING"
FIRST, ALL = "first", "all"
#: More patterns than this fail: they would be compiled into one expression per field.
MAX_PATTERNS = 20_000
MAP_ALIASES = 1_000
BROADCAST_BYTES = 32 << 20
#: What a row costs a broadcast table beside its text.
ROW_BYTES = 64


def vocabulary_table(spark: SparkSession, vocab: Vocabulary = DEFAULT_VOCABULARY) -> DataFrame:
    """The word lists as rows (field, pattern, ordinal, mode), to be stored and extended."""
    lists = {
        ("lipids", ALL): vocab.lipids,
        ("ratio", FIRST): [cue + RATIO_TAIL for cue in vocab.ratio_cues],
        ("payload", FIRST): vocab.payloads,
        ("route", FIRST): vocab.routes,
        ("cells", ALL): vocab.cells,
    }
    rows = [
        (field, pattern, ordinal, mode)
        for (field, mode), patterns in lists.items()
        for ordinal, pattern in enumerate(patterns)
    ]
    return spark.createDataFrame(rows, VOCABULARY)


def extract_fields(
    df: DataFrame, text: str, vocabulary: DataFrame, whole_words: bool = False
) -> DataFrame:
    """Add a column per field of the vocabulary, found in the column ``text``.

    At each position of the text the patterns of a field are tried by ``ordinal``, equal ones by
    pattern, ignoring case. A field of mode ``first`` is the first match without white space around
    it, null if there is none; one of mode ``all`` is an array of all matches in order, distinct
    ignoring case, empty if there are none. Rows of the vocabulary without field or pattern count
    as absent; a field of two modes is an error. Columns of the same name are replaced.
    """
    usable = vocabulary.where(present(F.col("field")).isNotNull() & present(F.col("pattern")).isNotNull())
    rows = usable.select("field", "pattern", "ordinal", "mode").limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"a vocabulary has at most {MAX_PATTERNS} patterns")
    rows.sort(key=lambda r: (r["field"], r["ordinal"] is None, r["ordinal"] or 0, r["pattern"]))
    columns: dict[str, Column] = {}
    for field in dict.fromkeys(r["field"] for r in rows):
        modes = {r["mode"] for r in rows if r["field"] == field}
        if len(modes) != 1 or not modes <= {FIRST, ALL}:
            raise ValueError(f"field {field!r} needs one mode, {FIRST} or {ALL}: {sorted(map(str, modes))}")
        patterns = tuple(dict.fromkeys(r["pattern"] for r in rows if r["field"] == field))
        pattern = F.lit(any_of(patterns, whole_words))
        body = F.col(text)
        if modes == {FIRST}:
            columns[field] = strip_space(F.regexp_substr(body, pattern))
        else:
            hits = F.regexp_extract_all(F.coalesce(body, F.lit("")), pattern, F.lit(0))
            columns[field] = unique_ignoring_case(hits)
    return df.withColumns(columns) if columns else df


def canonical_column(
    df: DataFrame,
    column: str,
    aliases: DataFrame,
    *,
    map_aliases: int = MAP_ALIASES,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``column`` with aliases replaced by their canonical names from a table (alias, canonical).

    The rule is that of ``canonicalize``: the value is trimmed, compared in lower case without
    spaces and full stops around it, and stays as it is (trimmed) where it has no alias; null
    becomes empty. Aliases are compared in the same form; of several rows for one alias the
    smallest canonical name counts, and rows with a null are ignored.

    How the table is looked up follows from its counted size: a map in the plan, a broadcast of
    known bytes, or a join whose hot and empty keys are dealt over many tasks. The result is the
    same.
    """
    table = (
        aliases.select(alias_key(F.col("alias")).alias("_key"), F.col("canonical").alias("_name"))
        .where(F.col("alias").isNotNull() & F.col("canonical").isNotNull())
        .groupBy("_key")
        .agg(F.min("_name").alias("_name"))
    )
    n_rows, n_bytes = table.agg(
        F.count("*"),
        F.coalesce(F.sum(F.octet_length("_key") + F.octet_length("_name") + ROW_BYTES), F.lit(0)),
    ).first()
    trimmed = strip_space(F.coalesce(F.col(column), F.lit("")))
    if n_rows <= map_aliases:
        pairs = [F.lit(x) for r in table.collect() for x in (r["_key"], r["_name"])]
        name = F.try_element_at(F.create_map(*pairs), alias_key(F.col(column))) if pairs else F.lit(None)
        return df.withColumn(column, F.coalesce(name, trimmed))
    keyed = df.withColumn("_key", alias_key(F.col(column)))
    if n_bytes <= broadcast_bytes:
        found = keyed.join(F.broadcast(table), "_key", "left")
    else:
        found = spread_left_join(
            keyed, table, "_key", F.monotonically_increasing_id(), hot_rows=hot_rows
        )
    return found.withColumn(column, F.coalesce("_name", trimmed)).select(*[f"`{c}`" for c in df.columns])
