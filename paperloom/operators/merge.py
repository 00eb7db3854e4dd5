"""Keyed snapshots: upsert, insert-or-ignore, column changes, uniqueness of DOIs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from paperloom.functions.exprs import first_present
from paperloom.operators.joins import HOT_ROWS, spread_left_join
from paperloom.operators.ranking import assign_ids
from paperloom.operators.spread import scan_bytes
from paperloom.session import SLICE, Slices, forget, written

DOCUMENT_KEY = ["source_name", "external_id"]
NULLABLE_COLUMNS = [
    "doi",
    "pmid",
    "pmcid",
    "journal_or_site",
    "publication_date",
    "source_url",
    "abstract_text",
    "full_text_path",
    "raw_hash",
]
DISCOVERED = "DISCOVERED"
# Slices of a batch, and how many bytes of values are merged at once, for each core of the cluster, if
# they are in several slices. A merge has no more than that shuffled and not yet written.
SLICES = 32
MERGED_BYTES = 128 << 20
# Bytes of values in a byte of a snapshot's files, roughly.
UNPACKED = 3
BYTES = "_bytes"


def fold_updates(batch: DataFrame, key: list[str], order: str) -> DataFrame:
    """One row per key: last non-null value of each column, last title and status.

    ``first_seq`` is the first position of the key in the batch, ``value_seq`` the position
    each value comes from. Rows without a complete key stay as they are: they match nothing,
    not even each other.
    """
    keyed_rows = has_key(key)
    keyed = _fold_keyed(batch.where(keyed_rows), key, order)
    return keyed.unionByName(_unfolded(batch.where(~keyed_rows), key, order))


def _filled(batch: DataFrame) -> tuple[DataFrame, list[str]]:
    """The batch with title and status, and the names of its value columns."""
    filled = batch.withColumns(
        {
            "title": first_present(F.col("title"), F.lit("Untitled")),
            "pipeline_status": F.coalesce(F.col("pipeline_status"), F.lit(DISCOVERED))
            if "pipeline_status" in batch.columns
            else F.lit(DISCOVERED),
        }
    )
    return filled, [*[c for c in NULLABLE_COLUMNS if c in batch.columns], "title", "pipeline_status"]


def _positions(values: list[str], of: Callable[[str], Column]) -> Column:
    return F.create_map(*[x for c in values for x in (F.lit(c), of(c))]).alias("value_seq")


def _position(column: str, order: str) -> Column:
    return F.when(F.col(column).isNotNull(), F.col(order))


def _fold_keyed(batch: DataFrame, key: list[str], order: str) -> DataFrame:
    filled, values = _filled(batch)
    return filled.groupBy(*key).agg(
        *[F.max_by(c, _position(c, order)).alias(c) for c in values],
        F.min(order).alias("first_seq"),
        _positions(values, lambda c: F.max(_position(c, order))),
    )


def _unfolded(batch: DataFrame, key: list[str], order: str) -> DataFrame:
    filled, values = _filled(batch)
    positions = _positions(values, lambda c: _position(c, order))
    return filled.select(*key, *values, F.col(order).alias("first_seq"), positions)


def has_key(key: list[str]) -> Column:
    """Whether a row has all columns of the key."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])


def upsert_documents(
    current: DataFrame, batch: DataFrame, key: list[str] | None = None, order: str = "ingest_seq"
) -> DataFrame:
    """New snapshot of ``current`` after the batch.

    A known key takes each non-null value of the batch and keeps the old one otherwise; its
    status is always the new one. If the snapshot has a column ``value_seq``, it remembers the
    position each value came from, and only values from later positions replace it: then the
    result is the same however rows are cut into batches and whenever they arrive, but for the
    ids. Unknown keys get the next ids in order of arrival.

    Ids are found on keys alone, and joined by key like the snapshot, so the wide rows of the batch
    are shuffled once, when they are folded; ``upsert_slices`` does the same in parts. Only keyed rows are joined, since rows without a key
    would all meet in one task. The batch is read for its keys first and then as a whole, so it
    has to give the same rows each time.
    """
    key = key or DOCUMENT_KEY
    places = _places(batch, key, order)
    ids = _ids_after(current, places, key)
    return _upserted(current, batch, ids, key, order, _any_loose(places, key))


def upsert_slices(
    current: DataFrame, batch: DataFrame, key: list[str] | None = None, order: str = "ingest_seq"
) -> Iterator[tuple[DataFrame, bool]]:
    """``upsert_documents`` in parts, each with whether it is the last.

    The batch is read once and written in slices of the keys, which are merged one after the other, so
    no shuffle holds the whole of it. A part has to be written before the next is asked for, which
    deletes what it was made of.
    """
    key = key or DOCUMENT_KEY
    keyed_rows = has_key(key)

    def number(otherwise: str) -> Column:
        # Rows without a key would all have the same few hashes.
        return F.when(keyed_rows, F.xxhash64(*key)).otherwise(F.xxhash64(otherwise))

    updates = Slices(_sized(current, batch, key, order), number(order), SLICES, "updates")
    places = _places(updates.all(), key, order)
    ids = _ids_after(current, places, key)
    any_loose = _any_loose(places, key)
    forget(places)
    groups = _groups(updates.all(), current)
    if len(groups) == 1:
        yield _upserted(current, updates.read(groups[0]), ids, key, order, any_loose), True
        updates.drop(groups[0])
        return
    old = Slices(current, number("document_id"), SLICES, "current")
    ids = ids.withColumn(SLICE, F.pmod(number("first_seq"), F.lit(SLICES)))
    for group in groups:
        new = ids.where(F.col(SLICE).isin(group))
        part = _upserted(old.read(group), updates.read(group), new, key, order, any_loose)
        yield part, group is groups[-1]
        old.drop(group)
        updates.drop(group)


def _groups(updates: DataFrame, current: DataFrame) -> list[list[int]]:
    """Slices that are merged together."""
    rows = updates.groupBy(SLICE).agg(F.sum(BYTES).alias("n")).collect()
    size = {r[SLICE]: r["n"] for r in rows}
    old = UNPACKED * scan_bytes(current)[0] / SLICES if current.inputFiles() else 0
    most = MERGED_BYTES * updates.sparkSession.sparkContext.defaultParallelism
    groups, room = [], 0
    for k in range(SLICES):
        n = size.get(k, 0) + old
        if not groups or n > room:
            groups.append([])
            room = most
        groups[-1].append(k)
        room -= n
    return groups


def _sized(current: DataFrame, batch: DataFrame, key: list[str], order: str) -> DataFrame:
    """The columns of the batch that a merge reads, each of a type that can be written, and their bytes."""
    names = [c for c in [*NULLABLE_COLUMNS, "title", "pipeline_status"] if c in batch.columns]
    typed = [
        F.col(c).cast(current.schema[c].dataType if c in current.columns else "string").alias(c)
        if isinstance(batch.schema[c].dataType, NullType)
        else F.col(c)
        for c in names
    ]
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("bigint") for c in names]
    return batch.select(*key, order, *typed, reduce(lambda a, b: a + b, sizes).alias(BYTES))


def _places(batch: DataFrame, key: list[str], order: str) -> DataFrame:
    """Keys of the batch (*key, first_seq), written."""
    # Rows without a key stay apart, each by a number of its own.
    own = F.when(~has_key(key), F.monotonically_increasing_id()).alias("_own")
    return written(
        batch.select(*key, order, own)
        .groupBy(*key, "_own")
        .agg(F.min(order).alias("first_seq"))
        .drop("_own"),
        "places",
    )


def _ids_after(current: DataFrame, places: DataFrame, key: list[str]) -> DataFrame:
    """Ids of what is new in ``places``, after those of the snapshot."""
    last_id = current.agg(F.max("document_id")).first()[0] or 0
    return _new_ids(current, places, key, last_id)


def _any_loose(places: DataFrame, key: list[str]) -> bool:
    return not places.where(~has_key(key)).isEmpty()


def _upserted(
    current: DataFrame, batch: DataFrame, ids: DataFrame, key: list[str], order: str, any_loose: bool
) -> DataFrame:
    keyed_rows = has_key(key)
    keyed = _fold_keyed(batch.where(keyed_rows), key, order)
    loose = _unfolded(batch.where(~keyed_rows), key, order) if any_loose else None
    return _merged(current, keyed, loose, ids, key)


def merge_folded(
    current: DataFrame, folded: DataFrame, key: list[str], last_id: int
) -> DataFrame:
    """``upsert_documents`` after its folding; new ids follow ``last_id``.

    ``current`` may be a part of the snapshot, if it has all rows with the keys of ``folded``.
    """
    keyed_rows = has_key(key)
    ids = _new_ids(current, folded, key, last_id)
    return _merged(current, folded.where(keyed_rows), folded.where(~keyed_rows), ids, key)


def _new_ids(current: DataFrame, places: DataFrame, key: list[str], last_id: int) -> DataFrame:
    """Ids (*key, first_seq, new_id) of what is new in ``places`` (*key, first_seq)."""
    keyed_rows = has_key(key)
    places = places.select(*key, "first_seq")
    known = current.where(keyed_rows).select(*key)
    arrivals = places.where(keyed_rows).join(known, key, "left_anti")
    return assign_ids(
        arrivals.unionByName(places.where(~keyed_rows)), "first_seq", "new_id", last_id + 1
    )


def _merged(
    current: DataFrame, keyed: DataFrame, loose: DataFrame | None, ids: DataFrame, key: list[str]
) -> DataFrame:
    """The snapshot after folded rows with a key and, if there are any, rows without one."""
    carried = [c for c in NULLABLE_COLUMNS if c in current.columns]
    for c in carried:
        if c not in keyed.columns:
            missing = F.lit(None).cast(current.schema[c].dataType)
            keyed = keyed.withColumn(c, missing)
            loose = loose.withColumn(c, missing) if loose is not None else None
    values = [*carried, "title", "pipeline_status"]
    keyed_rows = has_key(key)
    fresh = keyed.join(ids.where(keyed_rows).select(*key, "new_id"), key, "left")

    remembers = "value_seq" in current.columns
    old = current.where(keyed_rows).select(
        *key,
        "document_id",
        *[F.col(c).alias(f"old_{c}") for c in values],
        *([F.col("value_seq").alias("old_seq")] if remembers else []),
    )

    def chosen(c: str) -> Column:
        if not remembers:
            return F.coalesce(F.col(c), F.col(f"old_{c}"))
        newer = F.coalesce(_at("value_seq", c) >= _at("old_seq", c), _at("old_seq", c).isNull())
        return F.when(F.col(c).isNotNull() & newer, F.col(c)).otherwise(F.col(f"old_{c}"))

    positions = F.create_map(
        *[
            x
            for c in values
            for x in (F.lit(c), F.greatest(_at("value_seq", c), _at("old_seq", c)))
        ]
    )
    columns = ["document_id", *key, *values, *(["value_seq"] if remembers else [])]
    merged = old.join(fresh, key, "full").select(
        F.coalesce("document_id", "new_id").alias("document_id"),
        *key,
        *[chosen(c).alias(c) for c in values],
        *([positions.alias("value_seq")] if remembers else []),
    )
    merged = merged.unionByName(current.where(~keyed_rows).select(*columns))
    if loose is None:
        return merged
    places = ids.where(~keyed_rows).select("first_seq", F.col("new_id").alias("document_id"))
    return merged.unionByName(loose.join(places, "first_seq", "left").select(*columns))


def _at(positions: str, column: str) -> Column:
    return F.try_element_at(positions, F.lit(column))


def add_new_sources(sources: DataFrame, candidates: DataFrame, order: str = "seq") -> DataFrame:
    """Insert-or-ignore by name: known sources stay as they are, new ones get the next ids."""
    first = candidates.groupBy("name").agg(
        F.min_by(F.struct("homepage", "api_url"), order).alias("_row"),
        F.min(order).alias("_first"),
    )
    unknown = first.join(sources.select("name"), "name", "left_anti")
    last_id = sources.agg(F.max("source_id")).first()[0] or 0
    added = assign_ids(unknown, "_first", "source_id", last_id + 1).select(
        F.col("source_id").cast(sources.schema["source_id"].dataType).alias("source_id"),
        "name",
        "_row.homepage",
        "_row.api_url",
    )
    return sources.unionByName(added, allowMissingColumns=True)


def apply_changes(
    current: DataFrame, changes: DataFrame, key: str = "document_id", order: str | None = None
) -> DataFrame:
    """Overwrite columns of the rows named in ``changes``; null means no change.

    ``current`` has one row per key. Several changes of a key count in the order of ``order``,
    a column of ``changes``; without it their order is open, and the largest change, compared
    column by column, counts as a whole. Keys that ``current`` lacks are ignored.
    """
    columns = [c for c in changes.columns if c not in (key, order)]
    grouped = changes.groupBy(key)
    if order:
        renamed = grouped.agg(
            *[
                F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"new_{c}")
                for c in columns
            ]
        )
    else:
        renamed = grouped.agg(F.max(F.struct(*columns)).alias("_change")).select(
            key, *[F.col(f"_change.{c}").alias(f"new_{c}") for c in columns]
        )
    joined = current.join(renamed, key, "left")
    return joined.select(
        *[
            F.coalesce(F.col(f"new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c)
            for c in current.columns
        ]
    )


def mark_doi_conflicts(
    docs: DataFrame, order: str, doi: str = "doi", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``conflicts_with``: the earliest row with the same DOI, null on that row itself.

    Null DOIs never collide, empty strings do.
    """
    owners = docs.where(F.col(doi).isNotNull()).groupBy(doi).agg(
        F.min(order).alias("_owner"), F.count("*").alias("n_rows")
    )
    joined = spread_left_join(
        docs,
        owners.select(doi, "_owner"),
        doi,
        F.col(order),
        key_counts=owners.select(doi, "n_rows"),
        hot_rows=hot_rows,
    )
    return joined.withColumn(
        "conflicts_with", F.when(F.col("_owner") != F.col(order), F.col("_owner"))
    ).drop("_owner")


def split_doi_conflicts(
    docs: DataFrame, order: str, doi: str = "doi", hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Rows that keep DOIs unique, and the rows that would break it with their opponent."""
    marked = mark_doi_conflicts(docs, order, doi, hot_rows)
    accepted = marked.where(F.col("conflicts_with").isNull()).drop("conflicts_with")
    return accepted, marked.where(F.col("conflicts_with").isNotNull())


def orphans(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key has no parent; a null key refers to nothing and is no orphan.

    An anti join would send all rows of one parent to one task.
    """
    known = parents.select(F.col(parent_key).alias(key)).distinct()
    looked_up = spread_left_join(
        rows.where(F.col(key).isNotNull()),
        known.withColumn("_known", F.lit(True)),
        key,
        F.xxhash64(*rows.columns),
    )
    return looked_up.where(F.col("_known").isNull()).select(*rows.columns)


def without_output(inputs: DataFrame, done: DataFrame, key: str = "document_id") -> DataFrame:
    """Rows still to do after an interrupted run."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")
