"""Ranked lexical search over an index stratified by document length.

The score of a term in a document depends on its frequency and on the document's normaliser m
alone. Documents of one m are a stratum; a row of the index is a chunk of a stratum, with the
postings of every term in ascending order of frequency. So the impact of a frequency is computed
once for each run of postings, and the highest frequency of every term bounds what any document
of the chunk can score. A search visits the chunks from the highest bound down, and only for the
items whose bound reaches the worst of their best documents so far.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, StringType, StructField, StructType

from paperloom.llm.arrow import pieces, spans
from paperloom.llm.words import words_of
from paperloom.session import written

BASE, SLOPE = 50, 50  # m = BASE + SLOPE * length / mean length
SATURATION = 20  # weight of m against 1000 * frequency
CHUNK_DOCS = 8_192
CHUNK_POSTINGS = 1 << 18
KNOWN_TERMS = 200_000  # an index for more terms than this holds all terms
BLOCK_PAIRS = 200_000  # pairs of item and term that are searched for at once
POSTINGS_AT_ONCE = 1 << 20
CELLS_AT_ONCE = 1 << 21


@dataclass(frozen=True)
class Index:
    """Chunks (m, docs, terms, counts, tfs, places), documents with a term, and all their terms."""

    chunks: DataFrame
    n_docs: int
    n_terms: int


def term_counts(
    docs: DataFrame, id_col: str, text_col: str, known: pa.Array | None
) -> DataFrame:
    """Rows (id, n, terms, tfs) of whole texts: number of terms, and how often each occurs.

    With ``known`` only the frequencies of these terms; n counts all. Terms come in no order.
    """
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(known)
    fields = [
        keyed.schema["id"],
        StructField("n", LongType()),
        StructField("terms", ArrayType(StringType())),
        StructField("tfs", ArrayType(IntegerType())),
    ]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = words_of(piece.column("text"))
                encoded = words.array().dictionary_encode()
                terms, codes = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
                text_of = words.text_of()
                if sent.value is not None:
                    wanted = pc.is_in(terms, sent.value).to_numpy(zero_copy_only=False)[codes]
                    codes, text_of = codes[wanted], text_of[wanted]
                size = max(1, len(terms))
                found, tfs = np.unique(text_of * size + codes, return_counts=True)
                per_text = np.bincount(found // size, minlength=piece.num_rows)
                offsets = pa.array(np.append(0, np.cumsum(per_text)).astype(np.int32))
                values = terms.take(pa.array(found % size)).cast(pa.string())
                columns = [
                    piece.column("id"),
                    pa.array(words.per_text.astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, values),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs.astype(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return keyed.mapInArrow(run, StructType(fields))


def build_index(
    docs: DataFrame,
    terms: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Index:
    """Index of all documents with a term, as a written table.

    ``terms`` (one column) names all terms that will be searched for; the index then holds their
    postings only, unless they are more than ``KNOWN_TERMS``. Null texts have no term. Repeated
    rows are documents of their own. Strata are sorted by range, and hashes of the row split
    those that hold much.
    """
    known = None
    if terms is not None:
        some = terms.distinct().limit(KNOWN_TERMS + 1).toArrow()
        if some.num_rows <= KNOWN_TERMS:
            known = some.column(0).combine_chunks().cast(pa.large_string())
    forward = written(term_counts(docs, id_col, text_col, known), "term-counts")
    n_docs, n_terms = forward.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        n_terms = 1
    m = F.expr(f"{BASE} + cast({SLOPE} * cast(n as decimal(19)) * {n_docs} div {n_terms} as bigint)")
    placed = (
        forward.where("n > 0")
        .withColumn("m", m)
        .withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
        .repartitionByRange("m", "salt")
        .sortWithinPartitions("m", F.col("id").asc_nulls_last())
        .select("m", "id", "terms", "tfs")
    )
    schema = StructType(
        [
            StructField("m", LongType()),
            StructField("docs", ArrayType(placed.schema["id"].dataType)),
            StructField("terms", ArrayType(StringType())),
            *[StructField(c, ArrayType(IntegerType())) for c in ("counts", "tfs", "places")],
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for part in same_stratum(batch):
                n = sum(p.num_rows for p in held) + part.num_rows
                n_postings = sum(postings_in(p) for p in [*held, part])
                other = held and held[0].column("m")[0] != part.column("m")[0]
                if other or n > CHUNK_DOCS or n_postings > CHUNK_POSTINGS:
                    if held:
                        yield chunk(held)
                    held = []
                held.append(part)
        if held:
            yield chunk(held)

    chunks = written(placed.mapInArrow(run, schema), "lexical-index")
    return Index(chunks, n_docs, n_terms)


def postings_in(rows: pa.RecordBatch) -> int:
    lists = rows.column("tfs")
    return lists.offsets[len(lists)].as_py() - lists.offsets[0].as_py()


def same_stratum(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices with one m each, of a bounded number of rows and of postings unless it is one row."""
    m = batch.column("m").to_numpy()
    ends = batch.column("tfs").offsets.to_numpy()
    start = 0
    while start < len(m):
        end = start + int(np.searchsorted(m[start:], m[start], side="right"))
        most = int(np.searchsorted(ends, ends[start] + CHUNK_POSTINGS, side="right")) - 1
        end = min(end, start + CHUNK_DOCS, max(start + 1, most))
        yield batch.slice(start, end - start)
        start = end


def chunk(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row of the index: postings by term, and of a term by frequency."""
    rows = pa.Table.from_batches(parts).combine_chunks()
    tfs, terms = (rows.column(c).combine_chunks() for c in ("tfs", "terms"))
    per_doc = np.diff(tfs.offsets.to_numpy())
    encoded = terms.flatten().dictionary_encode()
    code, tf = encoded.indices.to_numpy(), tfs.flatten().to_numpy()
    place = np.repeat(np.arange(rows.num_rows, dtype=np.int32), per_doc)
    order = np.lexsort((place, tf, code))
    counts = np.bincount(code, minlength=len(encoded.dictionary)).astype(np.int32)

    def single(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    columns = [
        rows.column("m").combine_chunks()[:1],
        single(rows.column("id").combine_chunks()),
        single(encoded.dictionary),
        *[single(pa.array(x)) for x in (counts, tf[order], place[order])],
    ]
    return pa.RecordBatch.from_arrays(columns, ["m", "docs", "terms", "counts", "tfs", "places"])


# --- search ----------------------------------------------------------------------------


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + SATURATION * m)


@dataclass(frozen=True)
class Block:
    """Items with their terms: pairs in order of item, into arrays of terms and their weights."""

    items: pa.Array
    terms: pa.Array
    weight: np.ndarray
    starts: np.ndarray  # of each item's pairs, one more than there are items
    pair_term: np.ndarray

    @staticmethod
    def of(pairs: pa.Table) -> Block:
        pairs = pairs.combine_chunks().sort_by("number")
        number, term = (pairs.column(c).combine_chunks() for c in ("number", "term"))
        _, first = np.unique(number.to_numpy(), return_index=True)
        encoded = term.dictionary_encode()
        codes = encoded.indices.to_numpy()
        weight = np.zeros(len(encoded.dictionary), dtype=np.int64)
        weight[codes] = pairs.column("weight").to_numpy()
        items = pairs.column("item").combine_chunks().take(pa.array(first))
        return Block(items, encoded.dictionary, weight, np.append(first, len(codes)), codes)


class Best:
    """The best documents of every item so far."""

    def __init__(self, block: Block, k: int) -> None:
        self.k = k
        self.bar = np.ones(len(block.items), dtype=np.int64)  # least score that still counts
        self.held: list[pa.Table] = []
        self.n = 0

    def add(self, item: np.ndarray, score: np.ndarray, docs: pa.Array) -> None:
        self.held.append(pa.table({"item": item, "score": score, "doc": docs}))
        self.n += len(item)
        if self.n > 4 * self.k * len(self.bar):
            self.settle()

    def settle(self) -> pa.Table | None:
        if not self.held:
            return None
        found = pa.concat_tables(self.held).combine_chunks()
        order = pc.sort_indices(
            found, [("item", "ascending"), ("score", "descending"), ("doc", "ascending")]
        )
        found = found.take(order).combine_chunks()
        item = found.column("item").to_numpy()
        first = np.searchsorted(item, item)
        rank = np.arange(len(item)) - first
        found = found.filter(pa.array(rank < self.k))
        full = rank == self.k - 1
        self.bar[item[full]] = found.column("score").to_numpy()[
            np.flatnonzero((rank[rank < self.k]) == self.k - 1)
        ]
        self.held, self.n = [found], found.num_rows
        return found


def visit(row: dict, block: Block, bounds: np.ndarray, best: Best) -> None:
    """Score the documents of one chunk for the items whose bound reaches their bar."""
    active = np.flatnonzero((bounds >= best.bar) & (bounds > 0))
    if not len(active):
        return
    docs, tfs, places, ends = row["docs"], row["tfs"], row["places"], row["ends"]
    n = len(docs)
    # Impacts once for every run of equal frequencies.
    run = np.flatnonzero(np.append(True, tfs[1:] != tfs[:-1]))
    impact = np.repeat(impacts(tfs[run], row["m"]), np.diff(np.append(run, len(tfs))))
    term = block.pair_term
    at = row["at"][term]  # place of the pair's term in the chunk, -1 for none
    sizes = np.where(at >= 0, row["counts"][at], 0)
    work = np.add.reduceat(sizes, block.starts[:-1])[active]
    groups = np.cumsum(np.maximum(work, 1)) // POSTINGS_AT_ONCE
    groups = np.maximum(groups, np.arange(len(active)) // max(1, CELLS_AT_ONCE // n))
    for start in np.flatnonzero(np.append(True, groups[1:] != groups[:-1])):
        group = active[start:][groups[start:] == groups[start]]
        pairs = spans(block.starts[group], block.starts[group + 1] - block.starts[group])
        owner = np.repeat(np.arange(len(group)), block.starts[group + 1] - block.starts[group])
        met = sizes[pairs] > 0
        pairs, owner = pairs[met], owner[met]
        posting = spans(ends[at[pairs]] - sizes[pairs], sizes[pairs])
        gain = np.repeat(block.weight[term[pairs]], sizes[pairs]) * impact[posting]
        score = np.zeros(len(group) * n, dtype=np.int64)
        np.add.at(score, np.repeat(owner * n, sizes[pairs]) + places[posting], gain)
        score = score.reshape(len(group), n)
        kept, of = [], []
        for i, item in enumerate(group):
            good = np.flatnonzero(score[i] >= best.bar[item])
            if len(good) > best.k:  # documents are in order of id, so ties keep that order
                good = good[np.argsort(-score[i][good], kind="stable")[: best.k]]
            kept.append(good)
            of.append(np.full(len(good), i))
        doc, own = np.concatenate(kept), np.concatenate(of)
        best.add(group[own], score[own, doc], docs.take(pa.array(doc)))


def read_chunks(batch: pa.RecordBatch, block: Block) -> Iterator[tuple[dict, np.ndarray]]:
    """Chunks with the bounds of every item, from the highest bound down."""
    found = []
    for i in range(batch.num_rows):
        row = {c: batch.column(c)[i].values for c in ("docs", "terms", "counts", "tfs", "places")}
        for c in ("counts", "tfs", "places"):
            row[c] = row[c].to_numpy()
        if not len(row["tfs"]):
            continue
        row["m"] = batch.column("m")[i].as_py()
        row["ends"] = np.cumsum(row["counts"], dtype=np.int64)
        at = pc.index_in(block.terms, value_set=row["terms"])
        row["at"] = pc.fill_null(at, -1).to_numpy()
        most = np.where(row["at"] >= 0, impacts(row["tfs"][row["ends"] - 1], row["m"])[row["at"]], 0)
        bounds = np.add.reduceat((block.weight * most)[block.pair_term], block.starts[:-1])
        found.append((row, bounds))
    found.sort(key=lambda x: -int(x[1].max()))
    yield from found


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item, term); rows that repeat an id are one item with the terms of all."""
    rows = term_counts(items, id_col, text_col, None)
    return rows.select(F.col("id").alias("item"), F.explode("terms").alias("term")).distinct()


def search(index: Index, pairs: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` best documents (item_id, rank, doc_id, score) of every item of ``pairs``.

    ``pairs`` are distinct (item, term), see ``item_terms``; items of any number are searched for
    in blocks, each of which is sent to all tasks. Only scores above 0 count; ties go to the
    smaller document id, null ids last. An item without terms, or without a document that has
    one of them, gives no row.
    """
    spark = pairs.sparkSession
    df = (
        index.chunks.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
        .select("x.terms", "x.counts")
        .join(pairs.select(F.col("term").alias("terms")).distinct(), "terms")
        .groupBy(F.col("terms").alias("term"))
        .agg(F.sum("counts").alias("df"))
    )
    weight = F.expr(f"cast(floor(1000 * ln((2D * {index.n_docs} + 2) / (2D * df + 1))) as bigint)")
    weighed = written(pairs.join(df, "term").select("item", "term", weight.alias("weight")), "pairs")
    n_blocks = -(-weighed.count() // BLOCK_PAIRS)
    number = F.xxhash64("item")
    found = [
        _search_block(index, weighed.where(F.pmod(number, F.lit(n_blocks)) == b), number, k)
        for b in range(n_blocks)
    ]
    id_type = index.chunks.schema["docs"].dataType.elementType
    if not found:
        schema = _result_schema(pairs.schema["item"].dataType, id_type)
        empty = spark.createDataFrame([], schema)
        return empty.select("item_id", F.lit(0).alias("rank"), "doc_id", "score")
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _result_schema(item: DataType, doc: DataType) -> StructType:
    return StructType(
        [StructField("item_id", item), StructField("doc_id", doc), StructField("score", LongType())]
    )


def _search_block(index: Index, pairs: DataFrame, number, k: int) -> DataFrame:
    # About BLOCK_PAIRS rows.
    rows = pairs.select(number.alias("number"), "item", "term", "weight").toArrow()
    schema = _result_schema(
        pairs.schema["item"].dataType, index.chunks.schema["docs"].dataType.elementType
    )
    sent = pairs.sparkSession.sparkContext.broadcast(Block.of(rows) if rows.num_rows else None)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        if block is None:
            return
        best = Best(block, k)
        for batch in batches:
            for row, bounds in read_chunks(batch, block):
                visit(row, block, bounds, best)
        found = best.settle()
        if found is not None:
            columns = [block.items.take(found.column("item").combine_chunks())]
            columns += [found.column(c).combine_chunks() for c in ("doc", "score")]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return index.chunks.mapInArrow(run, schema)
