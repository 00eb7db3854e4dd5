"""N-gram Jaccard join of documents with PartEnum signatures.

A document is its set of word shingles. Sets that are similar enough lie in one band of sizes,
and there their difference holds at most k shingles. The shingle domain is cut into parts by
hash, and the parts into three thirds: of (k + 1) / 2 parts one holds at most one difference, so two
of its thirds are equal. One signature per part and left-out third therefore meets every similar
pair; what meets is verified exactly.

Every step is on distinct sets. Sets that meet are first compared by parity sketches, which
never call a similar pair too far apart; a bucket is compared inside a task, in tiles if it is
large, and only what passes is written down. First every set looks for its nearest smaller
neighbour in a few of its buckets, and what is verified is united. Then all buckets that still
hold several components give their passing pairs across components, and these are verified.
So no link between different texts is lost, and groups of near copies are not spelled out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.arrow import pieces
from paperloom.llm.shared import components
from paperloom.llm.words import NOT_BLANK, word_hash, word_hashes, words_of
from paperloom.session import written

BAND = 1.35  # largest size of a band over its smallest
THIRDS = 3
MANY_PARTS = 48
SKETCH_CELLS = 2  # least number of cells per shingle
TILE_ROWS = 1_024
WORDS_AT_ONCE = 1 << 20  # 64-bit words of sketches compared at once
SMALL_BUCKET = 16  # sets of the largest bucket that is compared together with others
FIRST_BUCKETS = 4  # buckets in which a set looks for its nearest neighbour
M1, M2, M3 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9  # odd multipliers


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit integers."""
    y = x >> np.uint64(32)
    y ^= x
    y *= np.uint64(M1)
    y ^= y >> np.uint64(29)
    y *= np.uint64(M2)
    y ^= y >> np.uint64(32)
    return y


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; ``x`` gets sorted."""
    x.sort()
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def run_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, from those of the words."""
    total = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        total = mixed(total * np.uint64(M3) + h[i : len(h) - size + 1 + i])
    return total


def shingle_set(text: str | None, width: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``width`` words; ``known`` keeps hashes of words.

    Words are what white space (space, 0x09-0x0D) separates, A-Z lower-cased. Fewer words
    than ``width`` are one shingle; no words or null give an empty set.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = [known.get(w) or known.setdefault(w, word_hash(w)) for w in words]
    return distinct(run_hashes(np.array(hashes, dtype=np.uint64), min(width, len(hashes))))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """``shingle_set`` of every text of a piece at once."""
    words = words_of(texts, NOT_BLANK)
    h = word_hashes(words)
    runs = run_hashes(h, width) if len(h) >= width else None
    ends = np.cumsum(words.per_text)
    found = []
    for start, end in zip((ends - words.per_text).tolist(), ends.tolist()):
        if end - start >= width:
            found.append(distinct(runs[start : end - width + 1]))
        elif end > start:
            found.append(run_hashes(h[start:end], end - start))
        else:
            found.append(np.empty(0, np.uint64))
    return found


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least num / den."""

    num: int
    den: int

    def holds(self, common: int, a: int, b: int) -> bool:
        return self.den * common >= self.num * (a + b - common)

    def difference(self, a: int, b: int) -> int:
        """Most shingles that similar sets of sizes up to a and b have apart."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def smallest(self, a: int) -> int:
        """Least size of a set that is similar to one of size a."""
        return -(-self.num * a // self.den)

    def bands(self, size: int) -> list[tuple[int, int]]:
        """(band, largest size) of the bands where a set of this size meets similar ones.

        Band i holds the sizes of its own interval and the smaller sizes that are similar to
        one of them, so two similar sets meet in the band of the larger.
        """
        found = []
        band, top = 0, 1
        while True:
            low = top + 1 if band else 1
            if band:
                top = max(low, int(low * BAND))
            if size <= top and size >= self.smallest(low):
                found.append((band, top))
            if self.smallest(low) > size:
                return found
            band += 1


def signatures(elements: np.ndarray, similarity: Similarity) -> np.ndarray:
    """All signatures of one set, of every band it belongs to."""
    out = []
    for band, top in similarity.bands(len(elements)):
        k = similarity.difference(top, top)
        if k == 0:
            continue  # only equal sets, and these are one node
        parts = (k + 2) // 2
        # A signature of no shingle would meet too much. Two sets that meet only there do so
        # in a second partition too, which only sets with such a signature add. With many
        # parts it is left out: even of the most different pair two fifths of the parts are
        # expected to hold at most one difference, and that all of these lack shingles has a
        # probability below 1e-10 for every pair, like a clash of hashes.
        bare = []
        for salt in range(2):
            found, n = subsets(*part_sums(elements, parts, salt), band, salt)
            out.append(found[n > 0])
            if parts >= MANY_PARTS:
                break
            bare.append(np.flatnonzero(n == 0).astype(np.uint64))
            if not len(bare[-1]):
                break
        else:
            # Nor there: they share a place without shingles in either partition.
            first = mixed(bare[0] + np.uint64((band << 33) + (2 << 32)))
            out.append(mixed(first[:, None] ^ (bare[1] * np.uint64(M2))[None, :]).reshape(-1))
    return distinct(np.concatenate(out)) if out else np.empty(0, np.uint64)


def part_sums(elements: np.ndarray, parts: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of hashes and number of shingles per part and third."""
    place = mixed(elements + np.uint64(M3 * (2 * salt + 1) % (1 << 64)))
    cell = (place % np.uint64(parts * THIRDS)).astype(np.int64)
    sums = np.zeros(parts * THIRDS, dtype=np.uint64)
    np.add.at(sums, cell, mixed(place))
    counts = np.bincount(cell, minlength=parts * THIRDS)
    return sums.reshape(parts, THIRDS), counts.reshape(parts, THIRDS)


def subsets(
    sums: np.ndarray, counts: np.ndarray, band: int, salt: int
) -> tuple[np.ndarray, np.ndarray]:
    """One signature per part and third that is left out, and the number of its shingles."""
    rest = sums.sum(axis=1, keepdims=True, dtype=np.uint64) - sums
    n = counts.sum(axis=1, keepdims=True) - counts
    number = np.arange(rest.size, dtype=np.uint64) + np.uint64((band << 33) + (salt << 32))
    return mixed(rest.reshape(-1) + mixed(number + np.uint64(1))), n.reshape(-1)


def fingerprint(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


def sketch(elements: np.ndarray) -> bytes:
    """Parity of the number of shingles in each of a power of two of cells, one bit a cell.

    A shingle that only one of two sets has flips one bit, so sketches differ in no more bits
    than the sets in shingles. Folding a sketch in half by exclusive or gives that of half as
    many cells.
    """
    cells = 64
    while cells < SKETCH_CELLS * len(elements):
        cells *= 2
    at = mixed(elements ^ np.uint64(M2)) & np.uint64(cells - 1)
    odd = np.bincount(at.astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def short(fingerprint: bytes) -> int:
    return int.from_bytes(fingerprint[8:], "big", signed=True)


SETS = (
    "doc_id bigint, text_hash bigint, n_shingles bigint, fingerprint binary, print bigint, "
    "sketch binary"
)


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
    )


def document_sets(texts: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, fingerprint, print, sketch) of every document's set.

    ``fingerprint`` has 128 bits and tells sets apart; ``print`` is its lower half.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = shingle_sets(piece.column("text"), width)
                prints = [fingerprint(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("text_hash"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(prints, pa.binary()),
                        pa.array([short(p) for p in prints], pa.int64()),
                        pa.array([sketch(s) for s in sets], pa.binary()),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "fingerprint", "print", "sketch"],
                )

    return written(texts.mapInArrow(run, SETS), "sets")


def signature_rows(texts: DataFrame, width: int, similarity: Similarity) -> DataFrame:
    """(signature, print) of every set; a task gives the rows of equal sets once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in pieces(batch, "text"):
                found, prints = [], []
                for elements in shingle_sets(piece.column("text"), width):
                    own = short(fingerprint(elements))
                    if len(elements) and own not in seen:
                        seen.add(own)
                        found.append(signatures(elements, similarity))
                        prints.append(own)
                if len(seen) > KNOWN_SETS:
                    seen = set()
                if found:
                    owner = np.repeat(np.array(prints, dtype=np.int64), [len(f) for f in found])
                    flat = np.concatenate(found).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(flat), pa.array(owner)], ["signature", "print"]
                    )

    return texts.select("text").mapInArrow(run, "signature bigint, print bigint")


KNOWN_SETS = 1_000_000  # sets a task remembers to have given the rows of


def join_documents(
    docs: DataFrame,
    similarity: tuple[int, int] = (4, 5),
    width: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles, component_id.

    Documents link if intersection over union of their shingle sets is at least the ratio of
    the two numbers of ``similarity``. ``component_id`` is the smallest doc_id reachable by
    links, the document itself included. Null texts and texts without words have an empty
    set, link with nothing and keep their own id. Rows that repeat a doc_id are one node of
    the graph if their sets are equal, and otherwise linked through their common id. Null
    ids are left out of the graph and get a null component.
    """
    least = Similarity(*similarity)
    texts = keyed_texts(docs, id_col, text_col)
    sets = document_sets(texts, width)
    full = sets.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    # Equal sets are one node: the smallest document id stands for all.
    nodes = written(
        full.groupBy("fingerprint", "print")
        .agg(
            F.min(F.struct("doc_id", "text_hash")).alias("first"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
        )
        .select(
            "fingerprint",
            "print",
            F.col("first.doc_id").alias("node"),
            F.col("first.text_hash").alias("text_hash"),
            "n_shingles",
            "sketch",
        ),
        "nodes",
    )
    met = _meetings(signature_rows(texts, width, least))
    candidates = _candidate_sets(met.select("print").distinct(), nodes, texts, width)
    nearest = _nearest(met, nodes, least)
    linked = written(_verified(nearest, nodes, candidates, least), "linked")
    # Once more for what is still apart, then all that is left.
    apart = _apart(met, _labels(nodes, linked), least, nearest=True)
    second = written(_verified(apart, nodes, candidates, least), "linked")
    linked = linked.unionByName(second)
    rest = _apart(met, _labels(nodes, linked), least, nearest=False)
    more = _verified(rest, nodes, candidates, least)
    same_id = _repeated_ids(full, nodes)
    united = components(linked.unionByName(more).unionByName(same_id))
    of_set = nodes.join(united, "node", "left").select(
        "fingerprint", F.coalesce("component", "node").alias("component_id")
    )
    return sets.select("doc_id", "text_hash", "n_shingles", "fingerprint").join(
        of_set, "fingerprint", "left"
    ).select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )


def _meetings(rows: DataFrame) -> DataFrame:
    """Rows (signature, print) of buckets with two sets or more, each once.

    Several tasks may give the same row. Of these the last one stays, since only that one has the
    next set of the bucket after it.
    """
    bucket = Window.partitionBy("signature").orderBy("print")
    met = rows.select(
        "*",
        F.first("print").over(bucket).alias("least"),
        F.lead("print").over(bucket).alias("after"),
    )
    again = F.col("after").eqNullSafe(F.col("print"))
    other = (F.col("least") != F.col("print")) | F.col("after").isNotNull()
    return written(met.where(other & ~again).select("signature", "print"), "meetings")


def _ring(rows: DataFrame) -> DataFrame:
    """Rows of buckets dealt into tiles; every tile meets itself and the next one, in a ring.

    For a search of near neighbours: sets that are all alike meet one another over the ring, and
    a row has three copies at most, however large its bucket is.
    """
    n = F.count("*").over(Window.partitionBy("signature"))
    counted = rows.withColumn("n_tiles", F.ceil(n / TILE_ROWS).cast("int"))
    dealt = counted.withColumn("own", F.pmod(F.xxhash64("print"), F.col("n_tiles")).cast("int"))
    others = [F.pmod(F.col("own") + step, F.col("n_tiles")) for step in (-1, 0, 1)]
    met = dealt.withColumn("other", F.explode(F.array_distinct(F.array(*others))))
    return _with_pair(met, rows.columns)


def _tiles(rows: DataFrame) -> DataFrame:
    """Rows (with n, n_main, main) of buckets dealt into tiles, so that all pairs of different
    components meet once.

    The tiles of the largest component ``main`` of a bucket come last and need not meet each
    other. So where nearly all of a bucket is one component, its rows have few copies.
    """
    rest = F.ceil((F.col("n") - F.col("n_main")) / TILE_ROWS).cast("int")
    of_main = F.ceil(F.col("n_main") / TILE_ROWS).cast("int")
    sized = rows.withColumn("rest", rest).withColumn("of_main", of_main)
    place = F.xxhash64("print")
    in_main = F.col("component") == F.col("main")
    own = F.when(in_main, F.col("rest") + F.pmod(place, F.col("of_main"))).otherwise(
        F.pmod(place, F.col("rest"))
    )
    last = F.col("rest") - 1 + F.when(in_main, 0).otherwise(F.col("of_main"))
    met = sized.withColumn("own", own.cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), last))
    )
    return _with_pair(met, [c for c in rows.columns if c not in ("n", "n_main", "main")])


def _with_pair(met: DataFrame, columns: list[str]) -> DataFrame:
    """With the pair of tiles (i, j), i <= j, that a copy of a row is compared in."""
    return met.select(
        *columns, "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )


PAIRS = "a bigint, b bigint, distance int"


def _nearest(met: DataFrame, nodes: DataFrame, least: Similarity) -> DataFrame:
    """For every set the nearest smaller one that may be similar, in a few of its buckets:
    prints (a, b). Sets that are alike share most buckets, so few of them are enough here."""
    order = Window.partitionBy("print").orderBy("signature")
    few = met.withColumn("n", F.row_number().over(order)).where(F.col("n") <= FIRST_BUCKETS)
    rows = few.select("signature", "print").join(
        nodes.select("print", "n_shingles", "sketch"), "print"
    )

    def nearest(table: pa.Table) -> pa.Table:
        return compare_tile(table, least, across=False, nearest=True)

    found = _ring(rows).groupBy("signature", "i", "j").applyInArrow(nearest, PAIRS)
    return _best(found)


def _best(found: DataFrame) -> DataFrame:
    """For every a the b with the smallest distance."""
    best = found.groupBy("a").agg(F.min(F.struct("distance", "b")).alias("best"))
    return best.select("a", F.col("best.b").alias("b"))


def _labels(nodes: DataFrame, linked: DataFrame) -> DataFrame:
    """Every set with its size, sketch and component under the links found so far."""
    return nodes.join(components(linked), "node", "left").select(
        "print", "n_shingles", "sketch", F.coalesce("component", "node").alias("component")
    )


def _apart(met: DataFrame, united: DataFrame, least: Similarity, nearest: bool) -> DataFrame:
    """Pairs of prints (a, b) that meet, may be similar, and lie in different components.

    All of them, or with ``nearest`` only the nearest b of every a in the larger buckets.
    """
    labelled = written(
        met.join(united.select("print", "component"), "print"), "labelled"
    )
    per_component = labelled.groupBy("signature", "component").agg(F.count("*").alias("of"))
    several = (
        per_component.groupBy("signature")
        .agg(
            F.sum("of").alias("n"),
            F.max("of").alias("n_main"),
            F.max_by("component", F.struct("of", "component")).alias("main"),
        )
        .where("n_main < n")
    )
    rows = written(labelled.join(several, "signature"), "open-buckets")
    known = united.select("print", "n_shingles", "sketch")

    def across(table: pa.Table) -> pa.Table:
        return compare_tile(table, least, across=True, nearest=nearest)

    sketched = rows.join(known, "print")
    large = sketched.where(F.col("n") > SMALL_BUCKET)
    if nearest:
        around = _ring(large.drop("n", "n_main", "main"))
        return _best(around.groupBy("signature", "i", "j").applyInArrow(across, PAIRS))
    found = _tiles(large).groupBy("signature", "i", "j").applyInArrow(across, PAIRS)

    def small(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_buckets(batches):
            yield compare_small(whole, least)

    # A small bucket is a few rows, so no task gets much of one key.
    dealt = sketched.where(F.col("n") <= SMALL_BUCKET).drop("n_main", "main").repartition("signature")
    of_small = dealt.sortWithinPartitions("signature").mapInArrow(small, "a bigint, b bigint")
    return of_small.unionByName(found.select("a", "b")).distinct()


def whole_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by signature in pieces that hold every bucket whole."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        signature = batch.column("signature").to_numpy()
        if not len(signature):
            continue
        last = int(np.searchsorted(signature, signature[-1]))  # the last bucket may go on
        if last or (held and held[-1].column("signature")[-1].as_py() != signature[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def compare_small(table: pa.Table, least: Similarity) -> pa.RecordBatch:
    """Distinct pairs (a, b), a > b, of one bucket and different components that may be similar.

    Row by row with the next row, then with the one after it, and so on to the end of the
    largest bucket, for all buckets of the piece at once.
    """
    table = table.combine_chunks()
    signature, prints, sizes, component = (
        table[c].to_numpy() for c in ("signature", "print", "n_shingles", "component")
    )
    sketches = table["sketch"].combine_chunks()
    words = np.frombuffer(sketches.buffers()[2] or b"", dtype="<u8")
    starts = _offsets(sketches)
    found = [np.empty((2, 0), dtype=np.int64)]
    for step in range(1, SMALL_BUCKET):
        left = np.flatnonzero(signature[step:] == signature[:-step])
        if not len(left):
            break
        right = left + step
        x, y = sizes[left], sizes[right]
        may = component[left] != component[right]
        may &= least.den * np.minimum(x, y) >= least.num * np.maximum(x, y)
        left, right = left[may], right[may]
        x, y = x[may], y[may]
        apart = sketch_distances(words, starts, left, right)
        near = apart <= (least.den - least.num) * (x + y) // (least.den + least.num)
        ends = np.stack([prints[left[near]], prints[right[near]]])
        found.append(np.stack([ends.max(axis=0), ends.min(axis=0)]))
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def _offsets(values: pa.Array) -> np.ndarray:
    """Where every sketch begins, in words of 64 bits, and where the last one ends."""
    kind = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    found = np.frombuffer(values.buffers()[1], dtype=kind)
    return found[values.offset : values.offset + len(values) + 1] // 8


def sketch_distances(
    words: np.ndarray, starts: np.ndarray, left: np.ndarray, right: np.ndarray
) -> np.ndarray:
    """Bits in which the sketches of the rows differ, the larger one folded to the smaller."""
    out = np.zeros(len(left), dtype=np.int64)
    widths = np.diff(starts)
    both = np.stack([widths[left], widths[right]])
    for pair in np.unique(both, axis=1).T if len(left) else []:
        rows = np.flatnonzero((both == pair[:, None]).all(axis=0))
        width = int(pair.min())
        step = max(1, WORDS_AT_ONCE // int(pair.max()))
        for start in range(0, len(rows), step):
            part = rows[start : start + step]
            folded = [
                np.bitwise_xor.reduce(
                    words[starts[side[part]][:, None] + np.arange(n)].reshape(len(part), -1, width),
                    axis=1,
                )
                for side, n in ((left, pair[0]), (right, pair[1]))
            ]
            out[part] = np.bitwise_count(folded[0] ^ folded[1]).sum(axis=1, dtype=np.int64)
    return out


def compare_tile(table: pa.Table, least: Similarity, across: bool, nearest: bool) -> pa.Table:
    """Pairs (a, b, distance), a > b, of tiles i and j whose sketches may be similar.

    With ``across`` only those of different components, with ``nearest`` one b for every a.
    """
    table = table.combine_chunks()
    prints = table["print"].to_numpy()
    sizes = table["n_shingles"].to_numpy()
    component = table["component"].to_numpy() if across else prints
    own = table["own"].to_numpy()
    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    words = [np.frombuffer(s, dtype="<u8") for s in table["sketch"].to_pylist()]
    width = min(map(len, words))
    folded = np.array([np.bitwise_xor.reduce(w.reshape(-1, width), axis=0) for w in words])
    left = np.flatnonzero(own == i)
    right = left if i == j else np.flatnonzero(own == j)
    found = []
    step = max(1, WORDS_AT_ONCE // max(1, width * len(right)))
    for start in range(0, len(left), step):
        part = left[start : start + step]
        apart = folded[part][:, None, :] ^ folded[right][None, :, :]
        distance = np.bitwise_count(apart).sum(axis=2, dtype=np.int64)
        x, y = sizes[part][:, None], sizes[right][None, :]
        may = distance <= (least.den - least.num) * (x + y) // (least.den + least.num)
        may &= least.den * np.minimum(x, y) >= least.num * np.maximum(x, y)
        may &= component[part][:, None] != component[right][None, :]
        if i == j:
            may &= prints[part][:, None] > prints[right][None, :]
        at, to = np.nonzero(may)
        d = distance[at, to]
        at, to = part[at], right[to]
        swap = prints[at] < prints[to]
        at, to = np.where(swap, to, at), np.where(swap, at, to)
        found.append(_closest(at, to, d) if nearest else (at, to, d))
    at, to, d = (np.concatenate(c) for c in zip(*found)) if found else [np.empty(0, np.int64)] * 3
    if nearest:
        at, to, d = _closest(at, to, d)
    return pa.table(
        {
            "a": pa.array(prints[at], pa.int64()),
            "b": pa.array(prints[to], pa.int64()),
            "distance": pa.array(d.astype(np.int32)),
        }
    )


def _closest(at: np.ndarray, to: np.ndarray, d: np.ndarray) -> tuple:
    """Of the pairs of each row ``at`` the one with the smallest distance."""
    order = np.lexsort((d, at))
    at, to, d = at[order], to[order], d[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, np.int64)
    return at[first], to[first], d[first]


def _candidate_sets(
    prints: DataFrame, nodes: DataFrame, texts: DataFrame, width: int
) -> DataFrame:
    """(node, elements) of the nodes that meet another, written once for all comparisons."""
    keys = prints.join(nodes, "print").select(F.col("node").alias("doc_id"), "text_hash")
    found = texts.join(keys, ["doc_id", "text_hash"], "left_semi")
    once = found.dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = shingle_sets(piece.column("text"), width)
                elements = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), elements], ["node", "elements"]
                )

    return written(once.mapInArrow(run, "node bigint, elements binary"), "candidates")


def _verified(
    pairs: DataFrame, nodes: DataFrame, candidates: DataFrame, least: Similarity
) -> DataFrame:
    """The pairs of nodes (a, b) behind pairs of prints whose sets are similar, compared exactly."""
    of_a = nodes.select(F.col("print").alias("a"), F.col("node").alias("node_a"))
    of_b = nodes.select(F.col("print").alias("b"), F.col("node").alias("node_b"))
    named = pairs.join(of_a, "a").join(of_b, "b").select("node_a", "node_b")
    set_a = candidates.select(F.col("node").alias("node_a"), F.col("elements").alias("set_a"))
    set_b = candidates.select(F.col("node").alias("node_b"), F.col("elements").alias("set_b"))
    both = (
        named.join(set_a, "node_a")
        .join(set_b, "node_b")
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "set_a", "set_b")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(least.holds(common, len(x), len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def _repeated_ids(full: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the nodes of different texts that share one doc_id."""
    sets_of = full.select("doc_id", "fingerprint").distinct()
    several = (
        sets_of.groupBy("doc_id").agg(F.count("*").alias("sets")).where("sets > 1").select("doc_id")
    )
    ends = sets_of.join(several, "doc_id").join(nodes, "fingerprint").select("doc_id", "node")
    return ends.select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
