"""Near duplicates among embeddings by a random-projection tree forest.

Every tree splits the vectors again and again by random directions; vectors near a split go to
both sides. Vectors that share a leaf in one of the trees are compared, and what is similar is
linked and united. Leaves that stay large are compared tile by tile, so no task holds more
than two tiles. A pair that shares leaves of several trees counts in the first of them only.

The splits are fitted on a bounded sample; every vector is indexed, and every pair inside a
leaf is compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.shared import components
from paperloom.session import written

SAMPLE_NUMBERS = 4_000_000  # components of all sampled vectors together
SAMPLE_ROWS = 50_000
LEAF_ROWS = 512  # vectors a leaf should have
LEAF_SAMPLE = 8  # sampled vectors a node needs to be split
TILE_ROWS = 1_024
PAIRS_AT_ONCE = 1 << 16


@dataclass(frozen=True)
class Tree:
    """One direction per level, and the split point of every node of a level."""

    directions: np.ndarray  # (levels, dimensions)
    splits: list[np.ndarray]  # per level, one number per node


def valid(vectors: DataFrame, label: str, vec: str) -> DataFrame:
    """Rows that can link: label and vector not null, all components finite, not all zero."""
    x = F.transform(F.col(f"`{vec}`"), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(math.inf)))
    some = F.exists(x, lambda v: v != 0)
    return vectors.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{vec}`").isNotNull() & ~bad & some)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit vectors in double precision from a list column of one length."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if not len(lists):
        return np.empty((0, 1))
    rows = flat.reshape(len(lists), -1)
    # Scaling first keeps squares of very small or large components in range.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def fit_forest(
    sample: np.ndarray, dims: int, n_trees: int, levels: int, margin: float, seed: int
) -> list[Tree]:
    """Trees over unit vectors. A split lies where few sampled vectors are within ``margin``.

    Of the points between the quarters of a node's projections the emptiest is taken, so a
    cluster is not cut through. A node of few sampled vectors is not split (infinite split).
    """
    random = np.random.default_rng(seed)
    forest = []
    for _ in range(n_trees):
        directions = random.standard_normal((levels, dims))
        directions /= np.linalg.norm(directions, axis=1, keepdims=True)
        node = np.zeros(len(sample), dtype=np.int64)
        splits = []
        for level in range(levels):
            place = sample @ directions[level]
            at = np.full(1 << level, np.inf)
            order = np.lexsort((place, node))
            bounds = np.searchsorted(node[order], np.arange((1 << level) + 1))
            for n in range(1 << level):
                own = place[order[bounds[n] : bounds[n + 1]]]
                if len(own) < 2 * LEAF_SAMPLE:
                    continue
                middle = np.linspace(*np.quantile(own, [0.25, 0.75]), 33)
                near = np.searchsorted(own, middle + margin) - np.searchsorted(own, middle - margin)
                at[n] = middle[near == near.min()][(near == near.min()).sum() // 2]
            splits.append(at)
            node = 2 * node + (place > at[node])
        forest.append(Tree(directions, splits))
    return forest


def leaves(tree: Tree, rows: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of all rows; a row near a split goes on to both sides."""
    row = np.arange(len(rows))
    node = np.zeros(len(rows), dtype=np.int64)
    for direction, split in zip(tree.directions, tree.splits):
        gap = (rows @ direction)[row] - split[node]
        low, high = gap <= margin, gap > -margin
        row = np.concatenate([row[low], row[high]])
        node = np.concatenate([2 * node[low], 2 * node[high] + 1])
    return row, node


def link_vectors(
    vectors: DataFrame,
    min_cosine: float = 0.98,
    n_trees: int = 4,
    spill: float = 0.5,
    seed: int = 0,
    id_col: str = "vec_id",
    label_col: str = "label",
    vec_col: str = "embedding",
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Two vectors link if their labels are equal and not null and their cosine in double
    precision is at least ``min_cosine``; vectors of different length never link. ``n_links``
    counts the other rows linked directly, ``component_id`` is the smallest vec_id reachable,
    ``kept`` is true for it. Vectors that are null, zero, or hold null or non-finite
    components link with nothing. Rows that repeat a vec_id get one answer per id, and null
    ids link with nothing. ``spill`` is the margin of a split in units of the projected
    distance of two vectors at the threshold.
    """
    spark = vectors.sparkSession
    named = vectors.select(
        F.col(f"`{id_col}`").alias("vec_id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        F.col(f"`{vec_col}`").alias("vec"),
    )
    usable = valid(named, "label", "vec").where(F.col("vec_id").isNotNull())
    # Equal vectors of a label are one node with a weight: the smallest id stands for all.
    members = written(
        usable.select("vec_id", "label", "vec", F.size("vec").alias("dims")), "vectors"
    )
    node_of = written(
        members.groupBy("label", "vec").agg(
            F.min("vec_id").alias("node"),
            F.count("*").alias("weight"),
        ).withColumn("dims", F.size("vec")),
        "nodes",
    )
    sizes = node_of.groupBy("dims").agg(F.count("*").alias("n"), F.count_distinct("label").alias("l")).collect()
    found = [
        _compare(node_of.where(F.col("dims") == s["dims"]), s["dims"], s["n"], min_cosine, n_trees, spill, seed)
        for s in sizes
    ]
    if found:
        results = found[0]
        for other in found[1:]:
            results = results.unionByName(other)
        results = written(results, "links")
    else:
        results = spark.createDataFrame([], RESULT)
    counts = results.where("other is null").groupBy("node").agg(F.sum("n").alias("others"))
    united = components(
        results.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    )
    judged = (
        node_of.join(counts, "node", "left")
        .join(united, "node", "left")
        .select(
            "label",
            "vec",
            (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    # Back to all copies; a group of copies is as large as it is, so it joins by hash.
    linked = members.join(judged, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    once = linked.groupBy("vec_id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    return named.select("vec_id").join(once, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


RESULT = "node bigint, n bigint, other bigint"


def _compare(
    nodes: DataFrame, dims: int, n: int, min_cosine: float, n_trees: int, spill: float, seed: int
) -> DataFrame:
    """Links among nodes of one length: rows (node, n, null) with the weight of the partners,
    and rows (node, null, other) that connect what is linked inside a tile."""
    spark = nodes.sparkSession
    rows = min(SAMPLE_ROWS, max(1, SAMPLE_NUMBERS // max(1, dims)))
    share = min(1.0, rows / n)
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "node"), 33) / F.lit(float(1 << 31))
    sample = matrix(nodes.where(place <= share).select("vec").toArrow()["vec"])
    levels = max(0, math.ceil(math.log2(max(1, n / LEAF_ROWS))))
    levels = min(levels, max(0, int(math.log2(max(1, len(sample) / LEAF_SAMPLE)))))
    margin = spill * math.sqrt(max(0.0, 2 - 2 * min_cosine) / dims)
    forest = spark.sparkContext.broadcast(fit_forest(sample, dims, n_trees, levels, margin, seed))

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = matrix(batch.column("vec"))
            found = [leaves(tree, unit, margin) for tree in forest.value]
            tree = np.concatenate([np.full(len(r), t) for t, (r, _) in enumerate(found)])
            row = np.concatenate([r for r, _ in found])
            # A leaf's number holds its tree in the top bits.
            leaf = np.concatenate([leaf for _, leaf in found]) + (tree << 48)
            order = np.lexsort((leaf, row))
            starts = np.searchsorted(row[order], np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(leaf[order]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("node", "label", "weight", "vec")), lists],
                ["node", "label", "weight", "vec", "leaves"],
            )

    indexed = written(
        nodes.select("node", "label", "weight", "vec").mapInArrow(
            index,
            f"node bigint, label string, weight bigint, vec {nodes.schema['vec'].dataType.simpleString()}, "
            "leaves array<bigint>",
        ),
        "indexed",
    )
    in_leaf = indexed.select("*", F.explode("leaves").alias("leaf"))
    tiles = (
        in_leaf.groupBy("label", "leaf")
        .count()
        .where("count > 1")
        .select("label", "leaf", F.ceil(F.col("count") / TILE_ROWS).cast("int").alias("n_tiles"))
    )
    placed = in_leaf.join(tiles, ["label", "leaf"]).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("n_tiles")).cast("int")
    )
    # Tile i meets tile j once, for i <= j.
    paired = placed.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)).alias("with")
    ).select(
        "node",
        "weight",
        "vec",
        "leaves",
        "label",
        "leaf",
        F.least("own", "with").alias("i"),
        F.greatest("own", "with").alias("j"),
        "own",
    )

    def tile(table: pa.Table) -> pa.Table:
        return compare_tile(table, min_cosine)

    return paired.groupBy("label", "leaf", "i", "j").applyInArrow(tile, RESULT)


def compare_tile(table: pa.Table, min_cosine: float) -> pa.Table:
    """Links between tiles i and j of one leaf, without those that an earlier leaf has."""
    table = table.combine_chunks()
    leaf = table["leaf"][0].as_py()
    node = table["node"].to_numpy()
    weight = table["weight"].to_numpy()
    side = table["own"].to_numpy()
    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    unit = matrix(table["vec"])
    left = np.flatnonzero(side == i)
    right = left if i == j else np.flatnonzero(side == j)
    earlier = table["leaves"].combine_chunks()
    offsets = earlier.offsets.to_numpy() - earlier.offsets[0].as_py()
    numbers = earlier.flatten().to_numpy()
    total = np.zeros(len(node), dtype=np.int64)
    parent = np.arange(len(node))
    step = max(1, (1 << 20) // max(1, len(right)))
    for start in range(0, len(left), step):
        part = left[start : start + step]
        a, b = np.nonzero(unit[part] @ unit[right].T >= min_cosine)
        a, b = part[a], right[b]
        keep = node[a] < node[b] if i == j else np.ones(len(a), dtype=bool)
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        first = first_common(offsets, numbers, a, b, leaf)
        np.add.at(total, a[first], weight[b[first]])
        np.add.at(total, b[first], weight[a[first]])
        unite(parent, a, b)
    roots = find(parent, np.arange(len(node)))
    linked = np.flatnonzero(total)
    moved = np.flatnonzero(roots != np.arange(len(node)))
    return pa.table(
        {
            "node": pa.array(np.concatenate([node[linked], node[moved]])),
            "n": pa.array(
                np.concatenate([total[linked], np.zeros(len(moved), np.int64)]),
                mask=np.repeat([False, True], [len(linked), len(moved)]),
            ),
            "other": pa.array(
                np.concatenate([np.zeros(len(linked), np.int64), node[roots[moved]]]),
                mask=np.repeat([True, False], [len(linked), len(moved)]),
            ),
        }
    )


def first_common(
    offsets: np.ndarray, numbers: np.ndarray, a: np.ndarray, b: np.ndarray, leaf: int
) -> np.ndarray:
    """Whether ``leaf`` is the first leaf that rows a and b share; leaves of a row are sorted."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    row, number = row[numbers < leaf], numbers[numbers < leaf]
    _, code, count = np.unique(number, return_inverse=True, return_counts=True)
    shared = count[code] > 1
    used, code = np.unique(code[shared], return_inverse=True)
    # One bit per earlier leaf that more than one row has.
    bits = np.zeros((len(offsets) - 1, len(used) // 64 + 1), dtype=np.uint64)
    np.bitwise_or.at(
        bits, (row[shared], code // 64), np.uint64(1) << (code % 64).astype(np.uint64)
    )
    first = np.empty(len(a), dtype=bool)
    for start in range(0, len(a), PAIRS_AT_ONCE):
        part = slice(start, start + PAIRS_AT_ONCE)
        first[part] = ~(bits[a[part]] & bits[b[part]]).any(axis=1)
    return first


def find(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    while True:
        up = parent[at]
        if (up == at).all():
            return at
        at = up


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Hook the larger root of every linked pair below the smaller until all agree."""
    while len(a):
        ra, rb = find(parent, a), find(parent, b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
