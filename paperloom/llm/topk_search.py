"""Exact top-k search by inner product, term at a time.

Queries and candidates are dealt into blocks, and every pair of blocks is one group of a
grid. In a group the candidates are posting lists, one per dimension: each dimension of the
sparse queries scatters its weight times the posting weights into a dense array of scores.
A partition selection keeps the best of every query in the block, and a second selection
merges the blocks. Nothing is pruned, so the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import written

QUERY_BLOCK = 2_048  # queries of a grid cell, on average
CANDIDATE_BLOCK = 8_192  # candidates of a grid cell, on average
CELLS = 1 << 21  # scores held at once: queries in work x candidates of a cell

RESULT = "query_id bigint, vec_id bigint, score bigint"


def quantized(
    vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(vec_id, weights array<bigint>): floor(scale * x) of every component.

    Null ids, null vectors and vectors with a null or non-finite component take no part.
    Products are computed in 64-bit integers.
    """
    x = F.transform(F.col(f"`{vec_col}`"), lambda v: v.cast("double"))
    bad = F.exists(
        x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(math.inf))
    )
    return vectors.where(
        F.col(f"`{id_col}`").isNotNull() & F.col(f"`{vec_col}`").isNotNull() & ~bad
    ).select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
        F.transform(x, lambda v: F.floor(v * F.lit(float(scale)))).alias("weights"),
    )


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Best ``k`` candidates of every query: query_id, rank, vec_id, score.

    Both sides are (vec_id, weights) as from ``quantized``. A candidate with the query's own
    vec_id is left out; score is the integer inner product over the common dimensions; ties go
    to the smaller vec_id. Exact repeats of a row count once. Fewer candidates give fewer
    rows; no queries or no candidates give none.
    """
    queries = written(queries.distinct(), "queries")
    candidates = written(candidates.distinct(), "candidates")
    n_q, n_c = queries.count(), candidates.count()
    q_blocks = max(1, math.ceil(n_q / QUERY_BLOCK))
    c_blocks = max(1, math.ceil(n_c / CANDIDATE_BLOCK))

    def dealt(df: DataFrame, blocks: int, own: str, others: int, other: str) -> DataFrame:
        return df.select(
            "vec_id",
            "weights",
            F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other),
        )

    left = dealt(queries, q_blocks, "qb", c_blocks, "cb")
    right = dealt(candidates, c_blocks, "cb", q_blocks, "qb")

    def cell(q: pa.Table, c: pa.Table) -> pa.Table:
        return score_cell(q, c, k)

    found = (
        left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(cell, RESULT)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _sparse(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, and the non-zero components as (row, dimension, weight)."""
    ids = table.column("vec_id").to_numpy()
    vectors = table.column("weights").combine_chunks()
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(ids)), lengths)
    dims = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    used = values != 0
    return ids, rows[used], dims[used], values[used]


def _by_dimension(rows: np.ndarray, dims: np.ndarray, values: np.ndarray) -> dict:
    order = np.argsort(dims, kind="stable")
    names, starts = np.unique(dims[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    return {
        int(d): (rows[order[s:e]], values[order[s:e]]) for d, s, e in zip(names, starts, ends)
    }


def _blocks(n_queries: int, n_candidates: int) -> Iterator[tuple[int, int]]:
    step = max(1, CELLS // max(1, n_candidates))
    for start in range(0, n_queries, step):
        yield start, min(n_queries, start + step)


def score_cell(q: pa.Table, c: pa.Table, k: int) -> pa.Table:
    """Top k of every query among the candidates of one grid cell."""
    out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    if q.num_rows and c.num_rows:
        q_ids, q_rows, q_dims, q_values = _sparse(q)
        order = np.argsort(c.column("vec_id").to_numpy(), kind="stable")
        c_ids, *entries = _sparse(c.take(pa.array(order)))
        postings = _by_dimension(*entries)
        for start, end in _blocks(len(q_ids), len(c_ids)):
            scores = np.zeros((end - start, len(c_ids)), dtype=np.int64)
            mine = (q_rows >= start) & (q_rows < end)
            terms = _by_dimension(q_rows[mine] - start, q_dims[mine], q_values[mine])
            for d, (rows, weights) in terms.items():
                if d not in postings:
                    continue
                at, posted = postings[d]
                if len(at) == len(c_ids):  # a full posting list needs no scatter
                    for row, weight in zip(rows, weights):
                        scores[row] += weight * posted
                else:
                    for row, weight in zip(rows, weights):
                        scores[row, at] += weight * posted
            for row in range(end - start):
                own = q_ids[start + row]
                line = scores[row]
                others = np.flatnonzero(c_ids != own)
                values = line[others]
                if len(others) > k:
                    floor = np.partition(values, len(values) - k)[len(values) - k]
                    # Above the k-th score all, at it the smallest ids; ids are in order.
                    above = np.flatnonzero(values > floor)
                    level = np.flatnonzero(values == floor)[: k - len(above)]
                    chosen = np.concatenate([above, level])
                else:
                    chosen = np.arange(len(others))
                out["query_id"].append(np.full(len(chosen), own))
                out["vec_id"].append(c_ids[others[chosen]])
                out["score"].append(values[chosen])
    return pa.table(
        {
            name: pa.array(np.concatenate(parts) if parts else np.empty(0), pa.int64())
            for name, parts in out.items()
        }
    )
