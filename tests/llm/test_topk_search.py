import math

import pytest
from pyspark.sql import functions as F

from paperloom.llm import topk_search
from paperloom.llm.topk_search import quantized, top_k

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string, score string, weights string"


def brute(rows, k):
    vectors = {
        i: [math.floor(256 * x) for x in v]
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for q in (i for i in vectors if i % 50 == 0):
        scores = [(-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def rows():
    import random

    rng = random.Random(3)
    made = []
    for i in range(330):
        v = [round(rng.choice([0, 0, rng.uniform(-1, 1)]), 2) for _ in range(6)]
        made.append((i, v))
    made += [(1000, [0.0] * 6), (1001, [float("nan")] * 6), (1002, [None, *[1.0] * 5]), (1003, None)]
    made += [(1050, [float("inf")] * 6), (None, [1.0] * 6), (1051, []), (1052, [0.5, 0.5]), made[7], made[50]]
    made += [(2000 + i, [0.25] * 6) for i in range(12)]  # ties
    return [(i, v and [None if x is None else float(x) for x in v], 1, "r", "s", "w") for i, v in made]


@pytest.mark.parametrize("blocks", [(2048, 8192), (3, 50)])
def test_like_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", blocks[1])
    data = rows()
    vectors = quantized(spark.createDataFrame(data, SCHEMA))
    got = top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, 5)
    assert sorted(map(tuple, got.collect())) == brute(data, 5)


def test_few_and_no_candidates(spark):
    data = [(0, [1.0, 0.0], 1, "", "", ""), (1, [0.5, 0.5], 1, "", "", "")]
    vectors = quantized(spark.createDataFrame(data, SCHEMA))
    got = top_k(vectors.where("vec_id = 0"), vectors, 5).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 256 * 128)]
    assert top_k(vectors.where("vec_id = 7"), vectors, 5).count() == 0
    empty = quantized(spark.createDataFrame([], SCHEMA))
    assert top_k(empty, empty, 5).count() == 0
