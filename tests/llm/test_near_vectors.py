import numpy as np
import pytest

from paperloom.llm import near_vectors
from paperloom.llm.near_vectors import link_vectors

SCHEMA = "vec_id bigint, label int, embedding array<float>, node string, weight string, leaf string"


def rows(n, dims, groups, seed):
    rng = np.random.default_rng(seed)
    made = []
    for i in range(n):
        made.append((i, int(i % 3), rng.standard_normal(dims)))
    for g in range(groups):
        base = rng.standard_normal(dims)
        for _ in range(int(rng.integers(2, 40))):
            i = len(made)
            noise = rng.standard_normal(dims) * rng.choice([0.0, 0.05, 0.09])
            made.append((i, int(g % 2), base * rng.choice([1, 1, 3]) + noise))
    order = rng.permutation(len(made))
    return [(int(order[i]), label, [float(np.float32(x)) for x in v]) for i, label, v in made]


def table(spark, data):
    return spark.createDataFrame([(*r, "n", "w", "l") for r in data], SCHEMA)


def brute(data, least):
    good = [
        (i, label, np.array(v, float))
        for i, label, v in data
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    n_links, comp = {i: 0 for i, *_ in data}, {i: i for i, *_ in data}
    links = []
    for a in range(len(good)):
        for b in range(a):
            (i, k, x), (j, m, y) = good[a], good[b]
            if k == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links.append((i, j))
                n_links[i] += 1
                n_links[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(comp[i], comp[j])
            changed |= comp[i] != low or comp[j] != low
            comp[i] = comp[j] = low
    return n_links, comp


@pytest.mark.parametrize("leaf, tile", [(512, 1024), (20, 16)])
def test_recall_and_precision(spark, monkeypatch, leaf, tile):
    monkeypatch.setattr(near_vectors, "LEAF_ROWS", leaf)
    monkeypatch.setattr(near_vectors, "TILE_ROWS", tile)
    data = rows(150, 24, 8, 1)
    got = {r["vec_id"]: r for r in link_vectors(table(spark, data), 0.98, n_trees=6).collect()}
    n_links, comp = brute(data, 0.98)
    assert set(got) == set(n_links)
    assert all(got[i]["n_links"] <= n for i, n in n_links.items())
    recall = sum(r["n_links"] for r in got.values()) / sum(n_links.values())
    assert recall >= (1.0 if leaf == 512 else 0.97)
    if recall == 1.0:
        assert {i: r["component_id"] for i, r in got.items()} == comp
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_defined_cases(spark):
    one = [1.0, 0.0, 0.0]
    data = [
        (1, 0, one), (2, 0, one), (3, 1, one), (4, None, one), (5, 0, None), (6, 0, [0.0] * 3),
        (7, 0, [float("nan"), 1.0, 0.0]), (8, 0, [1.0, None, 0.0]), (9, 0, [1e-30, 0.0, 0.0]),
        (10, 0, [3e38, 0.0, 0.0]), (11, 0, [1.0, 0.0]), (12, 0, []), (13, 0, [float("inf"), 0.0, 0.0]),
    ]
    got = {r["vec_id"]: r for r in link_vectors(table(spark, data)).collect()}
    n_links, comp = brute(data, 0.98)
    n_links |= {1: 3, 2: 3, 9: 3, 10: 3}
    comp |= {9: 1, 10: 1}
    assert {i: r["n_links"] for i, r in got.items()} == n_links
    assert {i: r["component_id"] for i, r in got.items()} == comp
    repeated = link_vectors(table(spark, [data[0], data[0], (None, 0, one)])).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"]) for r in repeated) == [(0, 0), (1, 1), (1, 1)]
    assert link_vectors(table(spark, [])).count() == 0
