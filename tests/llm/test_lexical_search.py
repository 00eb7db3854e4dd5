import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperloom.llm import lexical_search
from paperloom.llm.lexical_search import build_index, item_terms, search
from test_words import plain_words

ITEMS = "item_id bigint, text string, rank string, doc_id string"


def brute(rows, items, k):
    """The formula, document by document and term by term."""
    docs = [(i, Counter(plain_words(t))) for i, t in rows if plain_words(t)]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(w for _, c in docs for w in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_words(text))
    found = []
    for item, terms in wanted.items():
        scored = []
        for i, c in docs:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = 0
            for w in terms & c.keys():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                score += weight * (10**9 * c[w] // (1000 * c[w] + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        best = sorted(scored)[:k]
        found += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(best)]
    return sorted(found, key=repr)


def queried(spark, rows, items, documents, k=5, known=True):
    docs = documents([(i, t, None, None) for i, t in rows])
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS)
    pairs = item_terms(table, "item_id", "text")
    index = build_index(docs, pairs.select("term") if known else None)
    got = search(index, pairs, k).select("item_id", "rank", "doc_id", "score").collect()
    return sorted(map(tuple, got), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([3, 3, 8, 40])))) for i in range(n)]
    items = [(i, " ".join(rng.choices(vocabulary, k=6))) for i in range(12)]
    return rows, items


ODD_ROWS = [
    (900, None),
    (901, ""),
    (902, " .,- "),
    (903, "W1 w1 É é w59"),
    (903, "W1 w1 É é w59"),
    (None, "w1 w2 w3"),
    (None, None),
    (904, "w2 w1 " * 30_000),
]
ODD_ITEMS = [(50, None), (51, "!"), (52, "É nowhere"), (53, "w1"), (53, "w2 W1"), (None, "w3"), (54, "w1 w1 w1")]


def test_same_as_brute_force_with_odd_rows(spark, documents):
    rows, items = corpus(1, 300)
    rows, items = rows + ODD_ROWS, items + ODD_ITEMS
    expected = brute(rows, items, 5)
    assert queried(spark, rows, items, documents) == expected
    assert queried(spark, rows, items, documents, known=False) == expected


def test_small_chunks_and_blocks_change_nothing(spark, documents, monkeypatch):
    rows, items = corpus(2, 200)
    for name, value in {
        "CHUNK_DOCS": 7,
        "CHUNK_POSTINGS": 40,
        "BLOCK_PAIRS": 20,
        "POSTINGS_AT_ONCE": 16,
        "CELLS_AT_ONCE": 32,
        "KNOWN_TERMS": 3,
    }.items():
        monkeypatch.setattr(lexical_search, name, value)
    assert queried(spark, rows + ODD_ROWS, items, documents, k=3) == brute(rows + ODD_ROWS, items, 3)


def test_many_ties_go_to_the_smaller_id(spark, documents):
    rows = [(i, "alpha beta") for i in range(400)] + [(i, "gamma") for i in range(400, 900)]
    got = queried(spark, rows, [(1, "beta")], documents, k=50)
    assert [(r[1], r[2]) for r in got if r[0] == 1] == sorted(((n + 1, n) for n in range(50)), key=lambda x: repr((1, *x)))


@pytest.mark.parametrize("rows, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, "b")])])
def test_empty_tables(spark, documents, rows, items):
    assert queried(spark, rows, items, documents) == []


def test_other_ids_than_numbers(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "y")], "item_id string, text string")
    pairs = item_terms(items, "item_id", "text")
    got = search(build_index(docs), pairs, k=3).orderBy("rank").collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in got] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None)]


def test_index_holds_every_document(documents):
    rows, _ = corpus(3, 100)
    index = build_index(documents([(i, t, None, None) for i, t in rows + ODD_ROWS]))
    held = index.chunks.select(F.explode("docs").alias("d")).count()
    assert held == index.n_docs == sum(bool(plain_words(t)) for _, t in rows + ODD_ROWS)
