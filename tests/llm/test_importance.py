import hashlib
import math
import random
import zlib

import pytest

from paperloom.llm.importance import draw
from test_words import plain_words


def features(text, sizes):
    words = plain_words(text)
    return [" ".join(words[i : i + n]) for n in range(sizes[0], sizes[1] + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, share, least, sizes, buckets):
    counts = [[0] * buckets, [0] * buckets]
    for k, texts in enumerate(([t for _, t in rows], target)):
        for t in texts:
            for f in features(t, sizes):
                counts[k][zlib.crc32(f.encode()) % buckets] += 1
    s_all, t_all = (sum(c) + buckets for c in counts)
    gain = [math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(*counts)]
    found = []
    for i, text in rows:
        of = features(text, sizes)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in of)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([i, len(of), weight, score, None, len(plain_words(text)) >= least])
    able = sorted((r for r in found if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for n, row in enumerate(able[: len(able) * share[0] // share[1]]):
        row[4] = n + 1
    return sorted((tuple(r[:5]) for r in found), key=repr)


def drawn(spark, documents, rows, target, **how):
    docs = documents([(i, t, None, None) for i, t in rows])
    table = spark.createDataFrame([(t, "x") for t in target], "text string, weight string")
    got = draw(docs, table, **how).select("doc_id", "n_features", "weight", "score", "rank")
    return sorted(map(tuple, got.collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(50)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))) for i in range(n)]
    target = [" ".join(rng.choices(vocabulary[:10], k=30)) for _ in range(5)] + [None, ""]
    return rows, target


@pytest.mark.parametrize("sizes, buckets", [((1, 1), 10_000), ((1, 3), 97), ((2, 2), 10_000)])
def test_same_as_brute_force(spark, documents, sizes, buckets):
    rows, target = corpus(1, 300)
    rows += [(900, None), (901, ""), (902, "... "), (None, "w1é " * 30), (903, "w2é " * 40_000), (904, "x" * 5000 + " y" * 25)]
    rows += [(905, "w3é w4é " * 20)] * 3
    got = drawn(spark, documents, rows, target, share=(30, 100), sizes=sizes, buckets=buckets)
    assert got == brute(rows, target, (30, 100), 20, sizes, buckets)


def test_copies_with_equal_scores_are_ranked_by_id(spark, documents):
    # One id shares its noise, so its repeats tie; all of them are ranked in a row.
    rows = [(7, "a " * 25)] * 40 + [(i, "b " * 25) for i in range(100, 160)]
    got = drawn(spark, documents, rows, ["a"], share=(1, 1))
    assert sorted(r[4] for r in got) == list(range(1, 101))
    ranks = [r[4] for r in got if r[0] == 7]
    assert max(ranks) - min(ranks) == 39


def test_reruns_agree_and_documents_like_the_target_lead(spark, documents):
    rows, target = corpus(2, 400)
    first = drawn(spark, documents, rows, target)
    assert first == drawn(spark, documents, rows, target)
    n_able = sum(len(plain_words(t)) >= 20 for _, t in rows)
    assert sum(r[4] is not None for r in first) == n_able // 10


@pytest.mark.parametrize("rows, target", [([], ["a"]), ([(1, "a " * 30)], []), ([(1, None)], [None])])
def test_empty_tables(spark, documents, rows, target):
    got = drawn(spark, documents, rows, target)
    assert got == brute(rows, target, (10, 100), 20, (1, 1), 10_000)
