import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from paperloom.llm.toxicity import DISCOUNT, byte_grams, class_grams, mean_differences, monotone_fit, predict, train
from paperloom.llm.words import words_of

INSULTS = ["grumbach", "zottel", "nebbich", "flachkopf"]


def made(seed, n, toxic_share=0.3):
    """Documents of invented words; the toxic ones have insults in about every thirtieth place."""
    rng = random.Random(seed)
    syllables = "the an er in on re ed nd ha at en es of or".split()
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < toxic_share
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(60, 300))]
        if toxic:
            for at in rng.sample(range(len(words)), max(2, len(words) // 30)):
                words[at] = rng.choice(INSULTS)
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(toxic)))
    return rows, labels


LABELS = "doc_id bigint, toxic int, text string, label string"


def usable():
    return F.coalesce(F.col("doc_id") < 400, F.lit(False))


def test_held_out_documents_are_judged_right(spark, documents):
    rows, labels = made(1, 600)
    odd = [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, " .. ", "en", "s"), (None, "the Grumbach", None, None)]
    odd += [(1003, "the Zottel an ha grumbach. Nebbich! " * 20_000, None, None)] * 2
    known = spark.createDataFrame(
        [(i, t, "x", "y") for i, t in labels] + [(3, None, "x", "y"), (None, 1, "x", "y"), (5000, 1, "x", "y")], LABELS
    )
    docs = documents(rows + odd)
    model = train(docs, known, usable())
    got = predict(docs, model).select("row.doc_id", "row.key", "score", "predicted").collect()
    assert len(got) == len(rows + odd)
    by_id = {r["doc_id"]: r for r in got}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    held = [(by_id[i]["predicted"], t) for i, t in labels if i >= 400]
    assert sum(p == t for p, t in held) >= 0.98 * len(held)
    assert len({by_id[i]["score"] for i in (1000, 1001, 1002)}) == 1 and by_id[1000]["predicted"] == 0
    assert by_id[1003]["predicted"] == 1


def test_labels_of_other_documents_change_nothing(spark, documents):
    rows, labels = made(2, 150)
    docs = documents(rows)
    turned = [(i, t if i < 100 else 1 - t, "x", "y") for i, t in labels]
    keep = F.col("doc_id") < 100
    scores = [
        [tuple(r) for r in predict(docs, train(docs, spark.createDataFrame(given, LABELS), keep)).select("row.doc_id", "score").orderBy("doc_id").collect()]
        for given in ([(i, t, "x", "y") for i, t in labels], turned)
    ]
    assert scores[0] == scores[1]


def plain_difference(text, samples, shared):
    """The recursion of the model, byte by byte with dictionaries."""
    data = b"".join(b" " + w.encode() for w in words_of(pa.array([text])).array().to_pylist())
    total = 0.0
    for c, sign in ((1, 1), (0, -1)):
        long, seen = {}, set()
        for t in samples[c]:
            d = b"\0" * 4 + b"".join(b" " + w.encode() for w in words_of(pa.array([t])).array().to_pylist())
            for i in range(4, len(d)):
                long[d[i - 4 : i + 1]] = long.get(d[i - 4 : i + 1], 0) + 1
        short = {}
        for g in long:
            short[g[2:]] = short.get(g[2:], 0) + 1

        def likely(counts, gram, lower):
            same = {g: n for g, n in counts.items() if g[:-1] == gram[:-1]}
            if not same:
                return lower
            taken = sum(min(n, DISCOUNT) for n in same.values())
            return (max(same.get(gram, 0) - DISCOUNT, 0) + taken * lower) / sum(same.values())

        padded = b"\0" * 4 + data
        for i in range(4, len(padded)):
            g = padded[i - 4 : i + 1]
            lower = likely(short, g[2:], shared[256 * g[3] + g[4]])
            total += sign * np.log(likely(long, g, lower))
    return total / (len(data) + 50)


def test_differences_like_the_plain_recursion(spark, documents):
    rows, labels = made(3, 40)
    docs = documents(rows)
    model = train(docs, spark.createDataFrame([(i, t, "x", "y") for i, t in labels], LABELS), F.lit(True))
    samples = {c: [r[1] for r, (_, t) in zip(rows, labels) if t == c] for c in (0, 1)}
    for text in ("the Grumbach anhe er", "zebra", rows[0][1][:80]):
        expected = plain_difference(text, samples, model.shared)
        assert np.isclose(mean_differences(model, pa.array([text]))[0], expected)


def test_shared_counts_are_those_of_all_texts(spark, documents):
    rows, labels = made(4, 30)
    extra = [(i, "qx " * 3, "en", "s") for i in range(500, 520)]
    given = spark.createDataFrame([(i, t, "x", "y") for i, t in labels], LABELS)
    keep = F.col("doc_id") < 100
    bare, more = (train(documents(r), given, keep) for r in (rows, rows + extra))
    assert more.shared[256 * ord("q") + ord("x")] > bare.shared[256 * ord("q") + ord("x")]
    assert all(np.array_equal(a.keys, b.keys) for a, b in zip(bare.grams[1], more.grams[1]))
    assert np.allclose(bare.shared.reshape(256, 256).sum(axis=1), 1)


def test_grams_do_not_run_over_texts():
    keys, lengths = byte_grams(words_of(pa.array(["Ab", None, "c d", ""])), 5)
    assert lengths.tolist() == [3, 0, 4, 0]
    spelled = [int(k).to_bytes(5, "big").replace(b"\0", b"").decode() for k in keys]
    assert spelled == [" ", " a", " ab", " ", " c", " c ", " c d"]


def test_monotone_fit_pools_what_falls():
    got = monotone_fit(np.array([0, 3, 1, 9]), np.array([9, 10, 10, 9]))
    assert np.allclose(got, [0.1, 0.2, 0.2, 0.9])


def test_nothing_to_learn(spark, documents):
    none = spark.createDataFrame([], LABELS)
    docs = documents([(1, "abc", None, "s"), (2, None, "en", "s")])
    assert train(docs, none, F.lit(True)) is None
    only = spark.createDataFrame([(1, 1, "x", "y")], LABELS)
    assert train(docs, only, F.lit(True)) is None
    assert [(r["score"], r["predicted"]) for r in predict(docs, None).collect()] == [(0.0, 0)] * 2
    assert predict(documents([]), None).count() == 0
    assert train(documents([]), only, F.lit(True)) is None
    assert class_grams(spark.createDataFrame([], "label int, text string"))[0][0].keys.tolist() == []
