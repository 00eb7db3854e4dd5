import random

import numpy as np
from pyspark.sql import functions as F

from paperloom.llm.langid import ngram_buckets, predict, score_texts, train

SAMPLES = {
    "en": "the quick brown fox jumps over the lazy dog and then it was the end of the day",
    "de": "der schnelle braune fuchs springt über den faulen hund und dann war es der abend",
    "fr": "le renard brun saute par dessus le chien paresseux et puis ce fut la fin du jour",
}


def training():
    rows = []
    for n in range(30):
        for k, (lang, text) in enumerate(SAMPLES.items()):
            parts = text.split()
            rows.append((n * 3 + k, " ".join(parts[n % 5 :] + parts[: n % 7]), lang, "s"))
    return rows


def test_predictions_and_defined_cases(documents):
    odd = [
        (1000, None, "en", "s"),
        (1001, "", "en", "s"),
        (1002, "123 456 !? ²½", "en", "s"),
        (1003, "THE DOG AND THE FOX", None, None),
        (1003, "THE DOG AND THE FOX", None, None),
        (None, "der hund und der fuchs über dem abend", None, None),
        (1005, "le chien et le renard " * 20000, None, None),
        (1006, "the", "xx", None),
    ]
    docs = documents(training() + odd)
    model = train(docs, usable=F.coalesce(F.col("doc_id") < 1000, F.lit(False)))
    assert model.langs == ("de", "en", "fr")
    got = predict(docs, model).select("row.doc_id", "row.key", "row.lang", "lang_pred", "score").collect()
    assert len(got) == len(training() + odd)
    by_id = {r["doc_id"]: r for r in got}
    assert all(r["lang_pred"] == r["lang"] for r in got if r["doc_id"] is not None and r["doc_id"] < 1000)
    for i in (1000, 1001, 1002):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[1003]["lang_pred"] == "en" and by_id[None]["lang_pred"] == "de"
    assert by_id[1005]["lang_pred"] == "fr" and by_id[1006]["lang_pred"] in model.langs
    assert all(0 <= r["score"] <= 1 for r in got)


def test_scores_like_the_plain_formula(documents):
    model = train(documents(training()), usable=F.lit(True), docs_per_lang=10)
    texts = ["der hund", "a", "the fox, the dog"]
    got = score_texts(model, texts)
    for text, row in zip(texts, got):
        buckets, _ = ngram_buckets([text])
        logs = model.prior + sum(model.log_prob[b] for b in buckets)
        plain = np.exp(logs - logs.max())
        assert np.allclose(row, plain / plain.sum())
    counted = ngram_buckets(["abc"])
    assert counted[1].tolist() == [5 + 4 + 3]


def test_nothing_to_learn(documents):
    docs = documents([(1, "abc", None, "s"), (2, None, "en", "s")])
    assert train(docs, usable=F.lit(True)) is None
    got = predict(docs, None).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 2
    assert predict(documents([]), None).count() == 0
    assert train(documents([]), usable=F.lit(True)) is None


def test_counts_of_training_are_those_of_the_texts(documents):
    """The model's matrix from n-grams spelled out one by one."""
    rows = training()
    model = train(documents(rows), usable=F.lit(True), letters_only=True)
    for k, lang in enumerate(model.langs):
        counts = np.full(model.log_prob.shape[0], 0.5)
        for _, text, of, _ in rows:
            if of == lang:
                counts += np.bincount(ngram_buckets([text])[0], minlength=len(counts))
        assert np.allclose(model.log_prob[:, k], np.log(counts / counts.sum()))


def test_fit_tells_what_is_in_no_learned_language(documents):
    rng = random.Random(5)
    junk = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300)) for _ in range(20)]
    other = ["mies lukee kirjaa ja koira juoksee talon ympäri " * 4, "pies i kot biegną szybko przez zielony las " * 4]
    learned = [(i, f"{text} " * 30, lang, s) for i, text, lang, s in training()]
    rows = learned + [(500 + i, t, None, "s") for i, t in enumerate(junk + other)]
    rows += [(900, "the quick dog 12 +49 30 $$$ jumps over the end of the day", None, "s")]
    docs = documents(rows)
    model = train(docs, usable=F.col("lang").isNotNull(), letters_only=True)
    got = {r["doc_id"]: r for r in predict(docs, model).select("row.doc_id", "score", "fit").collect()}
    known = [got[r[0]]["fit"] for r in learned] + [got[900]["fit"]]
    strange = [got[500 + i]["fit"] for i in range(len(junk + other))]
    assert min(known) > -1.5 > max(strange)
    assert sum(got[500 + i]["score"] > 0.9 for i in range(len(junk))) > 10  # the posterior does not tell
