import hashlib
import random
from collections import Counter

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F
from test_jaccard_join import shingles
from test_line_dedup import brute as line_brute
from test_mixing import brute_targets
from tokenizers import Tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, documents, words, tmp_path_factory):
    rng = random.Random(4)
    rows = []
    for i in range(160):
        text = "\n".join(words(1000 * i + k, rng.randint(4, 30)) for k in range(rng.randint(1, 5)))
        if i % 4 == 0:
            text += "\nThe same footer on many pages"
        rows.append((i, text, "en", f"s{i % 3}"))
    rows += [(200 + i, rows[5][1], "en", "s1") for i in range(3)]  # copies
    rows += [(300 + i, rows[i][1] + " tail", "en", "s2") for i in range(10, 20)]  # near copies
    rows += [(400, None, "en", "s0"), (401, "", "en", "s0"), (402, "12 34 !", "en", "s0")]
    rows += [(403, "only words", None, None), (None, words(7, 30), "en", "s0"), rows[30]]
    rows += [(None, words(7, 30) + " cab", "en", "s1"), (None, rows[41][1], "en", "s0")]
    path = tmp_path_factory.mktemp("sf")
    documents(rows).write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.fixture(scope="module")
def stages(spark, folder):
    """The input and the result of every stage as lists of rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs.collect()]
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        docs = pipeline.written(stage(spark, docs, folder), name)
        assert docs.columns == columns or name == "tokens"
        seen.append(docs.collect())
    return seen


def plain(rows, columns=COLUMNS):
    return Counter(tuple(r[c] for c in columns) for r in rows)


def test_language_rejects_what_is_in_no_language(stages):
    """Texts without a letter, and the one whose letters no learned text has (403)."""
    kept = [r for r in stages[0] if r["text"] and any(map(str.isalpha, r["text"])) and r["doc_id"] != 403]
    assert plain(stages[1]) == plain(kept) and len(kept) == len(stages[0]) - 4


def test_lines_like_brute_force(stages):
    given = [(r["doc_id"], r["text"]) for r in stages[1]]
    expected = Counter((doc, text) for doc, text, _, lost in line_brute(given, 10, True) if text.split() or not lost)
    assert plain(stages[2], ["doc_id", "text"]) == expected
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2])


def test_one_document_of_each_group_stays(spark, stages):
    def text_hash(text):
        return spark.range(1).select(F.shiftrightunsigned(F.xxhash64(F.lit(text)), 2)).first()[0]

    rows = sorted(
        stages[2], key=lambda r: (1, text_hash(r["text"])) if r["doc_id"] is None else (0, r["doc_id"])
    )
    sets = [shingles(r["text"], 5) for r in rows]
    group = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if 5 * both >= 4 * (len(sets[x]) + len(sets[y]) - both) > 0:
                low, high = sorted((group[x], group[y]))
                group = [low if g == high else g for g in group]
    kept = [rows[i] for i in sorted(set(group))]
    assert plain(stages[3]) == plain(kept) and len(kept) < len(rows) - 10
    assert sum(r["doc_id"] is None for r in stages[2]) == 3
    assert sum(r["doc_id"] is None for r in stages[3]) == 1


def test_mixture_comes_near_its_targets(stages):
    sizes, largest = Counter(), Counter()
    for r in stages[3]:
        n = len(r["text"].split())
        sizes[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    targets = brute_targets(sizes, pipeline.WEIGHTS, pipeline.SHARE, pipeline.MOST)
    got = Counter()
    for r in stages[4]:
        got[r["source"]] += len(r["text"].split())
    for source, target in targets.items():
        assert abs(got[source] - target) <= largest[source] / 2 + 1
    assert set(plain(stages[4])) <= set(plain(stages[3])) and max(plain(stages[4]).values()) <= 2


def test_tokens_like_the_library(stages, vocabulary):
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    expected = Counter(
        (r["doc_id"], tuple(library.encode(r["text"], add_special_tokens=False).ids)) for r in stages[4]
    )
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in stages[5]) == expected
    assert all(r["n_tokens"] == len(r["ids"]) for r in stages[5])


def test_tokens_are_decoded_again(spark, documents, vocabulary):
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    rows = pipeline.tokens(spark, documents([(1, "Some words,\n and é", "en", "s"), (None, "", None, None)]), "").collect()
    assert [r["decoded_sha256"] for r in rows] == [
        hashlib.sha256(library.decode(r["ids"], skip_special_tokens=False).encode()).hexdigest() for r in rows
    ]
    assert len(rows) == 2


def test_run_and_empty_table(spark, documents, stages, folder, tmp_path):
    assert plain(pipeline.run(spark, folder).collect(), ["doc_id", "n_tokens"]) == plain(
        stages[5], ["doc_id", "n_tokens"]
    )
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_largest_ids_leave_no_room_for_documents_without_one(spark, documents, words):
    rows = [(2**63 - 1, words(1, 40), "en", "s"), (None, words(1, 40), "en", "s"), (None, words(2, 40), "en", "s")]
    kept = pipeline.near_duplicates(spark, documents(rows), "").collect()
    assert sorted((r["doc_id"] is None for r in kept)) == [False, True, True]
