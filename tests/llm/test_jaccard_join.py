import random

import numpy as np
import pyarrow as pa
import pytest

from paperloom.llm import jaccard_join
from paperloom.llm.jaccard_join import (
    Similarity,
    compare_small,
    join_documents,
    shingle_set,
    shingle_sets,
    signatures,
    sketch,
    whole_buckets,
)


def shingles(text, width):
    ws = (text or "").encode().lower().split()
    if len(ws) < width:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i : i + width]) for i in range(len(ws) - width + 1)}


def brute(rows, num, den, width):
    sets = [shingles(t, width) for _, t, *_ in rows]
    comp = {i: i for i, *_ in rows if i is not None}
    links = []
    for x, a in enumerate(sets):
        for y, b in enumerate(sets[:x]):
            both = len(a & b)
            if a and b and den * both >= num * (len(a) + len(b) - both):
                links.append((rows[x][0], rows[y][0]))
    links = [(x, y) for x, y in links if x is not None and y is not None]
    changed = True
    while changed:
        changed = False
        for x, y in links:
            low = min(comp[x], comp[y])
            changed |= comp[x] != low or comp[y] != low
            comp[x] = comp[y] = low
    return sorted(
        ((i, len(s), comp[i] if i is not None else None) for (i, *_), s in zip(rows, sets)), key=repr
    )


def edited(rng, text, n):
    ws = text.split()
    for _ in range(n):
        at = rng.randrange(len(ws))
        ws[at] = rng.choice(["swap", "other", "new", ws[at] + "x"])
    return " ".join(ws)


def rows(words):
    rng = random.Random(5)
    made = []
    for base in range(25):
        text = words(base, rng.choice([3, 8, 20, 45, 120, 400]))
        copies = 12 if base == 3 else rng.randint(1, 4)
        for _ in range(copies):
            made.append(edited(rng, text, rng.choice([0, 0, 1, 1, 2, 4, 9])))
    passage = words(999, 60)
    made += [passage + " " + words(2000 + i, 25) for i in range(8)]
    chain = words(77, 200).split()
    made += [" ".join(chain[:4] + chain[4 + 6 * i : 4 + 6 * i + 150]) for i in range(8)]
    rng.shuffle(made)
    out = [(i * 7 % 1009, t, "en", "s") for i, t in enumerate(made)]
    out += [(2000, None, None, None), (2001, "", "", ""), (2002, " \t\n ", "", ""), (2003, " \t\n ", "", "")]
    out += [(2004, "One two", "", ""), (2005, "one\x0btwo", "", ""), (2006, "two one", "", "")]
    out += [(None, made[0], "en", "s"), out[4], out[9]]
    return out


@pytest.mark.parametrize("num, den, width, tiny", [(85, 100, 4, False), (4, 5, 5, False), (4, 5, 5, True)])
def test_like_brute_force(documents, words, monkeypatch, num, den, width, tiny):
    if tiny:  # every bucket goes through tiles
        monkeypatch.setattr(jaccard_join, "SMALL_BUCKET", 1)
        monkeypatch.setattr(jaccard_join, "TILE_ROWS", 3)
        monkeypatch.setattr(jaccard_join, "FIRST_BUCKETS", 1)
    data = rows(words)
    got = join_documents(documents(data), (num, den), width)
    assert got.columns == ["doc_id", "text_hash", "n_shingles", "component_id"]
    found = got.select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found), key=repr) == brute(data, num, den, width)


def test_same_id_with_other_text_links(documents, words):
    data = [(5, words(1, 30), "", ""), (5, words(2, 30), "", ""), (3, words(2, 30), "", ""), (9, words(1, 30), "", "")]
    got = join_documents(documents(data)).collect()
    assert {r["component_id"] for r in got} == {3}


def test_empty_table_and_one_document(documents):
    assert join_documents(documents([])).count() == 0
    got = join_documents(documents([(4, "only one here", "", "")])).collect()
    assert [(r["doc_id"], r["component_id"]) for r in got] == [(4, 4)]


@pytest.mark.parametrize("n", [2, 5, 7, 9, 14, 30, 77, 200, 900, 3000])
def test_similar_sets_share_a_signature(n):
    """Edits spread evenly over the parts are the worst case for the signatures."""
    rng = random.Random(n)
    least = Similarity(85, 100)
    for _ in range(6):
        a = {f"w{rng.random()}" for _ in range(n)}
        b = set(a)
        while True:
            trial = set(b)
            change = rng.choice(["swap", "drop", "add"])
            if change != "add":
                trial.discard(rng.choice(sorted(trial)))
            if change != "drop":
                trial.add(f"v{rng.random()}")
            if not least.holds(len(a & trial), len(a), len(trial)):
                break
            b = trial
        one, two = (
            shingle_set(" ".join(sorted(s)), 1, {}) for s in (a, b)
        )
        assert len(one) == len(a) and len(two) == len(b)
        if a != b:
            assert set(signatures(one, least).tolist()) & set(signatures(two, least).tolist())


def test_rows_that_several_tasks_give_meet_others(spark):
    given = [(1, 5), (1, 5), (1, 7), (2, 5), (2, 5), (3, 5), (3, 7), (3, 7), (4, 9), (5, 1), (5, 2), (5, 2), (5, 3)]
    rows = spark.createDataFrame(given, "signature bigint, print bigint").repartition(4)
    met = sorted(map(tuple, jaccard_join._meetings(rows).collect()))
    assert met == [(1, 5), (1, 7), (3, 5), (3, 7), (5, 1), (5, 2), (5, 3)]


def test_copies_in_many_tasks_link_to_near_copies(documents, words):
    data = []
    for base in range(40):
        text = words(base, 90)
        near = text + " and one more"
        data += [(10_000 * copy + base, text, "", "") for copy in range(5)]
        data.append((100_000 + base, near, "", ""))
    random.Random(3).shuffle(data)
    got = join_documents(documents(data).repartition(8)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(i, i % 10_000) for i, *_ in data}


def test_sets_of_a_piece_are_those_of_its_texts():
    rng = random.Random(7)
    letters = ["a", "B", "é", "É", "\x1c", "\x85", "z" * 64, "y" * 65, "x" * 3000]
    texts = [None, "", " \t\n\x0b\f\r", "one", "w " * 5000, "q" * 2_000_000 + " r s t u"]
    for _ in range(300):
        texts.append("".join(rng.choice([*letters, *" \t\n\x0b\f\r"]) for _ in range(rng.randrange(60))))
    for width in (1, 4, 5):
        together = shingle_sets(pa.array(texts), width)
        for text, found in zip(texts, together, strict=True):
            assert np.array_equal(found, shingle_set(text, width, {}))
            assert len(found) == len(shingles(text, width))
    assert len(shingle_sets(pa.array(texts)[7:20], 4)) == 13
    assert shingle_sets(pa.array([], pa.string()), 4) == []


def test_small_buckets_compared_like_pair_by_pair():
    rng = np.random.default_rng(4)
    least = Similarity(4, 5)
    rows, number = [], 0
    for signature in range(60):
        base = rng.integers(0, 1 << 62, rng.integers(20, 300)).astype(np.uint64)
        for _ in range(rng.integers(2, jaccard_join.SMALL_BUCKET + 1)):
            number += 1
            kept = base[rng.random(len(base)) > rng.choice([0.0, 0.05, 0.4])]
            own = rng.integers(0, 1 << 62, rng.integers(1, 20)).astype(np.uint64)
            elements = np.unique(np.concatenate([kept, own]))
            rows.append((signature, number * 977 % 1009, len(elements), sketch(elements), int(rng.integers(0, 4))))
    columns = ["signature", "print", "n_shingles", "sketch", "component"]
    table = pa.table({c: [r[i] for r in rows] for i, c in enumerate(columns)})
    expected = set()
    for i, a in enumerate(rows):
        for b in rows[:i]:
            if a[0] == b[0] and a[4] != b[4]:
                x, y = (np.frombuffer(r[3], dtype="<u8") for r in (a, b))
                width = min(len(x), len(y))
                x, y = (np.bitwise_xor.reduce(w.reshape(-1, width), axis=0) for w in (x, y))
                near = np.bitwise_count(x ^ y).sum() <= least.difference(a[2], b[2])
                if near and least.den * min(a[2], b[2]) >= least.num * max(a[2], b[2]):
                    expected.add((max(a[1], b[1]), min(a[1], b[1])))
    assert expected
    whole = table.combine_chunks().to_batches()[0]
    for step in (1, 7, 100_000):
        batches = [whole.slice(i, step) for i in range(0, len(rows), step)]
        found = set()
        for part in whole_buckets(batches):
            got = compare_small(part, least)
            found |= set(zip(got.column("a").to_pylist(), got.column("b").to_pylist()))
        assert found == expected
