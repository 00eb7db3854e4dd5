from collections import defaultdict

from paperloom.llm.line_dedup import dedup_lines, dropped_positions, line_bitmaps

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\f\r").translate(LOWER)


def brute(rows, min_docs, keep_first):
    where = defaultdict(set)
    first = {}
    for doc, text, *_ in rows:
        for pos, line in enumerate((text or "").split("\n")):
            if key(line):
                where[key(line)].add(doc)
                place = (doc is not None, doc or 0, pos)
                first[key(line)] = min(first.get(key(line), place), place)
    out = []
    for doc, text, *_ in rows:
        kept, lost = [], 0
        for pos, line in enumerate((text or "").split("\n")):
            repeated = len(where[key(line)]) >= min_docs if key(line) else False
            if repeated and not (keep_first and first[key(line)] == (doc is not None, doc or 0, pos)):
                lost += 1
            else:
                kept.append(line)
        out.append((doc, "\n".join(kept), len(kept) + lost, lost))
    return sorted(out, key=repr)


def result(df):
    rows = df.select("row.doc_id", "kept.text", "kept.n_lines", "kept.n_dropped").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def rows():
    shared = "  Shared LINE\t"
    made = [(i, f"own {i}\n{shared}\nshared line\n\nÉtÉ {i % 2}\nend", "en", "s") for i in range(12)]
    return [
        *made,
        made[3],  # a repeated row
        (3, "the same id\nwith another text\nshared line", "en", "s"),
        (None, "shared line\nno id", "en", "s"),
        (20, None, None, None),
        (21, "", "en", "s"),
        (22, "\n\n \n", "en", "s"),
        (23, "\n".join(["x", "shared line"] * 5000), "en", "s"),
        (24, "x\r\nété 0", "en", "s"),
    ]


def test_like_brute_force(documents):
    data = rows()
    for min_docs, keep_first in ((10, False), (2, False), (3, True), (2, True)):
        got = result(dedup_lines(documents(data), min_docs, keep_first, runs=3))
        assert got == brute(data, min_docs, keep_first)


def test_empty_table_and_nothing_repeated(documents):
    assert result(dedup_lines(documents([]), 2)) == []
    data = [(1, "a\nb", "en", "s"), (2, "c", "en", "s")]
    assert result(dedup_lines(documents(data), 2)) == brute(data, 2, False)


def test_bitmap_lists_only_words_that_lose_a_line(documents):
    text = "\n".join(["shared" if i in (0, 63, 64, 200) else f"u{i}" for i in range(300)])
    maps = line_bitmaps(documents([(1, text, "", ""), (2, "shared", "", "")]), 2)
    got = {r["doc_id"]: r for r in maps.select("*", dropped_positions(maps.keep_words).alias("at")).collect()}
    assert got[1]["at"] == [0, 63, 64, 200]
    assert [w["word"] for w in got[1]["keep_words"]] == [0, 1, 3]
    assert got[2]["at"] == [0]
