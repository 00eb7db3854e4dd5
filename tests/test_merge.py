import random

import pytest
from pyspark.sql import functions as F

from paperloom import schemas
from paperloom.operators import merge
from paperloom.operators.joins import spread_left_join
from paperloom.operators.merge import upsert_documents
from paperloom.operators.ranking import assign_ids, first_wins, last_wins, top_k
from paperloom.session import written
from paperloom.sources.files import SnapshotTable

BATCH = (
    "source_name string, external_id string, doi string, title string, abstract_text string, "
    "pipeline_status string, ingest_seq bigint"
)
VALUES = ["source_name", "external_id", "doi", "title", "abstract_text", "pipeline_status"]


def empty(spark):
    return spark.createDataFrame([], schemas.DOCUMENTS)


def content(df):
    return {r["document_id"]: tuple(r[c] for c in VALUES) for r in df.collect()}


def merged_one_by_one(batches):
    """Row by row: known key -> fill and set status, otherwise append."""
    table = []
    for batch in batches:
        for source, ext, doi, title, abstract, status, _ in sorted(batch, key=lambda r: r[-1]):
            title, status = title or "Untitled", status or "DISCOVERED"
            for row in table:
                if None not in (source, ext) and (row[0], row[1]) == (source, ext):
                    row[2] = doi if doi is not None else row[2]
                    row[4] = abstract if abstract is not None else row[4]
                    row[3], row[5] = title, status
                    break
            else:
                table.append([source, ext, doi, title, abstract, status])
    return {n: tuple(r) for n, r in enumerate(table, 1)}


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_against_row_by_row(spark, seed):
    rng = random.Random(seed)

    def batch(start):
        return [
            (
                rng.choice(["A", "B"]),
                rng.choice([None, *map(str, range(8))]),
                rng.choice([None, "", f"10.1/{n}"]),
                rng.choice([None, "", f"t{n}"]),
                rng.choice([None, f"abstract {n}"]),
                rng.choice([None, "LOADED", "FETCHED"]),
                start + n,
            )
            for n in range(40)
        ]

    batches = [batch(0), batch(100), batch(200)]
    table = empty(spark)
    for rows in batches:
        table = merge.upsert_documents(table, spark.createDataFrame(rows, BATCH).repartition(3))
    assert content(table) == merged_one_by_one(batches)


def test_upsert_null_keeps_the_old_value_and_status_is_new(spark):
    first = [("A", "1", "x", "T", None, "LOADED", 1)]
    again = [("A", "1", None, None, "abs", None, 2)]
    table = merge.upsert_documents(empty(spark), spark.createDataFrame(first, BATCH))
    table = merge.upsert_documents(table, spark.createDataFrame(again, BATCH))
    assert content(table) == {1: ("A", "1", "x", "Untitled", "abs", "DISCOVERED")}


def test_upsert_without_key_always_inserts(spark):
    rows = [("A", None, None, "t", None, None, 1), ("A", None, None, "t", None, None, 2)]
    table = merge.upsert_documents(empty(spark), spark.createDataFrame(rows, BATCH))
    assert len(content(table)) == 2


def test_sources_insert_or_ignore(spark):
    known = spark.createDataFrame([(4, "A", "old", None)], "source_id int, name string, homepage string, api_url string")
    new = spark.createDataFrame(
        [("B", "b2", None, 3), ("B", "b1", None, 2), ("A", "new", None, 1), ("C", "c", "u", 4)],
        "name string, homepage string, api_url string, seq bigint",
    )
    got = sorted(tuple(r) for r in merge.add_new_sources(known, new).collect())
    assert got == [(4, "A", "old", None), (5, "B", "b1", None), (6, "C", "c", "u")]


def test_changes_null_means_no_change(spark):
    docs = spark.createDataFrame([(1, "NEW", "h"), (2, "NEW", None)], "document_id int, pipeline_status string, raw_hash string")
    changes = spark.createDataFrame([(1, "FAILED", None), (3, "X", "y")], docs.schema)
    assert sorted(tuple(r) for r in merge.apply_changes(docs, changes).collect()) == [
        (1, "FAILED", "h"), (2, "NEW", None),
    ]


@pytest.mark.parametrize("hot_rows", [2, 10**6])
def test_doi_conflicts(spark, hot_rows):
    rows = [(1, "a"), (2, "a"), (3, ""), (4, ""), (5, None), (6, None), (7, "a"), (8, "b")]
    docs = spark.createDataFrame(rows, "seq bigint, doi string")
    accepted, conflicts = merge.split_doi_conflicts(docs, "seq", hot_rows=hot_rows)
    assert sorted(r["seq"] for r in accepted.collect()) == [1, 3, 5, 6, 8]
    assert sorted((r["seq"], r["conflicts_with"]) for r in conflicts.collect()) == [(2, 1), (4, 3), (7, 1)]


def test_orphans_and_resume(spark):
    rows = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "document_id int, parent int")
    parents = spark.createDataFrame([(10,), (10,)], "id int")
    assert [r["document_id"] for r in merge.orphans(rows, "parent", parents, "id").collect()] == [3]
    done = rows.where("document_id = 1").select("document_id")
    assert sorted(r["document_id"] for r in merge.without_output(rows, done).collect()) == [2, 3]


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 3, "z")], "k string, seq int, v string")
    assert sorted(tuple(r) for r in first_wins(df, ["k"], "seq").collect()) == [("a", 1, "x"), ("b", 3, "z")]
    assert sorted(tuple(r) for r in last_wins(df, ["k"], "seq").collect()) == [("a", 2, "y"), ("b", 3, "z")]


@pytest.mark.parametrize("k", [3, 1500])
def test_top_k_below_and_above_the_optimizer_threshold(spark, k):
    df = spark.range(4000).select(F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("g"), "id")
    got = {}
    for r in top_k(df, ["g"], [F.col("id").desc()], k).collect():
        got.setdefault(r["g"], set()).add(r["id"])
    for g, hot in (("hot", True), ("cold", False)):
        members = [n for n in range(4000) if (n % 10 < 8) == hot]
        assert got[g] == set(members[-k:])


def test_top_k_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = top_k(df, ["g"], [F.col("id")], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ids_are_consecutive_in_order(spark):
    values = random.Random(1).sample(range(1 << 60), 500)
    df = spark.createDataFrame([(v,) for v in values], "seq bigint").repartition(7)
    got = {r["seq"]: r["id"] for r in assign_ids(df, "seq", "id", start=11).collect()}
    assert got == {v: n for n, v in enumerate(sorted(values), 11)}


@pytest.mark.parametrize("counts_given", [True, False])
def test_spread_join_equals_a_left_join(spark, counts_given):
    keys = ["hot"] * 60 + [None] * 30 + ["a", "b", "c", "nowhere"]
    rows = spark.createDataFrame(list(enumerate(keys)), "n int, k string")
    lookup = spark.createDataFrame([("hot", 1), ("a", 2), ("b", 3), ("unused", 4)], "k string, v int")
    counts = rows.groupBy("k").agg(F.count("*").alias("n_rows")) if counts_given else None
    got = spread_left_join(rows, lookup, "k", F.col("n"), key_counts=counts, hot_rows=5)
    expected = rows.join(lookup, "k", "left")
    assert sorted(map(repr, got.select("n", "k", "v").collect())) == sorted(
        map(repr, expected.select("n", "k", "v").collect())
    )


def test_several_changes_of_one_row_count_in_order(spark):
    from paperloom.operators.merge import apply_changes

    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "document_id int, s string, h string")
    changes = spark.createDataFrame(
        [(1, "new", None, 2), (1, "older", "z", 1), (9, "none", "q", 1)], "document_id int, s string, h string, n int"
    )
    got = apply_changes(rows, changes, order="n").orderBy("document_id").collect()
    assert [tuple(r) for r in got] == [(1, "new", "z"), (2, "b", "y")]


def test_wide_rows_are_shuffled_by_key_only(spark):
    """Ids meet the folded rows by key, the way these are dealt already."""
    batch = spark.createDataFrame(
        [("s", f"x{n}", f"t{n}", None, None, n) for n in range(20)],
        "source_name string, external_id string, title string, doi string, abstract_text string, ingest_seq bigint",
    )
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    before = {name: spark.conf.get(name) for name in names}
    try:
        spark.conf.set(names[0], -1)
        spark.conf.set(names[1], False)
        merged = merge.upsert_documents(empty(spark), batch)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert "hashpartitioning(source_name" in plan and "hashpartitioning(first_seq" not in plan
    assert sorted((r["document_id"], r["external_id"]) for r in merged.collect()) == [
        (n + 1, f"x{n}") for n in range(20)
    ]


DOCS = "source_name string, external_id string, title string, doi string, abstract_text string, ingest_seq bigint"


def _random_docs(spark, seed, n, first):
    """Documents with repeated keys, and some without a key."""
    rng = random.Random(seed)
    rows = [
        (
            rng.choice(["A", "B", None]) if rng.random() < 0.2 else "A",
            None if rng.random() < 0.1 else f"x{rng.randrange(n)}",
            rng.choice(["", None, f"t{i}"]),
            rng.choice([None, f"10/{i}"]),
            rng.choice([None, "text " * 20]),
            first + i,
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, DOCS)


def test_upsert_in_slices_is_the_upsert(spark, monkeypatch):
    monkeypatch.setattr(merge, "MERGED_BYTES", 100)
    monkeypatch.setattr(merge, "SLICES", 6)
    current = written(spark.createDataFrame([], schemas.DOCUMENTS), "none")
    for n, batch in enumerate([_random_docs(spark, 1, 120, 0), _random_docs(spark, 2, 90, 60), _random_docs(spark, 3, 0, 0)]):
        expected = written(upsert_documents(current, batch).select(*current.columns), "expected")
        parts, last = [], []
        for part, is_last in merge.upsert_slices(current, batch):
            parts.append(written(part.select(*current.columns), "part"))
            last.append(is_last)
        assert last == [False] * (len(last) - 1) + [True] and (len(last) > 3 or n == 2)
        got = [r.asDict(True) for p in parts for r in p.collect()]
        assert sorted(got, key=repr) == sorted((r.asDict(True) for r in expected.collect()), key=repr)
        current = expected


def test_no_shuffle_holds_the_whole_batch(spark, monkeypatch):
    """Each part is made of its own slices, which are deleted once it is written."""
    made = []

    class Noted(merge.Slices):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self)

    monkeypatch.setattr(merge, "Slices", Noted)
    monkeypatch.setattr(merge, "MERGED_BYTES", 100)
    monkeypatch.setattr(merge, "SLICES", 6)
    empty = spark.createDataFrame([], schemas.DOCUMENTS)
    counts, left = [], []
    for part, _ in merge.upsert_slices(empty, _random_docs(spark, 4, 200, 0)):
        left.append(made[0].all().count())
        counts.append(part.count())
    assert left == sorted(left, reverse=True) and left[0] == 200 and max(counts) < 100
    folder = spark._jvm.org.apache.hadoop.fs.Path(made[0].path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    assert [s.getPath().getName() for s in files.listStatus(folder)] == ["_SUCCESS"]


def test_a_version_counts_once_all_its_parts_are_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge, "MERGED_BYTES", 100)
    monkeypatch.setattr(merge, "SLICES", 6)
    table = SnapshotTable(spark, str(tmp_path / "t"), schemas.DOCUMENTS)
    one, two = _random_docs(spark, 5, 50, 0), _random_docs(spark, 6, 50, 50)
    table.upsert(one, 1)
    upserted, calls = merge._upserted, []

    def failing(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return upserted(*args)

    monkeypatch.setattr(merge, "_upserted", failing)
    with pytest.raises(RuntimeError):
        table.upsert(two, 2)
    assert table.latest_version() == 1 and not table.has(2)
    table.upsert(two, 2)
    expected = upsert_documents(table.read(1), two).select(*table.read(1).columns)
    rows = [sorted((r.asDict(True) for r in df.collect()), key=repr) for df in (table.read(), expected)]
    assert table.latest_version() == 2 and rows[0] == rows[1]
