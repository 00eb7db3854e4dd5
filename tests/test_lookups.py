import pytest
from pyspark.sql import functions as F

from paperloom.functions.extraction import extract_all
from paperloom.functions.normalization import canonicalize
from paperloom.functions.vocab import ALIASES
from paperloom.operators.lookups import canonical_column, extract_fields, vocabulary_table

TEXTS = [
    (1, "Abstract MC3 with mc3, Cholesterol; molar ratio 46:9. Packed siRNA IV. to mice and HeLa"),
    (2, "nothing"),
    (3, ""),
    (4, None),
]


def test_fields_of_the_default_table_are_those_of_the_code(spark):
    texts = spark.createDataFrame(TEXTS, "id int, body string")
    by_table = extract_fields(texts, "body", vocabulary_table(spark)).orderBy("id").collect()
    by_code = extract_all(texts, "body").orderBy("id").collect()
    for t, c in zip(by_table, by_code, strict=True):
        assert t["lipids"] == c["lipid_reagents"]
        assert (t["ratio"] or None) == (c["lipid_ratios_text"] or None)
        assert (t["payload"], t["route"]) == (c["payload"], c["administration_route"])
        assert (", ".join(t["cells"]) or None) == c["cells_or_organisms"]


def test_a_new_field_is_rows_of_the_table(spark):
    added = spark.createDataFrame(
        [("metal", "gold", 1, "all"), ("metal", "gold(?:en)?", 0, "all"), ("metal", None, 2, "all"), (None, "x", 0, "all")],
        "field string, pattern string, ordinal int, mode string",
    )
    texts = spark.createDataFrame([("Golden gold GOLD",), (None,)], "body string")
    got = extract_fields(texts, "body", vocabulary_table(spark).unionByName(added))
    assert [r["metal"] for r in got.collect()] == [["Golden", "gold"], []]
    assert extract_fields(texts, "body", added.limit(0)).columns == ["body"]


def test_a_field_has_one_mode(spark):
    bad = spark.createDataFrame([("f", "a", 0, "all"), ("f", "b", 1, "first")], vocabulary_table(spark).schema)
    with pytest.raises(ValueError, match="one mode"):
        extract_fields(spark.createDataFrame([("a",)], "body string"), "body", bad)


@pytest.mark.parametrize("limits", [{}, {"map_aliases": 0}, {"map_aliases": 0, "broadcast_bytes": 0, "hot_rows": 2}])
def test_every_way_of_looking_up_gives_one_result(spark, limits):
    values = ["Cationic Lipid", " chol ", "IV.", "DSPC.", "sc", None, "", *["IV"] * 20, " x. "]
    rows = spark.createDataFrame(list(enumerate(values)), "n int, `v` string").withColumn("_n", F.col("n"))
    table = [*ALIASES.items(), ("IV", "zzz"), (None, "a"), ("b", None)]
    aliases = spark.createDataFrame(table, "alias string, canonical string")
    got = canonical_column(rows, "v", aliases, **limits)
    expected = rows.withColumn("v", canonicalize(F.col("v")))
    assert got.columns == rows.columns
    assert sorted(got.collect()) == sorted(expected.collect())


def test_a_million_aliases(spark):
    aliases = spark.range(1_000_000).select(
        F.concat(F.lit("A"), "id").alias("alias"), F.concat(F.lit("name "), "id").alias("canonical")
    )
    rows = spark.createDataFrame([("a5.",), (" A999999",), ("b",), (None,)], "v string")
    got = canonical_column(rows, "v", aliases)
    assert sorted(r["v"] for r in got.collect()) == ["", "b", "name 5", "name 999999"]


def test_no_aliases(spark):
    rows = spark.createDataFrame([(" a ",), (None,)], "v string")
    none = spark.createDataFrame([], "alias string, canonical string")
    assert [r["v"] for r in canonical_column(rows, "v", none).collect()] == ["a", ""]
