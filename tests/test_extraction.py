import random
import re

import pytest
from pyspark.sql import functions as F

from paperloom.functions import extraction as ex
from paperloom.functions.exprs import json_object, unique_ignoring_case
from paperloom.functions.patterns import any_of
from paperloom.functions.vocab import CELLS, LIPIDS, PAYLOADS, ROUTES, Vocabulary
from paperloom.plans.catalog_text import payload_summary
from paperloom.plans.etl import extract_records

# Two texts that name every kind of field, made up for this test.
GOLD = [
    "We blended DOTMA with DOPE, then added C12-200; the molar ratio 40:35:25 held for weeks. "
    "Plasmid DNA went in last, and each rabbit got one drop under the skin.",
    "Batch two: DLinDMA, DOPC and DMG-PEG. Antisense strands reached the hepatocyte after a "
    "topical gel.",
]


def test_gold_texts(spark):
    df = spark.createDataFrame(list(enumerate(GOLD)), "n int, body string")
    one, two = ex.extract_all(df, "body").orderBy("n").collect()
    assert one["lipid_reagents"] == ["DOTMA", "DOPE", "C12-200"]
    assert one["lipid_mix_text"] == "DOTMA, DOPE, C12-200"
    assert one["lipid_reagents_json"] == '["DOTMA", "DOPE", "C12-200"]'
    assert (one["payload"], one["administration_route"]) == ("Plasmid DNA", "it")
    assert (one["lipid_ratios_text"], one["lipid_ratios_json"]) == ("molar ratio 40", None)
    assert (one["cells_or_organisms"], one["extraction_confidence"]) == ("rat, rabbit", 1.0)
    assert two["lipid_reagents"] == ["DLinDMA", "DOPC", "DMG-PEG"]
    assert (two["payload"], two["cells_or_organisms"]) == ("Antisense", "hepatocyte")
    assert (two["administration_route"], two["extraction_confidence"]) == ("in", 0.9)


def test_route_without_word_boundaries_and_with(value):
    text = ["a lipid given intravenously"]
    assert value(ex.extract_route, text) == ["ip"]
    assert value(lambda t: ex.extract_route(t, whole_words=True), text) == ["intravenously"]


def test_nothing_found(spark):
    df = spark.createDataFrame([("",), (None,), ("zzz",)], "body string")
    for row in ex.extract_all(df, "body").collect():
        assert row["lipid_reagents"] == []
        assert row["lipid_reagents_json"] is None and row["lipid_mix_text"] is None
        assert row["payload"] is None and row["cells_or_organisms"] is None
        assert row["extraction_confidence"] == 0.0
        assert row["evidence_span"] == (row["body"] or None)


def test_evidence_is_the_first_500_characters(spark):
    df = spark.createDataFrame([("é" * 501,)], "body string")
    assert ex.extract_all(df, "body").first()["evidence_span"] == "é" * 500


def test_all_confidence_sums(spark):
    parts = [("lipids", 0.4), ("payload", 0.2), ("cells", 0.15), ("route", 0.15), ("ratio", 0.1)]
    rows = [[bool(n & (1 << i)) for i in range(5)] for n in range(32)]
    df = spark.createDataFrame(rows, ", ".join(f"{p} boolean" for p, _ in parts))
    text = {p: F.when(F.col(p), "x") for p, _ in parts[1:]}
    lipids = F.when(F.col("lipids"), F.array(F.lit("x"))).otherwise(F.array())
    score = ex.confidence(lipids, text["payload"], text["cells"], text["route"], text["ratio"])
    for row in df.withColumn("score", score).collect():
        assert row["score"] == round(sum(w for p, w in parts if row[p]), 2)


def test_ratio_stops_at_colon_stop_and_120_characters(value):
    got = value(
        ex.extract_ratio,
        ["the Molar Ratio of 50 : 10", "wt/wt  ", "weight ratio\n2", "mol/mol" + "x" * 200, "none"],
    )
    assert got == ["Molar Ratio of 50", "wt/wt", "weight ratio", "mol/mol" + "x" * 120, None]


def test_parse_ratio(value):
    got = value(ex.parse_ratio, ["ratio 50:10:38.5:1.5 and 1:2", "2", None])
    assert got == [[50.0, 10.0, 38.5, 1.5], None, None]


def test_unicode_space_and_case(value):
    assert value(ex.extract_lipids, ["ionizable lipid; Ionizable Lipid, DſPC"]) == [
        ["ionizable lipid", "DſPC"]
    ]


def test_unique_ignoring_case(value):
    got = value(unique_ignoring_case, [["a", " A ", "b", "", "B", "a"], [], None], "array<string>")
    assert got == [["a", "b"], [], None]


@pytest.mark.parametrize("words", [LIPIDS, PAYLOADS, ROUTES, CELLS, ("x|y", "xz"), ("ab*", "abc")])
def test_grouped_pattern_matches_like_the_plain_one(spark, words):
    rng = random.Random(7)
    pieces = [re.sub(r"\[.*?\][*+]|\(\?:ly\)\?", " ", w) for w in words]
    texts = []
    for _ in range(300):
        parts = [rng.choice([rng.choice(pieces), rng.choice("abcdimorstx -ſKİ")]) for _ in range(12)]
        texts.append("".join(p.upper() if rng.random() < 0.3 else p for p in parts))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = "(?iuU)" + "|".join(f"(?:{w})" for w in words)
    both = df.select(
        F.regexp_extract_all("t", F.lit(any_of(words)), F.lit(0)).alias("a"),
        F.regexp_extract_all("t", F.lit(plain), F.lit(0)).alias("b"),
    ).collect()
    assert any(r["a"] for r in both)
    assert all(r["a"] == r["b"] for r in both)


def test_own_vocabulary(spark):
    vocab = Vocabulary(payloads=("insulin",), aliases={"peg": "PEG-lipid"})
    df = spark.createDataFrame([(1, "DSPC with Insulin")], "id int, abstract_or_body string")
    assert extract_records(df, vocab).first()["payload"] == "Insulin"


def test_confidence_threshold_is_off_by_default(spark):
    df = spark.createDataFrame([(1, "DSPC"), (2, "zzz")], "id int, abstract_or_body string")
    assert extract_records(df).count() == 2
    assert [r["id"] for r in extract_records(df, min_confidence=0.4).collect()] == [1]


def test_json_object_is_spaced_and_escaped(spark):
    df = spark.createDataFrame([(1, 'a"b\n', None)], "n int, s string, z string")
    got = df.select(json_object({"n": F.col("n"), "s": F.col("s"), "z": F.col("z")})).first()[0]
    assert got == '{"n": 1, "s": "a\\"b\\n", "z": null}'


def test_payload_summary_reads_cleaned_text(spark, tmp_path):
    """Markup hides no names and gives none, and white space inside a name does not count."""
    texts = ['one <img alt="mRNA"> pDNA with ionizable lipid', "two <br/>pDNA with ionizable\n lipid", "si<i>RNA"]
    rows = [(10 + 6 * n, "src", "en", t, len(t)) for n, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string, n_chars bigint")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["payload"]: r for r in payload_summary(spark, str(tmp_path)).collect()}
    assert {p: r["n_records"] for p, r in found.items()} == {"pDNA": 2, None: 1}
    assert found["pDNA"]["n_formulations"] == 1
