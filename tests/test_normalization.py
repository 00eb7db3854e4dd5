import json

from pyspark.sql import functions as F

from paperloom.functions import identifiers as ids
from paperloom.functions.normalization import canonicalize, normalize_lipids, normalize_records


def test_aliases(value):
    got = value(
        canonicalize,
        ["Cationic Lipid", "peg lipid", " chol ", "IV.", "DSPC.", "pegylated lipid", "sc", None],
    )
    assert got == [
        "ionizable lipid", "PEG-lipid", "cholesterol", "intravenous", "DSPC.", "PEG-lipid",
        "subcutaneous", "",
    ]


def test_lists_are_distinct_after_mapping(value):
    got = value(normalize_lipids, [["DSPC", "chol", "peg lipid", "PEG-lipid", "", None]], "array<string>")
    assert got == [["DSPC", "cholesterol", "PEG-lipid"]]


def test_records(spark):
    rows = [
        ("{bad json", "SC."),
        ('["chol", "peg lipid"]', "oral"),
        ("[]", ""),
        (None, None),
        ('{"a": 1}', "IM"),
        ("", None),
    ]
    df = spark.createDataFrame(rows, "lipid_reagents_json string, administration_route string")
    got = [tuple(r) for r in normalize_records(df.coalesce(1)).collect()]
    assert got == [
        ("{bad json", "subcutaneous"),
        ('["cholesterol", "PEG-lipid"]', "oral"),
        ("[]", ""),
        (None, None),
        ('{"a": 1}', "intramuscular"),
        ("", None),
    ]
    assert json.loads(got[1][0]) == ["cholesterol", "PEG-lipid"]


def test_clean_doi(value):
    raw = [" https://DOI.org/10.1/A ", "doi:  10.1/b", "pii: S0", "", None, "10.1/c"]
    assert value(ids.clean_doi, raw) == ["10.1/A", "10.1/b", "pii: S0", None, None, "10.1/c"]
    strict = value(lambda c: ids.clean_doi(c, require_prefix=True), raw)
    assert strict == ["10.1/A", "10.1/b", None, None, None, "10.1/c"]


def test_guarded_abstract(value):
    long = "x" * 200 + " error"
    got = value(ids.guarded_abstract, ["<x>", "some error text", " ok ", "  ", None, long])
    assert got == [None, None, "ok", None, None, long]


def test_years_and_pmc(value):
    assert value(ids.publication_year, ["2024 May", "12 Jan 1999", "", None]) == [2024, 1999, None, None]
    assert value(ids.pmc_number, ["PMC12", "34"]) == ["12", "34"]


def test_search_queries(spark):
    df = spark.createDataFrame(
        [(["lipid nanoparticle", "LNP", "x+y"], ["mRNA delivery", "siRNA", "PEG"])],
        "p array<string>, s array<string>",
    )
    row = df.select(
        ids.search_queries(F.col("p"), F.col("s"), style="fielded").alias("fielded"),
        ids.search_queries(F.col("p"), F.col("s")).alias("generic"),
        ids.search_queries(F.col("p"), F.col("s"), max_queries=9).alias("all"),
    ).first()
    assert row["fielded"][0] == "lipid nanoparticle[TitleAbstract] AND mRNA delivery[TitleAbstract]"
    assert len(row["fielded"]) == 5 and not any("PEG" in q for q in row["fielded"])
    assert row["generic"] == [
        "lipid+nanoparticle mRNA+delivery", "lipid+nanoparticle siRNA", "lipid+nanoparticle PEG",
        "LNP mRNA+delivery", "LNP siRNA",
    ]
    assert row["all"][6] == "x%2By mRNA+delivery"


def test_only_whole_json_arrays_are_rewritten(value):
    from paperloom.functions.normalization import normalize_lipids_json

    cases = {
        '["chol"] junk': '["chol"] junk',
        '["chol"': '["chol"',
        ' [ "chol" , "DSPC" ] ': '["cholesterol", "DSPC"]',
        '["Å chol", "a\\u00E9\\\\u00E9"]': '["\\u00c5 chol", "a\\u00e9\\\\u00E9"]',
        "[]": "[]",
    }
    assert value(normalize_lipids_json, list(cases)) == list(cases.values())
