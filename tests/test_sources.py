import json

import pytest

from paperloom import schemas
from paperloom.operators.filters import allowed_sources, with_status
from paperloom.operators.fulltext import parse_documents, payload_text, resolve_fulltext, with_raw_hash
from paperloom.operators.ranking import first_wins, first_wins_wide
from paperloom.sources.mappers import (
    SOURCES,
    Source,
    discover,
    map_responses,
    rejected_responses,
)


def mapped(spark, source, *responses, **options):
    rows = [(n, json.dumps(r)) for n, r in enumerate(responses)]
    landed = spark.createDataFrame(rows, schemas.LANDED)
    out = map_responses(landed, SOURCES[source], **options).orderBy("ingest_seq").collect()
    return [r.asDict() for r in out]


def test_crossref_full_and_empty_item(spark):
    full = {
        "DOI": "10.1/a", "title": ["T", "sub"], "container-title": ["J"], "URL": "u", "abstract": "x",
        "published-print": {"date-parts": [[2024, 1]]},
    }
    rows = mapped(spark, "Crossref", {"message": {"items": [full, {}]}})
    assert rows[0] == {
        "source_name": "Crossref", "external_id": "10.1/a", "title": "T", "doi": "10.1/a", "pmid": None,
        "pmcid": None, "journal_or_site": "J", "publication_date": "2024", "source_url": "u",
        "abstract_text": "x", "ingest_seq": 0,
    }
    empty = rows[1]
    assert (empty["external_id"], empty["title"], empty["publication_date"]) == ("['']", "Unknown", "")
    assert (empty["journal_or_site"], empty["ingest_seq"]) == ("", 1)


def test_crossref_dates_and_title_ids(spark):
    items = [
        {"title": ["it's"], "published-online": {"date-parts": [[2001]]}},
        {"title": ['a "b"', "c"], "published-print": {"date-parts": [[None]]}},
        {"title": []},
    ]
    rows = mapped(spark, "Crossref", {"message": {"items": items}})
    assert [(r["external_id"], r["publication_date"]) for r in rows] == [
        ('["it\'s"]', "2001"), ("['a \"b\"', 'c']", "None"), ("[]", ""),
    ]


def test_europepmc(spark):
    items = [
        {"id": "1", "pmid": "2", "source": "PPR", "title": "", "pubYear": "2020"},
        {"id": "", "pmid": "2"},
        {"title": "no id"},
    ]
    rows = mapped(spark, "Europe PMC", {"resultList": {"result": items}}, {"resultList": {}}, {})
    assert [(r["external_id"], r["title"], r["publication_date"], r["source_url"]) for r in rows] == [
        ("1", "Unknown", "2020", "https://europepmc.org/article/PPR/1"),
        ("2", "Unknown", "", "https://europepmc.org/article/MED/2"),
    ]


@pytest.mark.parametrize("server", ["bioRxiv", "medRxiv"])
def test_preprints(spark, server):
    rows = mapped(spark, server, {"collection": [{"title": "T", "date": "2024-01-02"}, {"doi": ""}]})
    assert [(r["external_id"], r["journal_or_site"], r["source_url"]) for r in rows] == [
        ("T", server, f"https://www.{server.lower()}.org")
    ]


def test_openalex(spark):
    items = [
        {"id": "W1", "doi": "https://doi.org/10.1/a", "display_name": "T", "publication_year": 2020,
         "primary_location": {"source": {"display_name": "J"}}},
        {"id": "W2", "doi": "https://doi.org/", "primary_location": None},
    ]
    rows = mapped(spark, "OpenAlex", {"results": items})
    assert [(r["doi"], r["journal_or_site"], r["publication_date"]) for r in rows] == [
        ("10.1/a", "J", "2020"), (None, None, None),
    ]


def test_semantic_scholar(spark):
    items = [
        {"title": "T", "year": 2021, "url": "u", "externalIds": {"DOI": "d", "PubMed": "1", "PubMedCentral": "2"}},
        {"title": "T", "url": "u", "externalIds": None},
    ]
    rows = mapped(spark, "Semantic Scholar", {"data": items})
    assert [(r["external_id"], r["doi"], r["pmid"], r["pmcid"], r["publication_date"]) for r in rows] == [
        ("d", "d", "1", "2", "2021"), ("u", None, None, None, None),
    ]


def test_doaj(spark):
    items = [
        {"bibjson": {"title": "T", "identifier": [{"id": "i", "type": "issn"}, {"id": "d", "type": "doi"}],
                     "link": [{"url": "u"}, {"url": "v"}], "journal": {"title": "J"}, "year": "2020"}},
        {"bibjson": {"title": "T2", "identifier": [], "link": []}},
        {},
    ]
    rows = mapped(spark, "DOAJ", {"results": items})
    assert [(r["external_id"], r["doi"], r["source_url"], r["journal_or_site"]) for r in rows] == [
        ("d", "d", "u", "J"), ("T2", None, None, None),
    ]


def test_pubmed(spark):
    items = [
        {"pmid": "1", "elocationid": "doi: 10.1/a", "title": "T", "abstract": " text "},
        {"pmid": "2"},
        {"pmid": "3", "title": "", "elocationid": "pii: S0", "abstract": "<error>"},
    ]
    rows = mapped(spark, "PubMed", {"result": items})
    assert [(r["external_id"], r["doi"], r["title"], r["abstract_text"]) for r in rows] == [
        ("1", "10.1/a", "T", "text"), ("3", "pii: S0", "Unknown", None),
    ]
    assert rows[0]["source_url"] == "https://pubmed.ncbi.nlm.nih.gov/1/"


def test_all_items_of_a_response_are_used_unless_a_limit_is_given(spark):
    many = [{"doi": f"d{n}", "title": "t", "pmid": str(n)} for n in range(60)]
    assert len(mapped(spark, "bioRxiv", {"collection": many})) == 60
    assert len(mapped(spark, "bioRxiv", {"collection": many}, max_results=7)) == 7
    assert len(mapped(spark, "PubMed", {"result": many})) == 60
    assert len(mapped(spark, "PubMed", {"result": many}, max_results=0)) == 0


def test_unreadable_responses_are_reported(spark):
    good = json.dumps({"collection": [{"doi": "d", "title": "t"}]})
    texts = [good, good[:-3], "", None, "[1]", "{}", '{"collection": []}', "no json"]
    landed = spark.createDataFrame(list(enumerate(texts)), "response_seq bigint, response string")
    got = rejected_responses(landed, SOURCES["bioRxiv"]).orderBy("response_seq").collect()
    assert [(r["response_seq"], r["reason"], r["response"]) for r in got] == [
        (1, "malformed", good[:-3]), (2, "missing", ""), (3, "missing", None),
        (4, "malformed", "[1]"), (7, "malformed", "no json"),
    ]
    assert [r["external_id"] for r in map_responses(landed, SOURCES["bioRxiv"]).collect()] == ["d"]


def test_a_field_of_another_type_loses_no_item(spark):
    items = [
        {"id": "a", "publication_year": 2020},
        {"id": "b", "publication_year": "2021", "primary_location": {"source": 5}},
        {"id": "c", "primary_location": [1], "display_name": "C"},
        7,
        {"id": "d", "primary_location": {"source": {"display_name": "J"}}},
    ]
    rows = mapped(spark, "OpenAlex", {"results": items}, {"results": 5})
    assert [(r["external_id"], r["title"], r["publication_date"], r["journal_or_site"], r["ingest_seq"]) for r in rows] == [
        ("a", "Unknown", "2020", None, 0), ("b", "Unknown", "2021", None, 1), ("c", "C", None, None, 2),
        ("d", "Unknown", None, "J", 4),
    ]
    items = [{"DOI": "a", "title": "plain"}, {"DOI": "b", "title": ["T"], "published-print": {"date-parts": [["2021"]]}}]
    rows = mapped(spark, "Crossref", {"message": {"items": items}})
    assert [(r["external_id"], r["title"], r["publication_date"]) for r in rows] == [("a", "Unknown", ""), ("b", "T", "2021")]
    rows = mapped(spark, "Semantic Scholar", {"data": [{"url": "u", "year": "2021"}, {"url": "v", "externalIds": "x"}]})
    assert [(r["external_id"], r["publication_date"]) for r in rows] == [("u", "2021"), ("v", None)]
    texts = [json.dumps({"results": [{"id": "a"}, 7]}), '{"results": [{"id": "a"}, 7', '{"results": 5}']
    landed = spark.createDataFrame(list(enumerate(texts)), schemas.LANDED)
    assert sorted(r["response_seq"] for r in rejected_responses(landed, SOURCES["OpenAlex"]).collect()) == [1, 2]


def test_discovery_keeps_the_first_of_each_id_in_order_of_sources(spark):
    landed = {
        "medRxiv": [{"collection": [{"doi": "d", "title": "first"}]}, {"collection": [{"doi": "d", "title": "again"}]}],
        "bioRxiv": [{"collection": [{"doi": "d", "title": "other source"}]}],
    }
    frames = {
        name: spark.createDataFrame([(n, json.dumps(r)) for n, r in enumerate(rs)], schemas.LANDED)
        for name, rs in landed.items()
    }
    rows = discover(frames).orderBy("ingest_seq").collect()
    assert [(r["source_name"], r["title"], r["pipeline_status"]) for r in rows] == [
        ("medRxiv", "first", "DISCOVERED"), ("bioRxiv", "other source", "DISCOVERED"),
    ]


def test_own_source(spark):
    own = Source("Own", "STRUCT<rows: ARRAY<STRUCT<k: STRING>>>", "rows", lambda i: {"external_id": i["k"], "title": "t"})
    landed = spark.createDataFrame([(0, '{"rows": [{"k": "1"}]}')], schemas.LANDED)
    assert discover({"Own": landed}, sources={"Own": own}).first()["external_id"] == "1"


def test_sequence_overflow_is_an_error(spark):
    landed = spark.createDataFrame([(1 << 40, '{"collection": [{"doi": "d"}]}')], schemas.LANDED)
    with pytest.raises(Exception, match="too large"):
        map_responses(landed, SOURCES["bioRxiv"]).collect()


def test_allow_list_and_single_source(spark):
    registry = spark.createDataFrame([("PubMed",), ("DOAJ",), ("Elsewhere",)], "source string")
    assert sorted(r[0] for r in allowed_sources(registry).collect()) == ["DOAJ", "PubMed"]
    assert [r[0] for r in allowed_sources(registry, only="DOAJ").collect()] == ["DOAJ"]
    assert allowed_sources(registry, only="Elsewhere").count() == 0


def test_status_order_and_limit(spark):
    docs = spark.createDataFrame([(3, "X"), (1, "X"), (2, "Y")], "document_id int, pipeline_status string")
    assert [r[0] for r in with_status(docs, "X").collect()] == [1, 3]
    assert [r[0] for r in with_status(docs, "X", 1).collect()] == [1]
    assert [r[0] for r in with_status(docs, "X", 0).collect()] == [1, 3]


@pytest.mark.parametrize("hot_rows", [2, 10**6])
def test_full_text_resolution(spark, hot_rows):
    docs = spark.createDataFrame(
        [
            (1, "d1", "PMC1", "a1"),
            (2, "d2", None, "a2"),
            (3, None, None, "a3"),
            (4, "d4", "PMC9", "a4"),
            (5, "d5", "", "a5"),
            (6, "d6", None, None),
            (7, "", "PMC2", None),
        ],
        "document_id bigint, doi string, pmcid string, abstract_text string",
    )
    pmc = spark.createDataFrame([("PMC1", "<x>1</x>"), ("2", "")], schemas.PMC_FULLTEXT)
    locations = spark.createDataFrame(
        [("d1", ("p1", None)), ("d2", (None, "u2")), ("d4", ("", "u4")), ("d5", ("gone", "u5")), ("d6", None)],
        schemas.OA_LOCATIONS,
    )
    pages = spark.createDataFrame(
        [("p1", "never", 200), ("u2", "two", 200), ("u4", "four", 404)], schemas.OA_PAGES
    )
    out = resolve_fulltext(docs, pmc, locations, pages, hot_rows=hot_rows)
    got = {r["document_id"]: (r["fulltext"], r["content_type"], r["pipeline_status"]) for r in out.collect()}
    assert got == {
        1: ("<x>1</x>", "pmc_xml", "FETCHED"),
        2: ("two", "oa_landing_or_fulltext", "FETCHED"),
        3: (None, "abstract_only", "FETCHED"),
        4: (None, "oa_landing_or_fulltext", "FAILED"),
        5: (None, "oa_landing_or_fulltext", "FAILED"),
        6: (None, "abstract_only", "FETCHED"),
        7: (None, "abstract_only", "FETCHED"),
    }


def test_raw_hash_is_that_of_the_spaced_json(spark):
    import hashlib

    record = {"document_id": 1, "doi": "10.1/é", "pmcid": None, "abstract": 'q"\n', "fulltext": "<x/>", "content_type": "pmc_xml"}
    df = spark.createDataFrame([tuple(record.values())], schemas.PAYLOADS)
    text = json.dumps(record, ensure_ascii=False)
    assert df.select(payload_text(df)).first()[0] == text
    assert with_raw_hash(df).first()["raw_hash"] == hashlib.sha256(text.encode()).hexdigest()


def test_only_fetched_documents_are_parsed(spark):
    docs = spark.createDataFrame(
        [(1, "t", "d", "FETCHED"), (2, "t", "d", "FAILED")],
        "document_id bigint, title string, doi string, pipeline_status string",
    )
    raw = spark.createDataFrame([(1, "d", None, "Abstract x", None, "abstract_only"), (2, "d", None, "y", None, "z")], schemas.PAYLOADS)
    rows = parse_documents(docs, raw).collect()
    assert [(r["document_id"], r["abstract_or_body"], r["sections"]) for r in rows] == [
        (1, "Abstract x", {"abstract": "x"})
    ]


def small_corpus(spark, folder, rows=120):
    """A folder with documents of a few responses."""
    spark.range(rows).selectExpr(
        "id AS doc_id", "concat('Title ', id, '. Body ', id) AS text", "'en' AS lang",
        "concat('src', id % 3) AS source", "10L AS n_chars",
    ).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_all_sources_share_one_shuffle_of_the_texts(spark, tmp_path):
    from paperloom.plans import catalog_sources as catalog

    found = catalog.discover_union(spark, small_corpus(spark, tmp_path))
    rows = found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= len(catalog.RESPONSES) - 1
    pubmed = {r["external_id"]: r for r in rows if r["source_name"] == "PubMed"}
    assert len(pubmed) == 120 and pubmed["7"]["title"] == "Title 7"
    assert pubmed["7"]["abstract_text"] == "Title 7. Body 7"


def test_names_in_quotes_stay(spark):
    from paperloom.plans.catalog_sources import _of_element

    made = _of_element("named_struct('doi', concat('https://doi.org/', doi), 'x', body)")
    assert made == "named_struct('doi', concat('https://doi.org/', d.doi), 'x', concat(d.head, d.text))"


def _shuffled_bytes(df):
    """Bytes that the shuffles of a query write, from the plan after it has run."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), 0
    stack = [plan]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            stack.append(node.executedPlan())
        elif "QueryStage" in name:
            stack.append(node.plan())
        else:
            if name == "Exchange":
                found += node.metrics().apply("shuffleBytesWritten").value()
            stack += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_first_wins_wide_shuffles_only_what_comes_again(spark):
    """Texts of keys that come once stay where they are."""
    text = "concat_ws(' ', transform(sequence(1, 200), x -> sha1(concat(id, '-', x))))"
    df = spark.range(400).selectExpr(
        "if(id < 380, id, 380 + id % 5) AS k", "if(id % 2 = 0, NULL, 's') AS s", "id AS seq", f"{text} AS t"
    )
    rows = [sorted(map(tuple, f(df, ["k", "s"], "seq").collect()), key=repr) for f in (first_wins, first_wins_wide)]
    assert rows[0] == rows[1] and len(rows[1]) == 390
    whole, sparing = (_shuffled_bytes(f(df, ["k", "s"], "seq")) for f in (first_wins, first_wins_wide))
    assert sparing < whole / 5


def test_first_wins_wide_with_nulls_copies_and_nothing(spark):
    rows = [(None, 3, "c"), (None, 1, "a"), ("x", 2, "b"), ("y", 5, "e"), ("y", 5, "e")]
    for some in (rows, []):
        df = spark.createDataFrame(some, "k string, seq int, t string")
        plain, wide = (sorted(map(tuple, f(df, ["k"], "seq").collect()), key=repr) for f in (first_wins, first_wins_wide))
        assert wide == plain and len(wide) == (3 if some else 0)


def test_discover_shuffles_few_whole_documents(spark):
    items = [{"doi": str(n), "title": "T", "abstract": "".join(map(chr, range(65, 91))) * 9 + str(n)} for n in range(300)]
    again = [{"doi": "7", "title": "later"}, {"doi": "300", "title": "new"}]
    rows = [(n, json.dumps({"collection": part})) for n, part in enumerate((items, again))]
    found = discover({"bioRxiv": spark.createDataFrame(rows, schemas.LANDED)})
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
    titles = {r["external_id"]: r["title"] for r in found.collect()}
    assert len(titles) == 301 and (titles["7"], titles["300"]) == ("T", "new")
