"""Queries over landed responses: registry scan, mappers, discovery, full text."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.identifiers import clean_doi
from paperloom.operators.fulltext import resolve_fulltext, with_raw_hash
from paperloom.plans.catalog import SQL_DOCUMENTS, corpus, corpus_documents, query, table
from paperloom.session import scratch_path
from paperloom.sources.files import read_registry, write_registry
from paperloom.sources.mappers import (
    COMMON_COLUMNS,
    SOURCES,
    discover,
    map_responses,
    rejected_responses,
)

OUT = ", ".join([*COMMON_COLUMNS, "ingest_seq"])
RANK_STEP = 1 << 56

# JSON responses of each source made from the corpus: what stands around the items, and the
# items. Where there are two, the second has most fields left out.
RESPONSES = {
    "PubMed": ('{"result":[', "]}", """named_struct('pmid', cast(doc_id AS string), 'elocationid',
        raw_doi, 'title', title, 'fulljournalname', source_name, 'pubdate', '2024 May',
        'abstract', text)""", """named_struct('pmid', concat('x', doc_id))"""),
    "Europe PMC": ('{"resultList":{"result":[', "]}}", """named_struct('id', external_id, 'pmid',
        cast(doc_id AS string), 'doi', doi, 'pmcid', concat('PMC', doc_id), 'source',
        if(doc_id % 2 = 0, 'PPR', NULL), 'title', title, 'journalTitle', source_name, 'pubYear',
        '2021', 'abstractText', body)""", """named_struct('doi', doi, 'title', title)"""),
    "bioRxiv": ('{"collection":[', "]}", """named_struct('doi', doi, 'title', title, 'date',
        '2023-04-05', 'abstract', body)""", """named_struct('title', title)"""),
    "medRxiv": ('{"collection":[', "]}", """named_struct('doi', doi, 'title', title, 'date',
        '2023-04-05', 'abstract', body)"""),
    "Crossref": ('{"message":{"items":[', "]}}", """named_struct('DOI', doi, 'title',
        array(title, 'Subtitle'), 'container-title', array(source_name), 'URL',
        concat('http://x/', doc_id), 'abstract', body, 'published-print', if(doc_id % 3 = 0, NULL,
          named_struct('date-parts', array(array(2001, 5)))),
        'published-online', named_struct('date-parts', array(array(2002))))""",
        """named_struct('DOI', if(doc_id % 2 = 0, doi, NULL))"""),
    "OpenAlex": ('{"results":[', "]}", """named_struct('id',
        concat('https://openalex.org/W', doc_id), 'doi', concat('https://doi.org/', doi),
        'display_name', title, 'publication_year', 2019, 'primary_location',
        named_struct('source', named_struct('display_name', source_name)))""",
        """named_struct('doi', concat('https://doi.org/', doi))"""),
    "Semantic Scholar": ('{"data":[', "]}", """named_struct('title', title, 'abstract', body,
        'year', 2018, 'venue', source_name, 'url', concat('http://x/', doc_id), 'externalIds',
        named_struct('DOI', doi, 'PubMed', cast(doc_id AS string), 'PubMedCentral',
          concat('PMC', doc_id)))""", """named_struct('title', title)"""),
    "DOAJ": ('{"results":[', "]}", """named_struct('bibjson', named_struct('title', title, 'year',
        '2017', 'abstract', body, 'identifier', array(named_struct('id', '1234-5678', 'type',
          'eissn'), named_struct('id', doi, 'type', 'doi')), 'journal',
        named_struct('title', source_name), 'link',
        array(named_struct('url', concat('http://x/', doc_id)))))""",
        """named_struct('bibjson', named_struct('title', title))"""),
}

DOCS_PER_RESPONSE = 50
SQL_BASE = f"""
SELECT c.*, d.doi, 'http://x/' || c.doc_id AS url, CAST(c.doc_id AS VARCHAR) AS num,
  c.doc_id // {DOCS_PER_RESPONSE} AS response_seq,
  row_number() OVER (PARTITION BY c.doc_id // {DOCS_PER_RESPONSE} ORDER BY c.doc_id) - 1 AS place
FROM corpus c JOIN ({SQL_DOCUMENTS}) d ON c.doc_id = d.document_id
"""
KNOWN = "coalesce(nullif(title, ''), 'Unknown')"
NONE = "CAST(NULL AS VARCHAR)"


def _item(pos: int, source: str, uid: str, title: str, *rest: str) -> str:
    names = ["doi", "pmid", "pmcid", "journal_or_site", "publication_date", "source_url", "abstract_text"]
    fields = ", ".join(f"{v} AS {n}" for n, v in zip(names, rest, strict=True))
    return (
        f"SELECT '{source}' AS source_name, {uid} AS external_id, {title} AS title, {fields}, "
        f"response_seq * 1048576 + place * {len(RESPONSES[source]) - 2} + {pos} AS ingest_seq "
        f"FROM base WHERE nullif({uid}, '') IS NOT NULL"
    )


SQL_GUARDED = (
    "CASE WHEN trim(text) <> '' AND NOT starts_with(trim(text), '<') "
    "AND NOT contains(upper(substr(trim(text), 1, 200)), 'ERROR') THEN trim(text) END"
)
TITLE_LIST_ID = (
    "'[' || CASE WHEN contains(t0, '''') AND NOT contains(t0, '\"') THEN '\"' || t0 || '\"' "
    "ELSE '''' || replace(t0, '''', '\\''') || '''' END || ', ''Subtitle'']'"
).replace(
    "t0", "replace(replace(replace(replace(title, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"
)
MAPPED_SQL = {
    "PubMed": _item(
        0, "PubMed", "num", KNOWN, "doi", "num", NONE, "source_name", "'2024 May'",
        "'https://pubmed.ncbi.nlm.nih.gov/' || num || '/'", SQL_GUARDED,
    ),
    "Europe PMC": _item(
        0, "Europe PMC", "external_id", KNOWN, "doi", "num", "'PMC' || num", "source_name", "'2021'",
        "'https://europepmc.org/article/' || CASE WHEN doc_id % 2 = 0 THEN 'PPR' ELSE 'MED' END "
        "|| '/' || external_id", "body",
    ) + " UNION ALL " + _item(
        1, "Europe PMC", "doi", KNOWN, "doi", NONE, NONE, NONE, "''",
        "'https://europepmc.org/article/MED/' || doi", NONE,
    ),
    "bioRxiv": _item(
        0, "bioRxiv", "coalesce(nullif(doi, ''), title)", KNOWN, "doi", NONE, NONE, "'bioRxiv'",
        "'2023-04-05'", "'https://www.biorxiv.org'", "body",
    ) + " UNION ALL " + _item(
        1, "bioRxiv", "title", KNOWN, NONE, NONE, NONE, "'bioRxiv'", NONE,
        "'https://www.biorxiv.org'", NONE,
    ),
    "medRxiv": _item(
        0, "medRxiv", "coalesce(nullif(doi, ''), title)", KNOWN, "doi", NONE, NONE, "'medRxiv'",
        "'2023-04-05'", "'https://www.medrxiv.org'", "body",
    ),
    "Crossref": _item(
        0, "Crossref", f"coalesce(nullif(doi, ''), {TITLE_LIST_ID})", "title", "doi", NONE, NONE,
        "source_name", "CASE WHEN doc_id % 3 = 0 THEN '2002' ELSE '2001' END", "url", "body",
    ) + " UNION ALL " + _item(
        1, "Crossref", "coalesce(CASE WHEN doc_id % 2 = 0 THEN nullif(doi, '') END, '['''']')",
        "'Unknown'", "CASE WHEN doc_id % 2 = 0 THEN doi END", NONE, NONE, "''", "''", NONE, NONE,
    ),
    "OpenAlex": _item(
        0, "OpenAlex", "'https://openalex.org/W' || num", KNOWN, "nullif(doi, '')", NONE, NONE,
        "source_name", "'2019'", "'https://openalex.org/W' || num", NONE,
    ) + " UNION ALL " + _item(
        1, "OpenAlex", "'https://doi.org/' || doi", "'Unknown'", "nullif(doi, '')", NONE, NONE, NONE,
        NONE, NONE, NONE,
    ),
    "Semantic Scholar": _item(
        0, "Semantic Scholar", "coalesce(nullif(doi, ''), url)", KNOWN, "doi", "num", "'PMC' || num",
        "source_name", "'2018'", "url", "body",
    ) + " UNION ALL " + _item(
        1, "Semantic Scholar", "title", KNOWN, NONE, NONE, NONE, NONE, NONE, NONE, NONE,
    ),
    "DOAJ": _item(
        0, "DOAJ", "coalesce(nullif(doi, ''), title)", KNOWN, "doi", NONE, NONE, "source_name",
        "'2017'", "url", "body",
    ) + " UNION ALL " + _item(
        1, "DOAJ", "title", KNOWN, NONE, NONE, NONE, NONE, NONE, NONE, NONE,
    ),
}


# What the items are made of; the body of a document is its ``head`` and its text.
ITEM_FIELDS = "doc_id source_name external_id raw_doi doi title body text".split()


def _of_element(item: str) -> str:
    """An item's expression on the fields of a lambda variable ``d``; quoted parts stay."""
    names = re.compile(rf"\b({'|'.join(ITEM_FIELDS)})\b")
    parts = item.split("'")
    parts[::2] = [names.sub(r"d.\1", code) for code in parts[::2]]
    return "'".join(parts).replace("d.body", "concat(d.head, d.text)")


def response_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of each response, from which those of any source are made.

    All sources together need one shuffle of the texts: a plan that takes several of them reuses
    it, since it does not depend on the source.
    """
    base = corpus(spark, sf_dir).withColumn("doi", clean_doi(F.col("raw_doi")))
    head = F.expr("left(body, length(body) - length(text))").alias("head")
    document = F.struct(*[head if c == "body" else F.col(c) for c in ITEM_FIELDS])
    return base.groupBy(F.floor(F.col("doc_id") / DOCS_PER_RESPONSE).alias("response_seq")).agg(
        F.collect_list(document).alias("docs")
    )


def landed_responses(
    spark: SparkSession, sf_dir: str, source: str, documents: DataFrame | None = None
) -> DataFrame:
    """Responses of many items each, and for some a second one that was cut off or is empty.

    ``documents`` are those of ``response_documents``, if they are at hand.
    """
    documents = response_documents(spark, sf_dir) if documents is None else documents
    before, after, *items = RESPONSES[source]
    texts = ", ".join(f"to_json({_of_element(item)})" for item in items)
    per_document = f"transform(docs, d -> struct(d.doc_id, concat_ws(',', {texts}) AS items))"
    listed = F.array_join(
        F.transform(F.sort_array(F.expr(per_document)), lambda x: x["items"]), ","
    )
    whole = documents.select(
        "response_seq", F.concat(F.lit(before), listed, F.lit(after)).alias("response")
    )
    # The last columns of each copy: added to its place in the order of arrival, and its text.
    copies = F.array(
        F.struct(F.lit(0).alias("later"), F.col("response").alias("text")),
        F.struct(
            F.lit(CUT_OFF).alias("later"),
            F.when(F.col("response_seq") % 3 == 0, F.left("response", F.lit(40)))
            .when(F.col("response_seq") % 3 == 1, F.lit(" "))
            .alias("text"),
        ),
    )
    return whole.select("response_seq", F.explode(copies).alias("copy")).select(
        (F.col("response_seq") + F.col("copy.later")).alias("response_seq"),
        F.col("copy.text").alias("response"),
    )


CUT_OFF = 1 << 30  # added to the place of a response that cannot be read


def _register_mapper(key: str, *sources: str) -> None:
    sql = " UNION ALL ".join(MAPPED_SQL[s] for s in sources)

    @query(key, f", base AS ({SQL_BASE}) SELECT {OUT} FROM ({sql})")
    def mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        parts = [map_responses(landed_responses(spark, sf_dir, s), SOURCES[s]) for s in sources]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


_register_mapper("map_pubmed", "PubMed")
_register_mapper("map_europepmc", "Europe PMC")
_register_mapper("map_preprint", "bioRxiv", "medRxiv")
_register_mapper("map_crossref", "Crossref")
_register_mapper("map_openalex", "OpenAlex")
_register_mapper("map_s2", "Semantic Scholar")
_register_mapper("map_doaj", "DOAJ")

@query(
    "map_rejects",
    f", base AS ({SQL_BASE}) SELECT source_name, reason, count(*) AS n_responses FROM ("
    + " UNION ALL ".join(
        f"SELECT DISTINCT '{name}' AS source_name, response_seq, "
        "CASE WHEN response_seq % 3 = 0 THEN 'malformed' ELSE 'missing' END AS reason FROM base"
        for name in RESPONSES
    )
    + ") GROUP BY source_name, reason",
)
def map_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of each source that cannot be read, by reason."""
    parts = [
        rejected_responses(landed_responses(spark, sf_dir, name), SOURCES[name])
        for name in RESPONSES
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("source_name", "reason")
        .agg(F.count("*").alias("n_responses"))
    )


SQL_ALL_MAPPED = " UNION ALL ".join(
    f"SELECT * REPLACE (ingest_seq + {rank * RANK_STEP} AS ingest_seq) FROM ({MAPPED_SQL[name]})"
    for rank, name in enumerate(RESPONSES)
)


@query(
    "discover_union",
    f", base AS ({SQL_BASE}) SELECT {OUT}, 'DISCOVERED' AS pipeline_status FROM ("
    "SELECT *, row_number() OVER (PARTITION BY source_name, external_id ORDER BY ingest_seq) AS rn "
    f"FROM ({SQL_ALL_MAPPED})) WHERE rn = 1",
)
def discover_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover({name: landed_responses(spark, sf_dir, name) for name in RESPONSES})


@query(
    "src_registry",
    "SELECT source, 'http://' || source AS homepage, 'http://' || source || '/api' AS api_url, "
    "count(*) % 2 = 0 AS supports_discovery, false AS crawled, CAST(NULL AS VARCHAR) AS last_crawled_at, "
    "count(*) AS new_entries_from_last_crawl FROM documents GROUP BY source",
)
def src_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry of all sources, written by the writer and read by the reader."""
    per_source = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    registry = per_source.select(
        "source",
        F.concat(F.lit("http://"), "source").alias("homepage"),
        F.concat(F.lit("http://"), "source", F.lit("/api")).alias("api_url"),
        (F.col("n") % 2 == 0).alias("supports_discovery"),
        F.lit(False).alias("crawled"),
        F.lit(None).cast("string").alias("last_crawled_at"),
        F.col("n").alias("new_entries_from_last_crawl"),
    )
    path = scratch_path(spark, "registry")
    write_registry(registry, path)
    return read_registry(spark, path)


SQL_JSON = "coalesce(CAST(to_json({0}) AS VARCHAR), 'null')"
SQL_PAYLOADS = f"""
SELECT document_id, doi, pmcid, abstract_text AS abstract, CAST(NULL AS VARCHAR) AS fulltext,
  'abstract_only' AS content_type FROM ({SQL_DOCUMENTS})
"""


@query(
    "raw_hash",
    "SELECT document_id, sha256('{\"document_id\": ' || document_id || ', \"doi\": ' || "
    f"{SQL_JSON.format('doi')} || ', \"pmcid\": ' || {SQL_JSON.format('pmcid')} || ', \"abstract\": ' || "
    f"{SQL_JSON.format('abstract')} || ', \"fulltext\": null, \"content_type\": \"abstract_only\"}}') "
    f"AS raw_hash FROM ({SQL_PAYLOADS})",
)
def raw_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = corpus_documents(spark, sf_dir).select(
        "document_id",
        "doi",
        "pmcid",
        F.col("abstract_text").alias("abstract"),
        F.lit(None).cast("string").alias("fulltext"),
        F.lit("abstract_only").alias("content_type"),
    )
    return with_raw_hash(payloads).select("document_id", "raw_hash")


@query(
    "fetch_resolve",
    f"""
, docs AS ({SQL_DOCUMENTS}),
pmc AS (SELECT doc_id AS n, '<x>' || text || '</x>' AS xml FROM corpus
        WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
places AS (SELECT min(doc_id) AS owner, doi, 'http://x/' || min(doc_id) AS url,
             CASE WHEN min(doc_id) IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 404
               ELSE 200 END AS status
           FROM (SELECT document_id AS doc_id, doi FROM docs WHERE doi IS NOT NULL)
           GROUP BY doi),
found AS (
  SELECT d.document_id, d.doi, d.pmcid, d.abstract_text AS abstract, p.xml, o.url, o.status, c.text
  FROM docs d LEFT JOIN pmc p ON d.pmcid = 'PMC' || p.n
  LEFT JOIN places o ON p.xml IS NULL AND d.doi = o.doi LEFT JOIN corpus c ON c.doc_id = o.owner)
SELECT document_id, doi, pmcid, abstract,
  coalesce(xml, CASE WHEN status < 400 THEN text END) AS fulltext,
  CASE WHEN xml IS NOT NULL THEN 'pmc_xml' WHEN url IS NOT NULL THEN 'oa_landing_or_fulltext'
    ELSE 'abstract_only' END AS content_type,
  CASE WHEN status >= 400 THEN 'FAILED' ELSE 'FETCHED' END AS pipeline_status
FROM found""",
)
def fetch_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of good quality have PMC full text; toxic ones lead to a missing page."""
    docs = corpus_documents(spark, sf_dir)
    texts = corpus(spark, sf_dir).select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    pmc = texts.join(labels.where(F.col("quality") == 1), "doc_id", "left_semi").select(
        F.col("doc_id").cast("string").alias("pmcid"),
        F.concat(F.lit("<x>"), "text", F.lit("</x>")).alias("xml"),
    )
    missing = labels.where(F.col("toxic") == 1).select("doc_id", F.lit(404).alias("status"))
    owners = (
        docs.where(F.col("doi").isNotNull())
        .groupBy("doi")
        .agg(F.min("document_id").alias("doc_id"))
        .join(missing, "doc_id", "left")
        .withColumn("status", F.coalesce("status", F.lit(200)))
        .withColumn("url", F.concat(F.lit("http://x/"), "doc_id"))
    )
    no_url = F.lit(None).cast("string")
    in_pdf = F.col("doc_id") % 2 == 0
    locations = owners.select(
        "doi",
        F.struct(
            F.when(in_pdf, F.col("url")).otherwise(no_url).alias("url_for_pdf"),
            F.when(in_pdf, F.lit("http://other")).otherwise(F.col("url")).alias("url"),
        ).alias("best_oa_location"),
    )
    pages = owners.join(texts, "doc_id").select("url", F.col("text").alias("body"), "status")
    return resolve_fulltext(docs, pmc, locations, pages)
