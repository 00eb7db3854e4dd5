"""Schemas of tables and landed data. Nothing is inferred."""

SOURCES = (
    "source_id INT, name STRING, homepage STRING, api_url STRING, active BOOLEAN, "
    "last_crawled_at TIMESTAMP"
)
CRAWL_RUNS = (
    "run_id BIGINT, source_id INT, started_at TIMESTAMP, finished_at TIMESTAMP, status STRING, "
    "discovered_count BIGINT, fetched_count BIGINT, inserted_count BIGINT, error_message STRING"
)
DOCUMENTS = (
    "document_id BIGINT, source_name STRING, external_id STRING, doi STRING, pmid STRING, "
    "pmcid STRING, journal_or_site STRING, publication_date STRING, source_url STRING, "
    "abstract_text STRING, full_text_path STRING, raw_hash STRING, title STRING, "
    "pipeline_status STRING, value_seq MAP<STRING, BIGINT>"
)
RECORDS = (
    "document_id BIGINT, lipid_mix_text STRING, lipid_reagents ARRAY<STRING>, "
    "lipid_reagents_json STRING, lipid_ratios_text STRING, lipid_ratios_json STRING, "
    "cells_or_organisms STRING, payload STRING, administration_route STRING, "
    "other_relevant_info STRING, evidence_span STRING, extraction_confidence DOUBLE, "
    "reviewer_status STRING, batch_id BIGINT, created_at TIMESTAMP, updated_at TIMESTAMP"
)
PAYLOADS = (
    "document_id BIGINT, doi STRING, pmcid STRING, abstract STRING, fulltext STRING, "
    "content_type STRING"
)
STORED_PAYLOADS = f"{PAYLOADS}, raw_hash STRING"
DISCOVERED = (
    "source_name STRING, external_id STRING, title STRING, doi STRING, pmid STRING, "
    "pmcid STRING, journal_or_site STRING, publication_date STRING, source_url STRING, "
    "abstract_text STRING, ingest_seq BIGINT"
)
REGISTRY = (
    "source STRING, homepage STRING, api_url STRING, supports_discovery BOOLEAN, "
    "crawled BOOLEAN, last_crawled_at STRING, new_entries_from_last_crawl BIGINT"
)

# One landed response of a source: its place in the order of arrival and its JSON text.
LANDED = "response_seq BIGINT, response STRING"

PMC_FULLTEXT = "pmcid STRING, xml STRING"
OA_LOCATIONS = "doi STRING, best_oa_location STRUCT<url_for_pdf: STRING, url: STRING>"
OA_PAGES = "url STRING, body STRING, status INT"

PUBMED_RESPONSE = (
    "STRUCT<result: ARRAY<STRUCT<pmid: STRING, elocationid: STRING, title: STRING, "
    "fulljournalname: STRING, pubdate: STRING, abstract: STRING>>>"
)
EUROPEPMC_RESPONSE = (
    "STRUCT<resultList: STRUCT<result: ARRAY<STRUCT<id: STRING, pmid: STRING, doi: STRING, "
    "pmcid: STRING, source: STRING, title: STRING, journalTitle: STRING, pubYear: STRING, "
    "abstractText: STRING>>>>"
)
PREPRINT_RESPONSE = (
    "STRUCT<collection: ARRAY<STRUCT<doi: STRING, title: STRING, date: STRING, "
    "abstract: STRING>>>"
)
CROSSREF_RESPONSE = (
    "STRUCT<message: STRUCT<items: ARRAY<STRUCT<DOI: STRING, title: ARRAY<STRING>, "
    "`container-title`: ARRAY<STRING>, URL: STRING, abstract: STRING, "
    "`published-print`: STRUCT<`date-parts`: ARRAY<ARRAY<STRING>>>, "
    "`published-online`: STRUCT<`date-parts`: ARRAY<ARRAY<STRING>>>>>>>"
)
OPENALEX_RESPONSE = (
    "STRUCT<results: ARRAY<STRUCT<id: STRING, doi: STRING, display_name: STRING, "
    "publication_year: STRING, primary_location: STRUCT<source: STRUCT<display_name: STRING>>>>>"
)
SEMANTIC_SCHOLAR_RESPONSE = (
    "STRUCT<data: ARRAY<STRUCT<title: STRING, abstract: STRING, year: STRING, venue: STRING, "
    "url: STRING, externalIds: STRUCT<DOI: STRING, PubMed: STRING, PubMedCentral: STRING>>>>"
)
DOAJ_RESPONSE = (
    "STRUCT<results: ARRAY<STRUCT<bibjson: STRUCT<title: STRING, year: STRING, "
    "abstract: STRING, identifier: ARRAY<STRUCT<id: STRING, type: STRING>>, "
    "journal: STRUCT<title: STRING>, link: ARRAY<STRUCT<url: STRING>>>>>>"
)
