"""Attach landed full text to documents and build raw payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.exprs import first_present, json_object, present
from paperloom.functions.html import combined_text
from paperloom.functions.identifiers import pmc_number
from paperloom.functions.text import split_sections
from paperloom.operators.joins import HOT_ROWS, spread_left_join

PAYLOAD_FIELDS = ["document_id", "doi", "pmcid", "abstract", "fulltext", "content_type"]


def open_access_url(best_location: Column) -> Column:
    return first_present(best_location["url_for_pdf"], best_location["url"])


def resolve_fulltext(
    docs: DataFrame,
    pmc: DataFrame,
    locations: DataFrame,
    pages: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Full text by PMC id, else by the open-access location of the DOI, else none.

    ``docs``: document_id, doi, pmcid, abstract_text; ``pmc``: pmcid, xml;
    ``locations``: doi, best_oa_location; ``pages``: url, body, status. The three landed
    tables have one row per key. A location whose page is missing or has an error status
    makes the document FAILED.

    Most documents lack a PMC id or a DOI; the joins deal those rows over all tasks.
    """
    docs = docs.select(
        "document_id",
        "doi",
        "pmcid",
        F.col("abstract_text").alias("abstract"),
        present(pmc_number(present(F.col("pmcid")))).alias("_pmc"),
        present(F.col("doi")).alias("_doi"),
    )
    by_number = pmc.select(
        pmc_number(F.col("pmcid")).alias("_pmc"), present(F.col("xml")).alias("_xml")
    )
    places = locations.select(
        F.col("doi").alias("_doi"), open_access_url(F.col("best_oa_location")).alias("_url")
    )
    by_url = pages.select(
        F.col("url").alias("_url"), F.col("body").alias("_body"), F.col("status").alias("_http")
    )
    # Keys are counted on the narrow inputs, so that no count repeats a join.
    row = F.col("document_id")
    by_doi = spread_left_join(places, by_url, "_url", F.col("_doi"), hot_rows=hot_rows)
    found = spread_left_join(
        docs, by_number, "_pmc", row, key_counts=_counts(docs, "_pmc"), hot_rows=hot_rows
    )
    found = spread_left_join(
        found, by_doi, "_doi", row, key_counts=_counts(docs, "_doi"), hot_rows=hot_rows
    )
    from_page = F.col("_xml").isNull() & F.col("_url").isNotNull()
    failed = from_page & (F.col("_http").isNull() | (F.col("_http") >= 400))
    return found.select(
        "document_id",
        "doi",
        "pmcid",
        "abstract",
        F.coalesce(F.col("_xml"), F.when(~failed, F.col("_body"))).alias("fulltext"),
        F.when(F.col("_xml").isNotNull(), "pmc_xml")
        .when(from_page, "oa_landing_or_fulltext")
        .otherwise("abstract_only")
        .alias("content_type"),
        F.when(failed, "FAILED").otherwise("FETCHED").alias("pipeline_status"),
    )


def _counts(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n_rows"))


def payload_text(df: DataFrame) -> Column:
    """Serialized payload of a row, the text its hash is taken of."""
    return json_object({c: F.col(c) for c in PAYLOAD_FIELDS})


def with_raw_hash(payloads: DataFrame) -> DataFrame:
    return payloads.withColumn("raw_hash", F.sha2(payload_text(payloads), 256))


def parse_documents(docs: DataFrame, payloads: DataFrame) -> DataFrame:
    """FETCHED documents with their cleaned text and sections."""
    fetched = docs.where(F.col("pipeline_status") == "FETCHED").select(
        "document_id", "title", "doi"
    )
    raw = payloads.select("document_id", "abstract", "fulltext")
    return parse_payloads(fetched.join(raw, "document_id")).select(
        "document_id", "title", "doi", "abstract_or_body", "sections"
    )


def parse_payloads(payloads: DataFrame) -> DataFrame:
    """Add ``abstract_or_body`` and ``sections`` to rows with ``abstract`` and ``fulltext``."""
    text = combined_text(F.col("abstract"), F.col("fulltext"))
    return payloads.withColumn("abstract_or_body", text).withColumn(
        "sections", split_sections(F.col("abstract_or_body"))
    )
