"""The stages from documents to records as one lazy chain of DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.extraction import extract_all
from paperloom.functions.normalization import normalize_records
from paperloom.functions.vocab import DEFAULT_VOCABULARY, Vocabulary
from paperloom.operators.dedup import deduplicate, kept_records
from paperloom.operators.filters import confident
from paperloom.operators.fulltext import parse_documents
from paperloom.session import written


def extract_records(
    parsed: DataFrame,
    vocab: Vocabulary = DEFAULT_VOCABULARY,
    min_confidence: float | None = None,
    whole_words: bool = False,
    parse_ratios: bool = False,
) -> DataFrame:
    """Extract and normalize the fields of parsed documents."""
    extracted = extract_all(parsed, "abstract_or_body", vocab, whole_words, parse_ratios)
    return confident(normalize_records(extracted, vocab), min_confidence)


def documents_to_records(
    docs: DataFrame,
    payloads: DataFrame,
    vocab: Vocabulary = DEFAULT_VOCABULARY,
    min_confidence: float | None = None,
) -> DataFrame:
    """Records of all FETCHED documents without duplicates, in no particular order.

    A threshold on confidence comes first, so weak records block nobody; then records are
    written once and deduplicated. Without one, duplicates are found on ids, DOIs and titles
    alone, before any text is extracted.
    """
    if min_confidence is not None:
        confident_ones = extract_records(parse_documents(docs, payloads), vocab, min_confidence)
        return deduplicate(written(confident_ones, "records"), "document_id")
    fetched = docs.where(F.col("pipeline_status") == "FETCHED").join(
        payloads.select("document_id"), "document_id", "left_semi"
    )
    kept = kept_records(fetched.select("document_id", "doi", "title"), "document_id")
    chosen = docs.join(kept.withColumnRenamed("seq", "document_id"), "document_id", "left_semi")
    return extract_records(parse_documents(chosen, payloads), vocab, min_confidence)


def status_changes(docs: DataFrame, status: str) -> DataFrame:
    """Change set that moves documents into a state."""
    return docs.select("document_id", F.lit(status).alias("pipeline_status"))
