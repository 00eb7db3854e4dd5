"""Row selection by status, source and confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.exprs import evaluated

# Sources that take part in discovery.
DISCOVERY_SOURCES = (
    "PubMed",
    "Europe PMC",
    "bioRxiv",
    "medRxiv",
    "Crossref",
    "OpenAlex",
    "Semantic Scholar",
    "DOAJ",
)
CONFIDENCE_THRESHOLD = 0.4


def with_status(docs: DataFrame, status: str, limit: int | None = None) -> DataFrame:
    """Documents in a state, in order of id; ``None`` and ``0`` mean no limit."""
    found = docs.where(F.col("pipeline_status") == status).orderBy("document_id")
    return found.limit(limit) if limit else found


def allowed_sources(
    registry: DataFrame,
    allowed: tuple[str, ...] = DISCOVERY_SOURCES,
    only: str | None = None,
    column: str = "source",
) -> DataFrame:
    """Registry rows on the allow-list, optionally a single source."""
    kept = registry.where(F.col(column).isin(*allowed))
    return kept.where(F.col(column) == only) if only else kept


def confident(
    records: DataFrame, threshold: float | None = CONFIDENCE_THRESHOLD
) -> DataFrame:
    """Records with at least the given confidence; ``None`` keeps all."""
    if threshold is None:
        return records
    return evaluated(records).where(F.col("extraction_confidence") >= F.lit(threshold))
