"""Identifiers, guarded abstracts and search strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.exprs import SPACE, present, strip_space

DOI_PREFIX = rf"(?i)^(?:https?://doi\.org/|doi:{SPACE}*)"
DOI_SITE = "https://doi.org/"
YEAR = r"(\d{4})"


def clean_doi(raw: Column, require_prefix: bool = False) -> Column:
    """Trim and drop a resolver or ``doi:`` prefix.

    By default nothing is validated, so other identifiers in a DOI field pass. With
    ``require_prefix`` whatever does not start with ``10.`` becomes null.
    """
    doi = F.regexp_replace(strip_space(present(raw)), DOI_PREFIX, "")
    return F.when(doi.startswith("10."), doi) if require_prefix else doi


def doi_key(doi: Column) -> Column:
    """Form in which DOIs are compared: trimmed, lower case, null when empty."""
    return present(F.lower(strip_space(doi)))


def title_key(title: Column) -> Column:
    """Form in which titles are compared: trimmed, lower case, null when empty."""
    return present(F.lower(strip_space(title)))


def guarded_abstract(text: Column) -> Column:
    """Trimmed text; null if blank, if it starts with markup or looks like an error."""
    trimmed = strip_space(text)
    failed = (
        (trimmed == "")
        | trimmed.startswith("<")
        | F.contains(F.upper(F.substring(trimmed, 1, 200)), F.lit("ERROR"))
    )
    return F.when(~failed, trimmed)


def pmc_number(pmcid: Column) -> Column:
    return F.replace(pmcid, F.lit("PMC"), F.lit(""))


def publication_year(date: Column) -> Column:
    """First four digits of a date in any notation."""
    return F.regexp_extract(date, YEAR, 1).try_cast("int")


def search_queries(
    primary: Column,
    secondary: Column,
    *,
    style: str = "generic",
    max_secondary: int | None = 2,
    max_queries: int | None = 5,
) -> Column:
    """Every primary term with every secondary term, in order, the first ``max_queries``.

    ``fielded`` restricts both terms to title and abstract and uses only the first
    ``max_secondary`` secondary terms; ``generic`` URL-quotes the terms. ``None`` lifts
    either limit.
    """
    if style == "fielded":
        if max_secondary is not None:
            secondary = F.slice(secondary, 1, max_secondary)

        def phrase(p: Column, s: Column) -> Column:
            return F.concat(p, F.lit("[TitleAbstract] AND "), s, F.lit("[TitleAbstract]"))

    elif style == "generic":

        def phrase(p: Column, s: Column) -> Column:
            return F.concat(F.url_encode(p), F.lit(" "), F.url_encode(s))

    else:
        raise ValueError(f"unknown style: {style}")
    queries = F.flatten(
        F.transform(primary, lambda p: F.transform(secondary, lambda s: phrase(p, s)))
    )
    return queries if max_queries is None else F.slice(queries, 1, max_queries)
