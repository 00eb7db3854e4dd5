"""Queries over text: cleaning, sections, extraction, normalization."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import extraction as ex
from paperloom.functions import identifiers as ids
from paperloom.functions import normalization as norm
from paperloom.functions.exprs import unique_ignoring_case
from paperloom.functions.html import plain_text
from paperloom.functions.patterns import any_of
from paperloom.functions.text import clean, sections_long
from paperloom.operators.filters import confident
from paperloom.operators.fulltext import parse_payloads
from paperloom.operators.lookups import canonical_column, extract_fields, vocabulary_table
from paperloom.operators.spread import spread
from paperloom.plans.catalog import (
    SQL_CELLS,
    SQL_EXTRACTED,
    SQL_LIPIDS,
    SQL_NORMALIZED,
    SQL_PAYLOAD,
    SQL_RATIO,
    SQL_ROUTE,
    corpus,
    query,
    spread_corpus,
    sql_all,
    sql_canonical,
    sql_clean,
    sql_first,
    sql_strip,
    table,
)
from paperloom.session import written

# Fixed value: the section headings.
HEADINGS = "(?i)abstract|introduction|methods?|materials and methods|results|discussion|conclusion"

SQL_HTML_TEXT = (
    r"regexp_replace(regexp_replace(regexp_replace(html, "
    r"'(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', ' ', 'g'), "
    r"'(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g')"
)
for _name, _char in (("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", "\xa0"), ("&lt;", "<"),
                     ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
    SQL_HTML_TEXT = f"replace({SQL_HTML_TEXT}, '{_name}', '{_char}')"


@query("clean_text", f"SELECT page_id, {sql_clean('html')} AS cleaned FROM pages")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages"))
    return pages.select("page_id", clean(F.col("html")).alias("cleaned"))


@query("parse_html", f"SELECT page_id, {sql_clean(SQL_HTML_TEXT)} AS abstract_or_body FROM pages")
def parse_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages")).select(
        "page_id", plain_text(F.col("html")).alias("abstract_or_body")
    )


SQL_SECTIONS = f"""
SELECT doc_id, section, arg_max(section_text, n) AS section_text FROM (
  SELECT doc_id, n, replace(lower(keys[n]), ' ', '_') AS section,
    {sql_strip('parts[n + 1]')} AS section_text
  FROM (SELECT doc_id, regexp_extract_all(t, '{HEADINGS}') AS keys,
          regexp_split_to_array(t, '{HEADINGS}') AS parts
        FROM (SELECT doc_id, {sql_clean('body')} AS t FROM corpus)),
       LATERAL (SELECT unnest(range(1, len(keys) + 1)) AS n)
  UNION ALL
  SELECT doc_id, 1, 'body', t FROM (SELECT doc_id, {sql_clean('body')} AS t FROM corpus)
  WHERE NOT regexp_matches(t, '{HEADINGS}'))
GROUP BY doc_id, section
"""


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = spread_corpus(spark, sf_dir).select(
        "doc_id", F.col("body").alias("abstract"), F.lit(None).cast("string").alias("fulltext")
    )
    return parse_payloads(payloads).select("doc_id", "sections")


@query("section_explode", SQL_SECTIONS)
def section_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections_long(_parsed(spark, sf_dir))


@query(
    "sections",
    "SELECT doc_id, string_agg(section || '=' || section_text, '|' ORDER BY section) AS sections "
    f"FROM ({SQL_SECTIONS}) GROUP BY doc_id",
)
def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = F.array_sort(F.map_entries("sections"))
    shown = F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"]))
    return _parsed(spark, sf_dir).select("doc_id", F.array_join(shown, "|").alias("sections"))


@query(
    "unique_ci",
    f"SELECT doc_id, array_to_string({sql_all('body', SQL_CELLS + '|the|and|of')}, '|') AS words "
    "FROM corpus",
)
def unique_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = any_of((*ex.DEFAULT_VOCABULARY.cells, "the", "and", "of"))
    hits = F.regexp_extract_all("body", F.lit(pattern), F.lit(0))
    return spread_corpus(spark, sf_dir).select(
        "doc_id", F.array_join(unique_ignoring_case(hits), "|").alias("words")
    )


@query(
    "extract_lipids",
    f"SELECT doc_id, array_to_string({sql_all('body', SQL_LIPIDS)}, '|') AS lipids FROM corpus",
)
def extract_lipids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_corpus(spark, sf_dir).select(
        "doc_id", F.array_join(ex.extract_lipids(F.col("body")), "|").alias("lipids")
    )


@query(
    "extract_ratio",
    "SELECT doc_id, nullif("
    + sql_strip(f"regexp_extract(body, '{SQL_RATIO}')")
    + ", '') AS ratio FROM corpus",
)
def extract_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("doc_id", ex.extract_ratio(F.col("body")).alias("ratio"))


@query("extract_payload", f"SELECT doc_id, {sql_first('body', SQL_PAYLOAD)} AS payload FROM corpus")
def extract_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select(
        "doc_id", ex.extract_payload(F.col("body")).alias("payload")
    )


@query("extract_route", f"SELECT doc_id, {sql_first('body', SQL_ROUTE)} AS route FROM corpus")
def extract_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("doc_id", ex.extract_route(F.col("body")).alias("route"))


@query(
    "extract_cells",
    f"SELECT doc_id, nullif(array_to_string({sql_all('body', SQL_CELLS)}, ', '), '') AS cells "
    "FROM corpus",
)
def extract_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_corpus(spark, sf_dir).select("doc_id", ex.extract_cells(F.col("body")).alias("cells"))


@query(
    "ratio_parse",
    r"SELECT doc_id, array_to_string(list_transform(string_split(nullif(regexp_extract(body, "
    r"'\d+(?:\.\d+)?(?::\d+(?:\.\d+)?)+'), ''), ':'), lambda x: CAST(CAST(x AS DOUBLE) AS VARCHAR)), ':') "
    "AS numbers FROM corpus",
)
def ratio_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = F.transform(ex.parse_ratio(F.col("body")), lambda x: x.cast("string"))
    return corpus(spark, sf_dir).select("doc_id", F.array_join(numbers, ":").alias("numbers"))


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.extract_all(spread_corpus(spark, sf_dir), "body")


@query(
    "confidence",
    "SELECT extraction_confidence, count(*) AS n_documents "
    f"FROM ({SQL_EXTRACTED}) GROUP BY extraction_confidence",
)
def confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _extracted(spark, sf_dir)
    return scored.groupBy("extraction_confidence").agg(F.count("*").alias("n_documents"))


EXTRACTED_COLUMNS = [
    "doc_id",
    "lipid_mix_text",
    "lipid_reagents_json",
    "lipid_ratios_text",
    "cells_or_organisms",
    "payload",
    "administration_route",
    "evidence_span",
    "extraction_confidence",
]
SQL_COLUMNS = ", ".join(EXTRACTED_COLUMNS)


@query(
    "extract_all",
    f"SELECT {SQL_COLUMNS}, CAST(NULL AS VARCHAR) AS lipid_ratios_json, "
    f"CAST(NULL AS VARCHAR) AS other_relevant_info FROM ({SQL_EXTRACTED})",
)
def extract_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(spark, sf_dir).select(
        *EXTRACTED_COLUMNS, "lipid_ratios_json", "other_relevant_info"
    )


@query(
    "confidence_filter",
    f"SELECT doc_id, extraction_confidence FROM ({SQL_EXTRACTED}) "
    "WHERE extraction_confidence >= 0.4",
)
def confidence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confident(_extracted(spark, sf_dir)).select("doc_id", "extraction_confidence")


@query(
    "canonicalize",
    f"SELECT doc_id, {sql_canonical(sql_first('body', SQL_ROUTE))} AS route, "
    f"{sql_canonical('title')} AS title FROM corpus",
)
def canonicalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    route = ex.extract_route(F.col("body"))
    return corpus(spark, sf_dir).select(
        "doc_id",
        F.when(route.isNotNull(), norm.canonicalize(route)).alias("route"),
        norm.canonicalize(F.col("title")).alias("title"),
    )


SQL_TITLE_KEY = f"trim(lower({sql_strip('title')}), ' .')"


@query(
    "canonicalize_table",
    f""", keyed AS (SELECT doc_id, {sql_strip('title')} AS title, {SQL_TITLE_KEY} AS k FROM corpus),
aliases AS (SELECT k, 'title ' || min(doc_id) AS canonical FROM keyed GROUP BY k HAVING count(*) > 1)
SELECT doc_id, coalesce(canonical, title) AS title FROM keyed LEFT JOIN aliases USING (k)""",
)
def canonicalize_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that several documents have, named after the first, by a table of as many aliases."""
    titles = corpus(spark, sf_dir).select("doc_id", "title")
    aliases = (
        titles.groupBy(norm.alias_key(F.col("title")).alias("alias"))
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select("alias", F.concat(F.lit("title "), "first").alias("canonical"))
    )
    return canonical_column(titles, "title", written(aliases, "aliases"))


@query(
    "extract_table",
    f"SELECT doc_id, array_to_string({sql_all('body', SQL_LIPIDS)}, '|') AS lipids, nullif("
    + sql_strip(f"regexp_extract(body, '{SQL_RATIO}')")
    + f", '') AS ratio, {sql_first('body', SQL_PAYLOAD)} AS payload, "
    f"{sql_first('body', SQL_ROUTE)} AS route, "
    f"array_to_string({sql_all('body', SQL_CELLS)}, '|') AS cells FROM corpus",
)
def extract_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of a vocabulary that is a stored table."""
    vocabulary = written(vocabulary_table(spark), "vocabulary")
    found = extract_fields(spread_corpus(spark, sf_dir), "body", vocabulary)
    return found.select(
        "doc_id",
        F.array_join("lipids", "|").alias("lipids"),
        "ratio",
        "payload",
        "route",
        F.array_join("cells", "|").alias("cells"),
    )


@query(
    "normalize_lipids",
    "SELECT doc_id, array_to_string(canon, '|') AS lipids FROM ("
    f"{SQL_NORMALIZED})",
)
def normalize_lipids(spark: SparkSession, sf_dir: str) -> DataFrame:
    lipids = norm.normalize_lipids(ex.extract_lipids(F.col("body")))
    return spread_corpus(spark, sf_dir).select("doc_id", F.array_join(lipids, "|").alias("lipids"))


@query("normalize_record", f"SELECT {SQL_COLUMNS} FROM ({SQL_NORMALIZED})")
def normalize_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm.normalize_records(_extracted(spark, sf_dir)).select(*EXTRACTED_COLUMNS)


SQL_CLEANED = f"(SELECT * REPLACE ({sql_clean('body')} AS body) FROM corpus))"


@query(
    "payload_summary",
    "SELECT payload, count(*) AS n_records, round(avg(extraction_confidence), 6) AS mean_confidence, "
    "count(DISTINCT lipid_reagents_json) AS n_formulations "
    f"FROM ({SQL_NORMALIZED.replace('FROM corpus)', f'FROM {SQL_CLEANED}')}) GROUP BY payload",
)
def payload_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: clean, extract and normalize all documents, then summarize by payload."""
    cleaned = spread_corpus(spark, sf_dir).withColumn("body", clean(F.col("body")))
    records = norm.normalize_records(ex.extract_all(cleaned, "body"))
    return records.groupBy("payload").agg(
        F.count("*").alias("n_records"),
        F.round(F.avg("extraction_confidence"), 6).alias("mean_confidence"),
        F.count_distinct("lipid_reagents_json").alias("n_formulations"),
    )


@query(
    "doi_clean",
    r"SELECT doc_id, regexp_replace(trim(raw_doi), '(?i)^(https?://doi\.org/|doi:\s*)', '') AS doi "
    "FROM corpus",
)
def doi_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("doc_id", ids.clean_doi(F.col("raw_doi")).alias("doi"))


@query(
    "abstract_guard",
    "SELECT doc_id, CASE WHEN t <> '' AND NOT starts_with(t, '<') "
    "AND NOT contains(upper(substr(t, 1, 200)), 'ERROR') THEN t END AS abstract FROM ("
    f"SELECT doc_id, {sql_strip('''CASE doc_id % 4 WHEN 0 THEN body WHEN 1 THEN concat('  An error ', text) WHEN 2 THEN '  ' ELSE text END''')} AS t FROM corpus)",
)
def abstract_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr(
        "CASE doc_id % 4 WHEN 0 THEN body WHEN 1 THEN concat('  An error ', text) "
        "WHEN 2 THEN '  ' ELSE text END"
    )
    return corpus(spark, sf_dir).select("doc_id", ids.guarded_abstract(raw).alias("abstract"))


SQL_TERMS = f"""
SELECT doc_id, p, s FROM (
  SELECT doc_id, {sql_all('body', SQL_LIPIDS)} AS p, {sql_all('body', SQL_CELLS)} AS s FROM corpus)
"""


@query(
    "term_cross",
    f"""
SELECT doc_id,
  array_to_string(list_slice(flatten(list_transform(p, lambda a: list_transform(list_slice(s, 1, 2),
    lambda b: a || '[TitleAbstract] AND ' || b || '[TitleAbstract]'))), 1, 5), '|') AS fielded,
  array_to_string(list_slice(flatten(list_transform(p, lambda a: list_transform(s,
    lambda b: replace(a, ' ', '+') || ' ' || replace(b, ' ', '+')))), 1, 5), '|') AS generic
FROM ({SQL_TERMS})""",
)
def term_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search strings from the terms each document contains."""
    terms = spread_corpus(spark, sf_dir).select(
        "doc_id",
        ex.extract_lipids(F.col("body")).alias("p"),
        ex.extract_cell_list(F.col("body")).alias("s"),
    )
    p, s = F.col("p"), F.col("s")
    return terms.select(
        "doc_id",
        F.array_join(ids.search_queries(p, s, style="fielded"), "|").alias("fielded"),
        F.array_join(ids.search_queries(p, s), "|").alias("generic"),
    )


