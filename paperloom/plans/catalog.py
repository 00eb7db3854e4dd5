"""Registry of runnable queries, each with its SQL counterpart where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.identifiers import clean_doi
from paperloom.operators.spread import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Documents with domain phrases, identifiers and titles derived from the given texts; valid
# in Spark SQL and in DuckDB. Every document is in it with its whole text.
CORPUS_SQL = r"""
SELECT doc_id, source AS source_name,
  concat('ext-', CAST(doc_id AS STRING)) AS external_id,
  CASE WHEN doc_id % 5 = 4 THEN NULL
       WHEN doc_id % 7 = 3 THEN concat('10.1000/', CAST(doc_id - 1 AS STRING))
       WHEN doc_id % 7 = 5 THEN concat(' HTTPS://doi.org/10.1000/', CAST(doc_id AS STRING))
       ELSE concat('doi: 10.1000/', CAST(doc_id AS STRING)) END AS raw_doi,
  CASE WHEN doc_id % 11 = 0 THEN ''
       ELSE trim(regexp_extract(text, '^([^.]*)', 1)) END AS title,
  concat('<p>Pre ', CASE doc_id % 6
    WHEN 0 THEN 'Abstract MC3 with DSPC, Cholesterol and PEG-lipid; molar ratio 46:9:43.5:1.5 throughout. Packed siRNA. Methods we gave it IV. to mice.'
    WHEN 1 THEN 'Abstract SM-102 plus DOPC, chol and DMG-PEG. Results saRNA came first; Results one Intramuscular dose per rat.'
    WHEN 2 THEN 'Materials and Methods cationic lipid, DOPE, dope, Chol. weight ratio 2; pDNA in HeLa and hela, HEK293.'
    WHEN 3 THEN 'Introduction PEGylated lipid DMG-PEG, DOTAP mol/mol 1. CRISPR sgRNA RNP subcutaneous NHP.'
    WHEN 4 THEN 'no chemistry here'
    ELSE '' END, '</p> ', text) AS body,
  text, n_chars
FROM {documents}
"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use ``corpus`` and the given tables."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            corpus = CORPUS_SQL.format(documents="documents").strip()
            ORACLES[name] = f"WITH RECURSIVE corpus AS ({corpus}) {sql.strip()}"
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CORPUS_SQL, documents=table(spark, sf_dir, "documents"))


def spread_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus for work that is dear per text, on all cores."""
    return spark.sql(CORPUS_SQL, documents=spread(table(spark, sf_dir, "documents")))


def corpus_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as a document table: ids, cleaned DOIs and a state per document."""
    state = F.element_at(
        F.array(*[F.lit(s) for s in ("DISCOVERED", "FETCHED", "PARSED", "EXTRACTED", "LOADED", "FAILED")]),
        (F.col("doc_id") % 6 + 1).cast("int"),
    )
    return corpus(spark, sf_dir).select(
        F.col("doc_id").alias("document_id"),
        "source_name",
        "external_id",
        clean_doi(F.col("raw_doi")).alias("doi"),
        F.when(F.col("doc_id") % 3 == 0, F.col("doc_id").cast("string")).alias("pmid"),
        F.when(F.col("doc_id") % 4 == 1, F.concat(F.lit("PMC"), "doc_id")).alias("pmcid"),
        F.col("source_name").alias("journal_or_site"),
        F.concat((F.lit(2000) + F.col("doc_id") % 25).cast("string"), F.lit("-01")).alias(
            "publication_date"
        ),
        F.concat(F.lit("http://x/"), "doc_id").alias("source_url"),
        F.col("body").alias("abstract_text"),
        "title",
        state.alias("pipeline_status"),
    )


# --- fragments of the SQL counterparts -------------------------------------------------

SQL_SPACE = (
    r"[\t-\r \x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
SQL_DOCUMENTS = r"""
SELECT doc_id AS document_id, source_name, external_id,
  regexp_replace(trim(raw_doi), '(?i)^(https?://doi\.org/|doi:\s*)', '') AS doi,
  CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id AS VARCHAR) END AS pmid,
  CASE WHEN doc_id % 4 = 1 THEN 'PMC' || doc_id END AS pmcid,
  source_name AS journal_or_site, (2000 + doc_id % 25) || '-01' AS publication_date,
  'http://x/' || doc_id AS source_url, body AS abstract_text, title,
  ['DISCOVERED','FETCHED','PARSED','EXTRACTED','LOADED','FAILED'][doc_id % 6 + 1] AS pipeline_status
FROM corpus
"""


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"


def sql_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SQL_SPACE}+', ' ', 'g'))"


def sql_clean(x: str) -> str:
    return sql_collapse(f"regexp_replace({x}, '<[^>]+>', ' ', 'g')")


def sql_unique(x: str) -> str:
    return (
        f"list_filter({x}, lambda x, i: x <> '' AND "
        f"list_position(list_transform({x}, lambda y: lower(y)), lower(x)) = i)"
    )


def sql_json_list(x: str) -> str:
    return f"'[\"' || array_to_string({x}, '\", \"') || '\"]'"


# The word lists, as in functions/vocab.py.
SQL_LIPIDS = (
    r"(?i)DLin-MC3-DMA|MC3|ALC-0315|SM-102|lipid\s*H|ionizable\s+lipid|cationic\s+lipid|DSPC|DOPE|"
    r"DOPC|DPPC|cholesterol|Chol|PEG-lipid|PEGylated\s+lipid|DMG-PEG|ALC-0159|C12-200|DLinDMA|"
    r"DOTAP|DOTMA"
)
SQL_RATIO = r"(?i)(?:molar ratio|mol/mol|wt/wt|weight ratio)[^\n.;:]{0,120}"
SQL_PAYLOAD = r"(?i)mRNA|siRNA|saRNA|plasmid DNA|pDNA|CRISPR|sgRNA|RNP|antisense|miRNA|ASO"
SQL_ROUTE = (
    r"(?i)intravenous(?:ly)?|IV|intraperitoneal(?:ly)?|IP|intramuscular(?:ly)?|IM|"
    r"subcutaneous(?:ly)?|SC|intranasal(?:ly)?|IN|intratracheal(?:ly)?|IT|oral(?:ly)?|"
    r"topical(?:ly)?|intratumoral(?:ly)?"
)
SQL_CELLS = (
    r"(?i)HeLa|HEK293|HepG2|A549|Jurkat|PBMC|dendritic cell|hepatocyte|macrophage|T cell|B cell|"
    r"mouse|mice|rat|rabbit|NHP|non-human primate|human|in vivo|in vitro"
)


def sql_all(x: str, pattern: str) -> str:
    return sql_unique(f"regexp_extract_all({x}, '{pattern}')")


def sql_first(x: str, pattern: str) -> str:
    return f"nullif(regexp_extract({x}, '{pattern}'), '')"


SQL_EXTRACTED = f"""
SELECT doc_id, title, raw_doi, body, lipids,
  CASE WHEN len(lipids) > 0 THEN array_to_string(lipids, ', ') END AS lipid_mix_text,
  CASE WHEN len(lipids) > 0 THEN {sql_json_list('lipids')} END AS lipid_reagents_json,
  ratio AS lipid_ratios_text, nullif(array_to_string(cells, ', '), '') AS cells_or_organisms,
  payload, route AS administration_route, nullif(substr(body, 1, 500), '') AS evidence_span,
  (CASE WHEN len(lipids) > 0 THEN 40 ELSE 0 END + CASE WHEN payload IS NOT NULL THEN 20 ELSE 0 END
   + CASE WHEN len(cells) > 0 THEN 15 ELSE 0 END + CASE WHEN route IS NOT NULL THEN 15 ELSE 0 END
   + CASE WHEN ratio IS NOT NULL THEN 10 ELSE 0 END) / 100.0::DOUBLE AS extraction_confidence
FROM (SELECT doc_id, title, raw_doi, body,
        {sql_all('body', SQL_LIPIDS)} AS lipids,
        nullif({sql_strip(f"regexp_extract(body, '{SQL_RATIO}')")}, '') AS ratio,
        {sql_all('body', SQL_CELLS)} AS cells,
        {sql_first('body', SQL_PAYLOAD)} AS payload,
        {sql_first('body', SQL_ROUTE)} AS route
      FROM corpus)
"""


def sql_canonical(x: str) -> str:
    key = f"regexp_replace(lower({sql_strip(x)}), '^[ .]+|[ .]+$', '', 'g')"
    return (
        f"CASE {key} WHEN 'cationic lipid' THEN 'ionizable lipid' WHEN 'peg lipid' THEN 'PEG-lipid' "
        f"WHEN 'pegylated lipid' THEN 'PEG-lipid' WHEN 'chol' THEN 'cholesterol' "
        f"WHEN 'iv' THEN 'intravenous' WHEN 'im' THEN 'intramuscular' "
        f"WHEN 'sc' THEN 'subcutaneous' ELSE {sql_strip(x)} END"
    )


SQL_NORMALIZED = f"""
SELECT * REPLACE (
    CASE WHEN lipid_reagents_json IS NOT NULL THEN {sql_json_list('canon')} END AS lipid_reagents_json,
    {sql_canonical('administration_route')} AS administration_route)
FROM (SELECT e.*, {sql_unique('mapped')} AS canon
      FROM (SELECT e0.*, list_transform(lipids, lambda v: {sql_canonical('v')}) AS mapped
            FROM ({SQL_EXTRACTED}) e0) e)
"""
