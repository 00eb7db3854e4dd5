"""Queries over tables: selection, merging, quality, counts, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import schemas
from paperloom.functions.exprs import first_present
from paperloom.functions.extraction import extract_all
from paperloom.functions.identifiers import clean_doi
from paperloom.functions.normalization import normalize_records
from paperloom.operators.filters import allowed_sources, with_status
from paperloom.operators.merge import (
    add_new_sources,
    apply_changes,
    mark_doi_conflicts,
    orphans,
    upsert_documents,
    without_output,
)
from paperloom.operators.fulltext import parse_documents, with_raw_hash
from paperloom.operators.quality import field_profile, qa_report
from paperloom.operators.ranking import assign_ids, first_wins, top_k
from paperloom.operators.registry import (
    counted_run_row,
    discovery_counts,
    refresh_registry,
    run_log_row,
    source_counts,
    stage_metrics,
    with_grand_total,
    write_counted,
)
from paperloom.plans.catalog import (
    SQL_DOCUMENTS,
    SQL_NORMALIZED,
    corpus,
    corpus_documents,
    query,
    spread_corpus,
    sql_clean,
    table,
)
from paperloom.session import scratch_path, written
from paperloom.sources.bucketed import BucketedTable
from paperloom.sources.layout import write_layout
from paperloom.sources.files import (
    EXPORT_COLUMNS,
    append_runs,
    export_view,
    load_records,
    prepare_records,
    read_csv,
    read_jsonl,
    read_payloads,
    read_records,
    read_runs,
    write_csv,
    write_jsonl,
    write_payloads,
    write_report,
)

DOCS = f", docs AS ({SQL_DOCUMENTS})"
ALLOWED = tuple(f"src{n}" for n in range(8))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = extract_all(spread_corpus(spark, sf_dir), "body")
    return normalize_records(extracted).withColumnRenamed("doc_id", "document_id")


@query(
    "status_filter",
    f"{DOCS} SELECT document_id, title FROM docs WHERE pipeline_status = 'FETCHED'",
)
def status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_status(corpus_documents(spark, sf_dir), "FETCHED").select("document_id", "title")


@query(
    "src_allowlist",
    "SELECT doc_id, source_name FROM corpus WHERE source_name IN ('src0', 'src1', 'src2', 'src3', "
    "'src4', 'src5', 'src6', 'src7')",
)
def src_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allowed_sources(corpus(spark, sf_dir), ALLOWED, column="source_name").select(
        "doc_id", "source_name"
    )


@query(
    "uid_dedup",
    f"""{DOCS} SELECT source_name, uid, min(document_id) AS document_id
FROM (SELECT *, coalesce(nullif(doi, ''), nullif(title, '')) AS uid FROM docs)
WHERE uid IS NOT NULL GROUP BY source_name, uid""",
)
def uid_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_documents(spark, sf_dir).select(
        "document_id", "source_name", first_present(F.col("doi"), F.col("title")).alias("uid")
    )
    return first_wins(
        docs.where(F.col("uid").isNotNull()), ["source_name", "uid"], "document_id"
    )


@query(
    "source_topk",
    "SELECT source_name, doc_id, title FROM (SELECT *, row_number() OVER (PARTITION BY source_name "
    "ORDER BY doc_id) AS rn FROM corpus) WHERE rn <= 25",
)
def source_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus(spark, sf_dir).select("source_name", "doc_id", "title")
    return top_k(docs, ["source_name"], [F.col("doc_id")], 25)


# Documents of both phases folded by key; {again} chooses those of the second phase.
SQL_UPSERTED = """
, rows AS (
  SELECT doc_id + 1000000000000 * phase AS seq, source_name,
    CASE WHEN doc_id % 13 = 0 THEN NULL ELSE 'k' || (doc_id // 40) END AS external_id,
    regexp_replace(trim(raw_doi), '(?i)^(https?://doi\\.org/|doi:\\s*)', '') AS doi,
    coalesce(nullif(title, ''), 'Untitled') AS title, CASE WHEN phase = 0 THEN text END AS abstract_text,
    CASE WHEN phase = 0 THEN 'LOADED' ELSE 'DISCOVERED' END AS pipeline_status
  FROM corpus, (SELECT 0 AS phase UNION ALL SELECT 1) p
  WHERE {again}),
merged AS (
  SELECT source_name, external_id, min(seq) AS first_seq, arg_max(doi, seq) FILTER (doi IS NOT NULL) AS doi,
    arg_max(title, seq) AS title,
    arg_max(abstract_text, seq) FILTER (abstract_text IS NOT NULL) AS abstract_text,
    arg_max(pipeline_status, seq) AS pipeline_status
  FROM rows WHERE external_id IS NOT NULL GROUP BY source_name, external_id
  UNION ALL
  SELECT source_name, external_id, seq, doi, title, abstract_text, pipeline_status
  FROM rows WHERE external_id IS NULL)
SELECT row_number() OVER (ORDER BY first_seq) AS document_id, source_name, external_id, doi, title,
  abstract_text, pipeline_status FROM merged"""


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one batch, many of a key and some without."""
    doc_id = F.col("doc_id")
    return corpus(spark, sf_dir).select(
        "source_name",
        F.when(doc_id % 13 != 0, F.concat(F.lit("k"), F.floor(doc_id / 40))).alias("external_id"),
        clean_doi(F.col("raw_doi")).alias("doi"),
        "title",
        F.col("text").alias("abstract_text"),
        F.lit("LOADED").alias("pipeline_status"),
        doc_id.alias("ingest_seq"),
    )


@query("upsert_merge", SQL_UPSERTED.format(again="true"))
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents loaded into an empty snapshot, then discovered again without abstracts."""
    batch = _loaded(spark, sf_dir)
    empty = spark.createDataFrame(
        [],
        "document_id BIGINT, source_name STRING, external_id STRING, doi STRING, "
        "abstract_text STRING, title STRING, pipeline_status STRING",
    )
    first = upsert_documents(empty, batch)
    again = batch.drop("abstract_text", "pipeline_status")
    return upsert_documents(first, again)


@query("upsert_buckets", SQL_UPSERTED.format(again="phase = 0 OR doc_id % 6 = 5"))
def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in a bucketed table, where the failed ones are then discovered again."""
    batch = _loaded(spark, sf_dir)
    failed = with_status(corpus_documents(spark, sf_dir), "FAILED").select(
        F.col("document_id").alias("ingest_seq")
    )
    again = (
        batch.drop("abstract_text", "pipeline_status")
        .join(failed, "ingest_seq", "left_semi")
        .withColumn("ingest_seq", F.col("ingest_seq") + 1_000_000_000_000)
    )
    documents = BucketedTable(spark, scratch_path(spark, "documents"), schemas.DOCUMENTS, buckets=64)
    documents.upsert(batch, 1)
    documents.upsert(again, 2)
    return documents.read().select(
        "document_id", "source_name", "external_id", "doi", "title", "abstract_text", "pipeline_status"
    )


@query(
    "source_upsert",
    """
, old AS (SELECT source AS name, row_number() OVER (ORDER BY source) AS source_id FROM documents
          WHERE lang = 'en' GROUP BY source),
fresh AS (SELECT name, min(doc_id) AS first_id FROM (
            SELECT CASE WHEN lang = 'en' THEN source ELSE source || '-' || lang END AS name, doc_id
            FROM documents) WHERE name NOT IN (SELECT name FROM old) GROUP BY name)
SELECT source_id, name, 'old' AS homepage, CAST(NULL AS VARCHAR) AS api_url FROM old UNION ALL
SELECT (SELECT max(source_id) FROM old) + row_number() OVER (ORDER BY first_id), name,
  'http://' || first_id, 'api' FROM fresh""",
)
def source_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    english = F.col("lang") == "en"
    old = assign_ids(
        docs.where(english).select(F.col("source").alias("name")).distinct(), "name", "source_id"
    ).select("source_id", "name", F.lit("old").alias("homepage"), F.lit(None).cast("string").alias("api_url"))
    candidates = docs.select(
        F.when(english, F.col("source")).otherwise(F.concat_ws("-", "source", "lang")).alias("name"),
        F.concat(F.lit("http://"), "doc_id").alias("homepage"),
        F.lit("api").alias("api_url"),
        F.col("doc_id").alias("seq"),
    )
    return add_new_sources(old, candidates)


@query(
    "status_update",
    f"""{DOCS} SELECT document_id, coalesce(doi, 'none') AS doi,
  CASE WHEN pipeline_status = 'DISCOVERED' THEN CASE WHEN doi IS NULL THEN 'FAILED' ELSE 'FETCHED' END
    ELSE pipeline_status END AS pipeline_status,
  CASE WHEN pipeline_status = 'DISCOVERED' AND doi IS NOT NULL THEN sha256(abstract_text) ELSE 'old' END
    AS raw_hash FROM docs""",
)
def status_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_documents(spark, sf_dir).withColumn("raw_hash", F.lit("old"))
    found = F.col("doi").isNotNull()
    changes = docs.where(F.col("pipeline_status") == "DISCOVERED").select(
        "document_id",
        F.when(found, "FETCHED").otherwise("FAILED").alias("pipeline_status"),
        F.when(found, F.sha2("abstract_text", 256)).alias("raw_hash"),
    )
    return apply_changes(docs, changes).select(
        "document_id", F.coalesce("doi", F.lit("none")).alias("doi"), "pipeline_status", "raw_hash"
    )


@query(
    "doi_conflicts",
    f"""{DOCS} SELECT document_id, doi, first AS conflicts_with FROM (
  SELECT document_id, doi, min(document_id) OVER (PARTITION BY doi) AS first FROM docs
  WHERE doi IS NOT NULL) WHERE first <> document_id""",
)
def doi_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_documents(spark, sf_dir).select("document_id", "doi")
    marked = mark_doi_conflicts(docs, "document_id")
    return marked.where(F.col("conflicts_with").isNotNull())


@query(
    "orphan_check",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def orphan_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that no label row stands behind."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return orphans(docs, "doc_id", table(spark, sf_dir, "labels"), "doc_id")


@query(
    "resume",
    f"{DOCS} SELECT document_id FROM docs WHERE pipeline_status NOT IN ('EXTRACTED', 'LOADED')",
)
def resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_documents(spark, sf_dir)
    done = docs.where(F.col("pipeline_status").isin("EXTRACTED", "LOADED"))
    return without_output(docs.select("document_id"), done)


SQL_SOURCES = (
    "SELECT DISTINCT source AS name FROM documents UNION SELECT DISTINCT lang AS name FROM documents"
)


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources, and the languages as sources without documents."""
    docs = table(spark, sf_dir, "documents")
    names = docs.select(F.explode(F.array("source", "lang")).alias("name")).distinct()
    return names.withColumn("source_name", F.col("name"))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_documents(spark, sf_dir).select("document_id", "source_name")
    return source_counts(_sources(spark, sf_dir), docs, "source_name")


@query(
    "source_counts",
    f"SELECT name, CAST(sum(n) AS BIGINT) AS doc_count FROM (SELECT s.name, count(d.doc_id) AS n "
    f"FROM ({SQL_SOURCES}) s LEFT JOIN documents d ON d.source = s.name GROUP BY s.name) "
    "GROUP BY ROLLUP (name)",
)
def source_count_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_grand_total(_counts(spark, sf_dir))


@query(
    "registry_update",
    "SELECT s.name AS source, true AS crawled, TIMESTAMP '2024-01-02 03:04:05' AS last_crawled_at, "
    f"count(d.doc_id) AS new_entries_from_last_crawl FROM ({SQL_SOURCES}) s "
    "LEFT JOIN documents d ON d.source = s.name GROUP BY s.name",
)
def registry_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = _sources(spark, sf_dir).select(F.col("name").alias("source"))
    stamp = F.lit("2024-01-02 03:04:05").cast("timestamp")
    return refresh_registry(registry, _counts(spark, sf_dir), stamp)


@query(
    "run_metrics",
    f"{DOCS} SELECT pipeline_status, count(*) AS n_documents FROM docs GROUP BY pipeline_status",
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_metrics(corpus_documents(spark, sf_dir))


SQL_RUN_LOG = f"""{DOCS} SELECT 7 AS run_id, 'DONE' AS status, count(*) AS discovered_count,
  count(*) FILTER (pipeline_status NOT IN ('DISCOVERED', 'FAILED')) AS fetched_count,
  count(*) FILTER (pipeline_status = 'LOADED') AS inserted_count FROM docs"""


@query("run_log", SQL_RUN_LOG)
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_documents(spark, sf_dir)
    row = run_log_row(docs, with_status(docs, "LOADED"), 7, F.current_timestamp())
    return row.select("run_id", "status", "discovered_count", "fetched_count", "inserted_count")


@query("run_log_observed", SQL_RUN_LOG)
def run_log_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log with counts taken by the jobs that write documents and loaded documents."""
    path = scratch_path(spark, "documents")
    docs = corpus_documents(spark, sf_dir)
    counts = write_counted(docs, path, discovery_counts())
    stored = spark.read.schema(docs.schema).parquet(path)
    loaded = stored.where(F.col("pipeline_status") == "LOADED")
    counts |= write_counted(
        loaded, scratch_path(spark, "loaded"), {"inserted_count": F.count(F.lit(1))}
    )
    row = counted_run_row(spark, counts, 7, F.current_timestamp())
    return row.select("run_id", "status", "discovered_count", "fetched_count", "inserted_count")


SQL_QA = f"""SELECT n AS total_records, m AS missing_lipid_fields,
  round(100.0 * m / n, 2)::DOUBLE AS missing_lipid_fields_pct, 20.0::DOUBLE AS threshold_pct,
  100.0 * m / n <= 20 AS passed
FROM (SELECT count(*) AS n, count(*) FILTER (coalesce(lipid_reagents_json, '') = '') AS m
      FROM ({SQL_NORMALIZED}))"""


@query("qa_report", SQL_QA)
def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa_report(_records(spark, sf_dir))


STORED = """document_id lipid_mix_text lipid_reagents_json lipid_ratios_text lipid_ratios_json
cells_or_organisms payload administration_route other_relevant_info evidence_span
extraction_confidence""".split()


@query(
    "load_records",
    "SELECT doc_id AS document_id, lipid_mix_text, lipid_reagents_json, lipid_ratios_text, "
    "CAST(NULL AS VARCHAR) AS lipid_ratios_json, cells_or_organisms, payload, administration_route, "
    "CAST(NULL AS VARCHAR) AS other_relevant_info, evidence_span, extraction_confidence, "
    f"'unreviewed' AS reviewer_status, 1 AS batch_id, true AS stamped FROM ({SQL_NORMALIZED})",
)
def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch loaded twice; it is stored once."""
    path = scratch_path(spark, "records")
    stored = [c.split()[0] for c in schemas.RECORDS.split(", ")]
    made = [c for c in stored if c not in ("reviewer_status", "batch_id", "created_at", "updated_at")]
    records = written(_records(spark, sf_dir).select(*made), "records-to-load")
    load_records(records, path, 1)
    load_records(records, path, 1)
    stamped = F.col("created_at").isNotNull() & F.col("updated_at").isNotNull()
    return read_records(spark, path).select(
        *STORED, "reviewer_status", "batch_id", stamped.alias("stamped")
    )


SQL_EXPORT = f"""{DOCS}, records AS ({SQL_NORMALIZED})
SELECT d.document_id, d.title, d.doi, d.pmid, d.pmcid, d.journal_or_site, d.publication_date,
  d.source_url, r.lipid_mix_text, r.lipid_reagents_json, r.lipid_ratios_text, r.cells_or_organisms,
  r.payload, r.administration_route, CAST(NULL AS VARCHAR) AS other_relevant_info, r.evidence_span,
  r.extraction_confidence FROM records r JOIN docs d ON d.document_id = r.doc_id"""


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = prepare_records(_records(spark, sf_dir), 1).drop("title")
    return export_view(records, corpus_documents(spark, sf_dir))


@query("export_join", SQL_EXPORT)
def export_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _export(spark, sf_dir)


@query(
    "export_csv",
    SQL_EXPORT.replace("d.title,", "nullif(d.title, '') AS title,").replace(
        "d.doi,", "nullif(d.doi, '') AS doi,"
    ),
)
def export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export written as CSV and read back; CSV shows null and empty text alike."""
    path = scratch_path(spark, "csv")
    exported = _export(spark, sf_dir)
    write_csv(exported, path)
    types = dict(exported.dtypes)
    return read_csv(spark, path, ", ".join(f"{c} {types[c]}" for c in EXPORT_COLUMNS))


@query("jsonl_roundtrip", f"{DOCS} SELECT * FROM docs")
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    docs = corpus_documents(spark, sf_dir)
    write_jsonl(docs, path)
    return read_jsonl(spark, path, ", ".join(f"{c} {t}" for c, t in docs.dtypes))


@query(
    "parse_stage",
    f"""{DOCS} SELECT d.document_id, d.title, d.doi, concat_ws(' ', nullif({sql_clean('d.abstract_text')}, ''),
  nullif({sql_clean('c.text')}, '')) AS abstract_or_body
FROM docs d JOIN corpus c ON c.doc_id = d.document_id WHERE d.pipeline_status = 'FETCHED'""",
)
def parse_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FETCHED documents joined to stored payloads with an abstract and a full text."""
    stored = read_payloads(spark, _stored_payloads(spark, sf_dir))
    parsed = parse_documents(corpus_documents(spark, sf_dir), stored)
    return parsed.select("document_id", "title", "doi", "abstract_or_body")


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = corpus(spark, sf_dir).select(F.col("doc_id").alias("document_id"), "text")
    docs = corpus_documents(spark, sf_dir).join(texts, "document_id")
    return docs.select(
        "document_id",
        "doi",
        "pmcid",
        F.col("abstract_text").alias("abstract"),
        F.col("text").alias("fulltext"),
        F.lit("pmc_xml").alias("content_type"),
    )


def _stored_payloads(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "payloads")
    write_payloads(with_raw_hash(_payloads(spark, sf_dir)), path)
    return path


SQL_JSON = "coalesce(CAST(to_json({0}) AS VARCHAR), 'null')"


@query(
    "payload_store",
    f"""{DOCS} SELECT document_id, true AS has_path, sha256('{{"document_id": ' || document_id || ', "doi": ' ||
  {SQL_JSON.format('d.doi')} || ', "pmcid": ' || {SQL_JSON.format('d.pmcid')} || ', "abstract": ' ||
  {SQL_JSON.format('d.abstract_text')} || ', "fulltext": ' || {SQL_JSON.format('c.text')} ||
  ', "content_type": "pmc_xml"}}') AS raw_hash
FROM docs d JOIN corpus c ON c.doc_id = d.document_id""",
)
def payload_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full payloads stored; their place and hash become part of the document table."""
    path = scratch_path(spark, "payloads")
    changes = write_payloads(with_raw_hash(_payloads(spark, sf_dir)), path)
    docs = corpus_documents(spark, sf_dir).withColumns(
        {"full_text_path": F.lit(None).cast("string"), "raw_hash": F.lit(None).cast("string")}
    )
    return apply_changes(docs, changes).select(
        "document_id", F.col("full_text_path").isNotNull().alias("has_path"), "raw_hash"
    )


@query("export_json", SQL_EXPORT)
def export_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export written as JSON lines and read back."""
    path = scratch_path(spark, "export")
    exported = _export(spark, sf_dir)
    write_jsonl(exported, path)
    return read_jsonl(spark, path, ", ".join(f"{c} {t}" for c, t in exported.dtypes))


@query("qa_file", SQL_QA)
def qa_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report as a file."""
    path = scratch_path(spark, "qa")
    report = qa_report(_records(spark, sf_dir))
    write_report(report, path)
    return read_jsonl(spark, path, ", ".join(f"{c} {t}" for c, t in report.dtypes))


@query("optional_input", f"{DOCS} SELECT document_id, title FROM docs")
def optional_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with those of a second input that is not there."""
    docs = corpus_documents(spark, sf_dir).select("document_id", "title")
    schema = ", ".join(f"{c} {t}" for c, t in docs.dtypes)
    missing = read_jsonl(spark, scratch_path(spark, "missing"), schema, optional=True)
    return docs.unionByName(missing)


@query(
    "run_log_append",
    f"""{DOCS}, one AS (SELECT count(*) AS n, count(*) FILTER (pipeline_status NOT IN ('DISCOVERED', 'FAILED')) AS f,
  count(*) FILTER (pipeline_status = 'LOADED') AS l FROM docs)
SELECT 1 AS run_id, 'DONE' AS status, n AS discovered_count, f AS fetched_count, l AS inserted_count,
  CAST(NULL AS VARCHAR) AS error_message FROM one
UNION ALL SELECT 2, 'FAILED', n, f, 0, 'no space' FROM one""",
)
def run_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs added to the log one after the other."""
    docs = corpus_documents(spark, sf_dir)
    path = scratch_path(spark, "runs")
    now = F.current_timestamp()
    append_runs(run_log_row(docs, with_status(docs, "LOADED"), 1, now), path)
    append_runs(run_log_row(docs, docs.where("false"), 2, now, "FAILED", "no space"), path)
    return read_runs(spark, path).select(
        "run_id", "status", "discovered_count", "fetched_count", "inserted_count", "error_message"
    )


PROFILED = ["lipid_reagents_json", "payload", "administration_route", "cells_or_organisms"]


@query(
    "field_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) AS total_records, "
        f"count(*) FILTER (coalesce({c}, '') = '') AS n_missing, "
        f"round(100.0 * count(*) FILTER (coalesce({c}, '') = '') / count(*), 2)::DOUBLE AS missing_pct "
        f"FROM ({SQL_NORMALIZED})"
        for c in PROFILED
    ),
)
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_profile(_records(spark, sf_dir), PROFILED)


@query("single_source", "SELECT doc_id FROM corpus WHERE source_name = 'src3'")
def single_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = allowed_sources(corpus(spark, sf_dir), ALLOWED, only="src3", column="source_name")
    return found.select("doc_id")


@query(
    "status_limit",
    f"{DOCS} SELECT document_id FROM docs WHERE pipeline_status = 'FETCHED' ORDER BY document_id LIMIT 30",
)
def status_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first documents of a state; the limit is what a stage is asked for."""
    return with_status(corpus_documents(spark, sf_dir), "FETCHED", limit=30).select("document_id")


def _laid_out(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents partitioned by state and texts, both in the same buckets of ids."""
    docs, texts = scratch_path(spark, "documents"), scratch_path(spark, "texts")
    made = corpus(spark, sf_dir).select(F.col("doc_id").alias("document_id"), "text")
    return (
        write_layout(
            corpus_documents(spark, sf_dir), _table_name(docs), docs, 32, partition="pipeline_status"
        ),
        write_layout(made, _table_name(texts), texts, 32),
    )


def _table_name(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


@query(
    "layout_join",
    f"""{DOCS} SELECT document_id, d.title, doi, sha256(c.text) AS text_hash
FROM docs d JOIN corpus c ON c.doc_id = d.document_id WHERE pipeline_status = 'FETCHED'""",
)
def layout_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one state and their texts: one folder is read, and nothing is shuffled."""
    docs, texts = _laid_out(spark, sf_dir)
    fetched = docs.where(F.col("pipeline_status") == "FETCHED")
    return fetched.join(texts, "document_id").select(
        "document_id", "title", "doi", F.sha2("text", 256).alias("text_hash")
    )


@query(
    "layout_update",
    f"""{DOCS} SELECT document_id, CASE WHEN pipeline_status = 'DISCOVERED' THEN 'FETCHED'
  ELSE pipeline_status END AS pipeline_status,
  CASE WHEN pipeline_status = 'DISCOVERED' THEN sha256(c.text) END AS raw_hash
FROM docs d JOIN corpus c ON c.doc_id = d.document_id""",
)
def layout_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovered documents become fetched ones with the hash of their text, without a shuffle."""
    docs, texts = _laid_out(spark, sf_dir)
    waiting = docs.where(F.col("pipeline_status") == "DISCOVERED").select("document_id")
    changes = waiting.join(texts, "document_id").select(
        "document_id",
        F.lit("FETCHED").alias("pipeline_status"),
        F.sha2("text", 256).alias("raw_hash"),
    )
    current = docs.withColumn("raw_hash", F.lit(None).cast("string"))
    return apply_changes(current, changes).select("document_id", "pipeline_status", "raw_hash")
