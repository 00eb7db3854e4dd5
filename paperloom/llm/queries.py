"""The registered queries of this subpackage, with SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import (
    bpe,
    importance,
    jaccard_join,
    langid,
    lexical_search,
    line_dedup,
    main_text,
    mixing,
    near_vectors,
    token_files,
    topk_search,
    toxicity,
    url_filter,
)
from paperloom.llm.shared import table
from paperloom.session import written

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


SQL_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op1_line_dedup",
    f"""
WITH lines AS (
  SELECT doc_id, i AS pos, ls[i] AS line, {SQL_LOWER.format(f"trim(ls[i], {SQL_BLANKS})")} AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
       unnest(generate_series(1, len(ls))) AS t(i)),
frequent AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN f.key IS NULL THEN line END, chr(10) ORDER BY pos), ''))
    AS kept_sha256
FROM lines LEFT JOIN frequent f USING (key) GROUP BY doc_id
""",
)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs, min_docs=10)
    return kept.select(
        "row.doc_id",
        "kept.n_lines",
        "kept.n_dropped",
        F.sha2(F.col("kept.text"), 256).alias("kept_sha256"),
    )


@query("op2_mixing")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, weights=[5, 2, 1], share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "epochs", "part")


@query("op3_langid")
def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = held_out_column(F.col("doc_id"))
    model = langid.train(docs, usable=~held_out)
    found = langid.predict(docs, model, carry=["doc_id"])
    return found.select(
        "row.doc_id",
        held_out_column(F.col("row.doc_id")).alias("held_out"),
        "lang_pred",
        "score",
    )


def held_out_column(doc_id: Column) -> Column:
    """True for the documents that no model may learn from; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "utf-8")) % 4 == 2


SQL_WEIGHTS = """
SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w
FROM embeddings
WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""


@query(
    "op4_topk_search",
    f"""
WITH v AS ({SQL_WEIGHTS}),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM pairs)
WHERE rank <= 5
""",
)
def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_search.quantized(table(spark, sf_dir, "embeddings"))
    return topk_search.top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5)


SQL_SHINGLES = """
SELECT doc_id, CASE WHEN len(w) >= 4
    THEN list_distinct(list_transform(generate_series(1, len(w) - 3),
      lambda i: array_to_string(w[i:i + 3], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END AS s
FROM (SELECT doc_id, regexp_extract_all({lowered}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents)
"""


@query(
    "op6_jaccard_join",
    f"""
WITH RECURSIVE sets AS MATERIALIZED ({SQL_SHINGLES.format(lowered=SQL_LOWER.format("coalesce(text, '')"))}),
parts AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM parts a JOIN parts b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reach r USING (doc_id) GROUP BY s.doc_id, len(s.s)
""",
)
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    joined = jaccard_join.join_documents(docs, similarity=(85, 100), width=4)
    return joined.select("doc_id", "n_shingles", "component_id")


@query(
    "op7_near_vectors",
    """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT r.vec_id, coalesce(any_value(d.n), 0) AS n_links, min(r.other) AS component_id,
  min(r.other) = r.vec_id AS kept
FROM reach r LEFT JOIN degree d ON d.vec_id = r.vec_id GROUP BY r.vec_id
""",
)
def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.link_vectors(table(spark, sf_dir, "embeddings"), min_cosine=0.98)


@query("op8_bpe")
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode_texts(docs, model, carry=["doc_id"])
    return coded.select(
        "row.doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query("op9_main_text")
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = main_text.extract(pages, carry=["page_id", "url"])
    return found.select(
        "row.page_id",
        "row.url",
        F.col("main_text").alias("text"),
        F.char_length("main_text").cast("bigint").alias("n_chars"),
    )


@query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = token_files.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_files.read_tokens(files, with_ids=False)


RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


def _sql_rule(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


# The given pages declare no canonical links or redirects, so their aliases decide nothing.
@query(
    "op10_url_filter",
    f"""
WITH parts AS (
  SELECT page_id,
    {SQL_LOWER.format("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')")} AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE WHEN {_sql_rule("example.net", "/en/")} THEN 'example.net/en/'
                 WHEN {_sql_rule("example.com", "/de/")} THEN 'example.com/de/'
                 WHEN {_sql_rule("org", "/fr/")} THEN 'org/fr/'
                 WHEN {_sql_rule("net", "/")} THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
""",
)
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = url_filter.filter_urls(
        pages.select("page_id", "url"), RULES, url_filter.page_links(pages)
    )
    return judged.select("row.page_id", "judged.*")


SQL_WORDS = (
    f"regexp_extract_all({SQL_LOWER.format("coalesce(text, '')")}, "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)


@query(
    "op11_lexical_search",
    f"""
WITH words AS (SELECT doc_id, unnest({SQL_WORDS}) AS w FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_words FROM lengths),
freq AS (SELECT doc_id, w, count(*) AS tf FROM words GROUP BY doc_id, w),
terms AS (SELECT DISTINCT item_id, w FROM (SELECT item_id, unnest({SQL_WORDS}) AS w FROM benchmark)),
weights AS (
  SELECT w, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM freq, total GROUP BY w, n_docs),
scores AS (
  SELECT item_id, doc_id, sum(weight * ((1000000000 * tf)
    // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_words))))::BIGINT AS score
  FROM terms JOIN freq USING (w) JOIN weights USING (w) JOIN lengths USING (doc_id), total
  GROUP BY item_id, doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM scores WHERE score > 0)
WHERE rank <= 50
""",
)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    pairs = written(lexical_search.item_terms(items, "item_id", "text"), "item-terms")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = lexical_search.build_index(docs, terms=pairs.select("term"))
    return lexical_search.search(index, pairs, k=50)


@query("op12_toxicity")
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = unlabelled_column(F.col("doc_id"))
    model = toxicity.train(docs, labels, usable=~held_out)
    judged = toxicity.predict(docs, model, bar=0.7, carry=["doc_id"])
    return judged.select(
        "row.doc_id",
        unlabelled_column(F.col("row.doc_id")).alias("held_out"),
        "score",
        "predicted",
    )


def unlabelled_column(doc_id: Column) -> Column:
    """True for the documents whose labels no model may learn; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "utf-8")) % 3 == 1


@query(
    "op13_importance",
    f"""
WITH RECURSIVE
bits(b, c, i) AS (  -- the table of crc32, eight steps for each byte
  SELECT b::BIGINT, b::BIGINT, 0 FROM generate_series(0, 255) AS t(b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE i = 8),
words AS MATERIALIZED (SELECT 0 AS k, doc_id AS id, unnest({SQL_WORDS}) AS w FROM documents
  UNION ALL SELECT 1, item_id, unnest({SQL_WORDS}) FROM benchmark),
spelled AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words)),
hashed AS MATERIALIZED (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(generate_series(1, length(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM spelled, crc),
counts AS (
  SELECT b AS bucket, count(w) FILTER (k = 0) AS s, count(w) FILTER (k = 1) AS t
  FROM generate_series(0, 9999) AS g(b) LEFT JOIN (FROM words JOIN hashed USING (w)) x ON x.bucket = b
  GROUP BY b),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE)
    / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts),
weights AS (
  SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS weight
  FROM words JOIN hashed USING (w) JOIN gains USING (bucket) WHERE k = 0 GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT) AS score
  FROM documents LEFT JOIN weights ON doc_id = id),
able AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN able USING (doc_id)
""",
)
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = importance.draw(docs, table(spark, sf_dir, "benchmark").select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
