"""Map landed API responses of each source onto one document schema.

A source is a response schema, the place of the items in it, and a function from one item
to the common columns. Register another :class:`Source` to add one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from paperloom import schemas
from paperloom.functions.exprs import first_present, present
from paperloom.functions.identifiers import DOI_SITE, clean_doi, guarded_abstract
from paperloom.operators.ranking import first_wins_wide

Fields = dict[str, Column | str | None]

COMMON_COLUMNS = [
    "source_name",
    "external_id",
    "title",
    "doi",
    "pmid",
    "pmcid",
    "journal_or_site",
    "publication_date",
    "source_url",
    "abstract_text",
]
# ingest_seq: source rank, response_seq and position in the response, 7 + 36 + 20 bits.
POSITION_BITS = 20
CORRUPT = "_corrupt"
OPTIONS = {"columnNameOfCorruptRecord": CORRUPT}
RESPONSE_BITS = 36


@dataclass(frozen=True)
class Source:
    name: str
    schema: str
    items: str
    fields: Callable[[Column], Fields]
    max_items: int | None = None

    @property
    def landed_schema(self) -> str:
        """The response schema with room for the text of a response that does not parse."""
        return f"{self.schema.rstrip()[:-1]}, {CORRUPT}: STRING>"

    @property
    def item_schema(self) -> DataType:
        found = DataType.fromDDL(self.schema)
        for name in self.items.split("."):
            found = found[name].dataType
        return found.elementType

    @property
    def raw_schema(self) -> StructType:
        """The place of the items in a response, each of them as text."""
        found: DataType = ArrayType(StringType())
        for name in reversed(self.items.split(".")):
            found = StructType([StructField(name, found)])
        return StructType([*found.fields, StructField(CORRUPT, StringType())])


def _title_or_unknown(title: Column) -> Column:
    return first_present(title, F.lit("Unknown"))


def _first_or(values: Column, default: str) -> Column:
    return F.when(F.size(values) > 0, F.get(values, F.lit(0))).otherwise(F.lit(default))


def pubmed_fields(item: Column) -> Fields:
    # An item without any summary field is an empty summary and is left out.
    summary = [item[c] for c in ("elocationid", "title", "fulljournalname", "pubdate")]
    pmid = F.when(F.coalesce(*summary).isNotNull(), item["pmid"])
    return {
        "external_id": pmid,
        "title": _title_or_unknown(item["title"]),
        "doi": clean_doi(item["elocationid"]),
        "pmid": pmid,
        "journal_or_site": item["fulljournalname"],
        "publication_date": item["pubdate"],
        "source_url": F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/")),
        "abstract_text": guarded_abstract(item["abstract"]),
    }


def europepmc_fields(item: Column) -> Fields:
    uid = first_present(item["id"], item["pmid"], item["doi"])
    return {
        "external_id": uid,
        "title": _title_or_unknown(item["title"]),
        "doi": item["doi"],
        "pmid": item["pmid"],
        "pmcid": item["pmcid"],
        "journal_or_site": item["journalTitle"],
        "publication_date": F.coalesce(item["pubYear"], F.lit("")),
        "source_url": F.concat_ws(
            "/",
            F.lit("https://europepmc.org/article"),
            F.coalesce(item["source"], F.lit("MED")),
            uid,
        ),
        "abstract_text": item["abstractText"],
    }


def preprint_fields(server: str, site: str) -> Callable[[Column], Fields]:
    def fields(item: Column) -> Fields:
        return {
            "external_id": first_present(item["doi"], item["title"]),
            "title": _title_or_unknown(item["title"]),
            "doi": item["doi"],
            "journal_or_site": server,
            "publication_date": item["date"],
            "source_url": site,
            "abstract_text": item["abstract"],
        }

    return fields


def _quoted(text: Column) -> Column:
    """A string the way Python shows it inside a list."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    single = F.contains(escaped, F.lit("'"))
    double = F.contains(escaped, F.lit('"'))
    return F.when(single & ~double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def crossref_fields(item: Column) -> Fields:
    shown = F.transform(item["title"], lambda t: F.coalesce(_quoted(t), F.lit("None")))
    title_as_id = F.concat(
        F.lit("["), F.array_join(F.coalesce(shown, F.array(F.lit("''"))), ", "), F.lit("]")
    )
    printed = item["published-print"]["date-parts"]
    online = item["published-online"]["date-parts"]
    date = F.get(F.coalesce(printed, online), F.lit(0))
    year = F.when(F.size(date) > 0, F.coalesce(F.get(date, F.lit(0)).cast("string"), F.lit("None")))
    return {
        "external_id": first_present(item["DOI"], title_as_id),
        "title": _first_or(item["title"], "Unknown"),
        "doi": item["DOI"],
        "journal_or_site": _first_or(item["container-title"], ""),
        "publication_date": F.coalesce(year, F.lit("")),
        "source_url": item["URL"],
        "abstract_text": item["abstract"],
    }


def openalex_fields(item: Column) -> Fields:
    return {
        "external_id": first_present(item["id"], item["doi"]),
        "title": _title_or_unknown(item["display_name"]),
        "doi": present(F.replace(item["doi"], F.lit(DOI_SITE), F.lit(""))),
        "journal_or_site": item["primary_location"]["source"]["display_name"],
        "publication_date": item["publication_year"].cast("string"),
        "source_url": item["id"],
        "abstract_text": None,
    }


def semantic_scholar_fields(item: Column) -> Fields:
    ids = item["externalIds"]
    return {
        "external_id": first_present(ids["DOI"], item["url"], item["title"]),
        "title": _title_or_unknown(item["title"]),
        "doi": ids["DOI"],
        "pmid": ids["PubMed"],
        "pmcid": ids["PubMedCentral"],
        "journal_or_site": item["venue"],
        "publication_date": item["year"].cast("string"),
        "source_url": item["url"],
        "abstract_text": item["abstract"],
    }


def doaj_fields(item: Column) -> Fields:
    bib = item["bibjson"]
    doi = F.get(F.filter(bib["identifier"], lambda i: i["type"] == "doi"), F.lit(0))["id"]
    return {
        "external_id": first_present(doi, bib["title"]),
        "title": _title_or_unknown(bib["title"]),
        "doi": doi,
        "journal_or_site": bib["journal"]["title"],
        "publication_date": bib["year"],
        "source_url": F.get(bib["link"], F.lit(0))["url"],
        "abstract_text": bib["abstract"],
    }


SOURCES: dict[str, Source] = {
    s.name: s
    for s in (
        Source("PubMed", schemas.PUBMED_RESPONSE, "result", pubmed_fields),
        Source("Europe PMC", schemas.EUROPEPMC_RESPONSE, "resultList.result", europepmc_fields),
        Source(
            "bioRxiv",
            schemas.PREPRINT_RESPONSE,
            "collection",
            preprint_fields("bioRxiv", "https://www.biorxiv.org"),
        ),
        Source(
            "medRxiv",
            schemas.PREPRINT_RESPONSE,
            "collection",
            preprint_fields("medRxiv", "https://www.medrxiv.org"),
        ),
        Source("Crossref", schemas.CROSSREF_RESPONSE, "message.items", crossref_fields),
        Source("OpenAlex", schemas.OPENALEX_RESPONSE, "results", openalex_fields),
        Source(
            "Semantic Scholar", schemas.SEMANTIC_SCHOLAR_RESPONSE, "data", semantic_scholar_fields
        ),
        Source("DOAJ", schemas.DOAJ_RESPONSE, "results", doaj_fields),
    )
}


def _sequence(rank: int) -> Column:
    seq, pos = F.col("response_seq"), F.col("pos").cast("bigint")
    fits = seq.between(0, (1 << RESPONSE_BITS) - 1) & (pos < (1 << POSITION_BITS))
    packed = (
        F.lit(rank << (RESPONSE_BITS + POSITION_BITS)).cast("bigint")
        + F.shiftleft(seq, POSITION_BITS)
        + pos
    )
    return F.when(fits, packed).otherwise(
        F.raise_error(F.lit("response_seq or position too large for ingest_seq")).cast("bigint")
    )


def map_responses(
    landed: DataFrame, source: Source, rank: int = 0, max_results: int | None = None
) -> DataFrame:
    """Documents of landed responses (response_seq, response), one row per item with an id.

    ``response`` is JSON text or already a struct of the source's schema. All items of a
    response are used, unless ``max_results`` or the source sets a limit; a field of another
    type than the schema's is null, without a loss of the others. What does not parse has no
    rows here and is what ``rejected_responses`` gives. The mapping needs no shuffle and works
    on streams too.
    """
    caps = [c for c in (max_results, source.max_items) if c is not None]
    items = F.col(f"response.{source.items}")
    if dict(landed.dtypes)["response"] == "string":
        landed = _parsed(landed, source)
        items = F.when(F.col(f"response.{CORRUPT}").isNull(), items).otherwise(
            _items_one_by_one(source)
        )
    # The plain form of the generator would add a filter on the size of the list, which is
    # pushed below the projection that parses the response and parses it a second time.
    items = landed.select(
        "response_seq", F.posexplode_outer(items).alias("pos", "item")
    ).where(F.col("pos") < min(caps) if caps else F.col("pos").isNotNull())
    fields = source.fields(F.col("item"))
    columns = [F.lit(source.name).alias("source_name")]
    for c in COMMON_COLUMNS[1:]:
        value = fields.get(c)
        column = value if isinstance(value, Column) else F.lit(value)
        columns.append(column.cast("string").alias(c))
    return items.select(*columns, _sequence(rank).alias("ingest_seq")).where(
        present(F.col("external_id")).isNotNull()
    )


def _parsed(landed: DataFrame, source: Source) -> DataFrame:
    """Landed responses with their text as ``_text``, and ``response`` parsed as a whole."""
    return landed.withColumn("_text", F.col("response")).withColumn(
        "response", F.from_json("response", source.landed_schema, OPTIONS)
    )


def _raw_items(source: Source) -> Column:
    return F.from_json("_text", source.raw_schema, OPTIONS)


def _items_one_by_one(source: Source) -> Column:
    """Items of a response that does not parse as a whole: null if it is no object with a list.

    Parsed as a whole, one item of another type, or with such a part, takes all items with it.
    """
    raw = _raw_items(source)
    texts = raw
    for name in source.items.split("."):
        texts = texts[name]
    schema = source.item_schema
    return F.when(
        raw[CORRUPT].isNull(),
        F.transform(texts, lambda t: F.when(F.startswith(t, F.lit("{")), F.from_json(t, schema))),
    )


def rejected_responses(landed: DataFrame, source: Source) -> DataFrame:
    """Landed responses that give no documents because they cannot be read.

    Rows (source_name, response_seq, reason, response): ``missing`` for null or blank text,
    ``malformed`` for text that is no JSON object with the source's list of items.
    """
    parsed = _parsed(landed, source)
    blank = F.col("_text").isNull() | (F.trim("_text") == "")
    malformed = F.col("response").isNull() | (
        F.col(f"response.{CORRUPT}").isNotNull() & _raw_items(source)[CORRUPT].isNotNull()
    )
    reason = F.when(blank, "missing").when(malformed, "malformed")
    return parsed.where(blank | malformed).select(
        F.lit(source.name).alias("source_name"),
        "response_seq",
        reason.alias("reason"),
        F.col("_text").alias("response"),
    )


def discover(
    landed: dict[str, DataFrame],
    max_results: int | None = None,
    sources: dict[str, Source] | None = None,
) -> DataFrame:
    """Documents of all landed sources, the first of each id within its source.

    The order of ``landed`` is the order of the sources.
    """
    known = sources or SOURCES
    mapped = [
        map_responses(df, known[name], rank, max_results)
        for rank, (name, df) in enumerate(landed.items())
    ]
    everything = reduce(DataFrame.unionByName, mapped)
    return first_wins_wide(everything, ["source_name", "external_id"], "ingest_seq").withColumn(
        "pipeline_status", F.lit("DISCOVERED")
    )
