"""Quality report over extracted records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_MISSING_PCT = 20.0


def field_profile(records: DataFrame, fields: list[str]) -> DataFrame:
    """One row per field: records, records without it (null or empty text), their share in percent.

    One aggregate over all fields.
    """
    missing = [F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) == "") for c in fields]
    counted = records.agg(
        F.count("*").alias("total_records"),
        F.array(
            *[F.struct(F.lit(c).alias("field"), n.alias("n_missing")) for c, n in zip(fields, missing)]
        ).alias("found"),
    ).select("total_records", F.inline("found"))
    pct = F.when(
        F.col("total_records") > 0, F.round(F.col("n_missing") * 100 / F.col("total_records"), 2)
    ).otherwise(F.lit(0.0))
    return counted.select("field", "total_records", "n_missing", pct.alias("missing_pct"))


def qa_report(
    records: DataFrame, threshold_pct: float = MAX_MISSING_PCT, field: str = "lipid_reagents_json"
) -> DataFrame:
    """One row: totals, share of records without the field, and whether it is tolerable.

    Null and the empty string are missing; an empty JSON list is not. No records at all
    count as zero percent missing.
    """
    value = F.col(field)
    counted = records.agg(
        F.count("*").alias("total_records"),
        F.count_if(value.isNull() | (value == "")).alias("missing_lipid_fields"),
    )
    pct = F.when(
        F.col("total_records") > 0,
        F.bround(F.col("missing_lipid_fields") / F.col("total_records") * 100, 2),
    ).otherwise(F.lit(0.0))
    return counted.withColumns(
        {"missing_lipid_fields_pct": pct, "threshold_pct": F.lit(float(threshold_pct))}
    ).withColumn("passed", F.col("missing_lipid_fields_pct") <= F.col("threshold_pct"))
