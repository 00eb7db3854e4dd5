"""Canonical names through an alias table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.exprs import (
    json_string_array,
    present,
    strip_space,
    unique_ignoring_case,
)
from paperloom.functions.vocab import DEFAULT_VOCABULARY, Vocabulary


# An array of scalars and nothing else, up to white space around it.
_STRING = r'"(?:[^"\\\x00-\x1f]|\\["\\/bfnrt]|\\u[0-9A-Fa-f]{4})*+"'
_SCALAR = rf"(?:{_STRING}|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null)"
JSON_STRINGS = rf"^\s*\[\s*(?:{_SCALAR}\s*(?:,\s*{_SCALAR}\s*)*+)?\]\s*$"


def _alias_map(vocab: Vocabulary) -> Column:
    pairs = [F.lit(x) for pair in vocab.aliases.items() for x in pair]
    return F.create_map(*pairs)


def alias_key(value: Column) -> Column:
    """The form in which names are compared: trimmed, in lower case, no full stops around it."""
    return F.btrim(F.lower(strip_space(F.coalesce(value, F.lit("")))), F.lit(" ."))


def canonicalize(value: Column, vocab: Vocabulary = DEFAULT_VOCABULARY) -> Column:
    """Canonical name of the trimmed value; the value itself if it has no alias."""
    trimmed = strip_space(F.coalesce(value, F.lit("")))
    return F.coalesce(F.try_element_at(_alias_map(vocab), alias_key(value)), trimmed)


def normalize_lipids(values: Column, vocab: Vocabulary = DEFAULT_VOCABULARY) -> Column:
    """Canonical names, distinct ignoring case, empty ones dropped."""
    return unique_ignoring_case(F.transform(values, lambda v: canonicalize(v, vocab)))


def normalize_lipids_json(text: Column, vocab: Vocabulary = DEFAULT_VOCABULARY) -> Column:
    """The same on JSON text; text that is no JSON array stays as it is.

    The parser stops at the end of the array, so what else the text holds is checked too.
    """
    whole = text.rlike(JSON_STRINGS)
    parsed = F.when(whole, F.from_json(text, "array<string>"))
    return F.coalesce(json_string_array(normalize_lipids(parsed, vocab)), text)


def normalize_records(df: DataFrame, vocab: Vocabulary = DEFAULT_VOCABULARY) -> DataFrame:
    """Normalize lipids and route; mixture text and payload are left alone."""
    route = F.col("administration_route")
    changes = {
        "lipid_reagents_json": normalize_lipids_json(F.col("lipid_reagents_json"), vocab),
        "administration_route": F.when(
            present(route).isNotNull(), canonicalize(route, vocab)
        ).otherwise(route),
    }
    if "lipid_reagents" in df.columns:
        changes["lipid_reagents"] = normalize_lipids(F.col("lipid_reagents"), vocab)
    return df.withColumns(changes)
