"""Regular-expression extraction of formulation fields from text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.exprs import (
    json_string_array,
    present,
    strip_space,
    unique_ignoring_case,
)
from paperloom.functions.patterns import any_of
from paperloom.functions.vocab import DEFAULT_VOCABULARY, RATIO_TAIL, Vocabulary

EVIDENCE_CHARS = 500
RATIO_NUMBERS = r"\d+(?:\.\d+)?(?::\d+(?:\.\d+)?)+"

# Points out of 100 that each field adds to the confidence.
POINTS = {"lipids": 40, "payload": 20, "cells": 15, "route": 15, "ratio": 10}


def _all_matches(text: Column, pattern: str) -> Column:
    hits = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))
    return unique_ignoring_case(hits)


def extract_lipids(
    text: Column, vocab: Vocabulary = DEFAULT_VOCABULARY, whole_words: bool = False
) -> Column:
    """Array of lipid names in order of appearance; empty if there are none."""
    return _all_matches(text, any_of(vocab.lipids, whole_words))


def extract_ratio(text: Column, vocab: Vocabulary = DEFAULT_VOCABULARY) -> Column:
    """First ratio cue with what follows it up to a line end, stop or colon."""
    return strip_space(F.regexp_substr(text, F.lit(any_of(vocab.ratio_cues) + RATIO_TAIL)))


def extract_payload(
    text: Column, vocab: Vocabulary = DEFAULT_VOCABULARY, whole_words: bool = False
) -> Column:
    return F.regexp_substr(text, F.lit(any_of(vocab.payloads, whole_words)))


def extract_route(
    text: Column, vocab: Vocabulary = DEFAULT_VOCABULARY, whole_words: bool = False
) -> Column:
    return F.regexp_substr(text, F.lit(any_of(vocab.routes, whole_words)))


def extract_cell_list(
    text: Column, vocab: Vocabulary = DEFAULT_VOCABULARY, whole_words: bool = False
) -> Column:
    return _all_matches(text, any_of(vocab.cells, whole_words))


def extract_cells(
    text: Column, vocab: Vocabulary = DEFAULT_VOCABULARY, whole_words: bool = False
) -> Column:
    """Cells and organisms joined with ``", "``; null if there are none."""
    return present(F.array_join(extract_cell_list(text, vocab, whole_words), ", "))


def parse_ratio(text: Column) -> Column:
    """Numbers of the first ``a:b:...`` group in the text, null without one."""
    parts = F.split(F.regexp_substr(text, F.lit(RATIO_NUMBERS)), ":")
    return F.transform(parts, lambda p: p.try_cast("double"))


def confidence(
    lipids: Column, payload: Column, cells: Column, route: Column, ratio: Column
) -> Column:
    """Score between 0 and 1; whole points are added, so no rounding is needed."""
    found = {
        "lipids": F.size(lipids) > 0,
        "payload": F.length(payload) > 0,
        "cells": F.length(cells) > 0,
        "route": F.length(route) > 0,
        "ratio": F.length(ratio) > 0,
    }
    points = [F.when(found[name], F.lit(p)).otherwise(F.lit(0)) for name, p in POINTS.items()]
    total = points[0]
    for p in points[1:]:
        total = total + p
    return F.least(total, F.lit(100)) / F.lit(100.0)


def extract_all(
    df: DataFrame,
    text: str,
    vocab: Vocabulary = DEFAULT_VOCABULARY,
    whole_words: bool = False,
    parse_ratios: bool = False,
) -> DataFrame:
    """Add all extracted fields; columns of the same name are replaced.

    The text is searched in one projection, and everything derived from the hits in the
    next, so that no search runs twice.
    """
    body = F.col(text)
    found = df.withColumns(
        {
            "lipid_reagents": extract_lipids(body, vocab, whole_words),
            "lipid_ratios_text": extract_ratio(body, vocab),
            "cells_or_organisms": extract_cells(body, vocab, whole_words),
            "payload": extract_payload(body, vocab, whole_words),
            "administration_route": extract_route(body, vocab, whole_words),
            "evidence_span": present(F.substring(body, 1, EVIDENCE_CHARS)),
        }
    )
    lipids = F.col("lipid_reagents")
    has_lipids = F.size(lipids) > 0
    numbers = (
        F.to_json(parse_ratio(body)) if parse_ratios else F.lit(None).cast("string")
    )
    return found.withColumns(
        {
            "lipid_mix_text": F.when(has_lipids, F.array_join(lipids, ", ")),
            "lipid_reagents_json": F.when(has_lipids, json_string_array(lipids)),
            "lipid_ratios_json": numbers,
            "other_relevant_info": F.lit(None).cast("string"),
            "extraction_confidence": confidence(
                lipids,
                F.col("payload"),
                F.col("cells_or_organisms"),
                F.col("administration_route"),
                F.col("lipid_ratios_text"),
            ),
        }
    )
