"""Markup stripping, white space, and splitting text at section headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.exprs import SPACE, let, strip_space
from paperloom.functions.patterns import any_of

TAG = "<[^>]+>"

# Section headings, in order of preference.
SECTION_HEADINGS = (
    "abstract",
    "introduction",
    "methods?",
    "materials and methods",
    "results",
    "discussion",
    "conclusion",
)


def strip_tags(text: Column) -> Column:
    """Replace everything between ``<`` and the next ``>`` by one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), TAG, " ")


def collapse_space(text: Column) -> Column:
    """Trim and turn each run of white space into one space."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " "))


def clean(text: Column) -> Column:
    return collapse_space(strip_tags(text))


def split_sections(text: Column, headings: tuple[str, ...] = SECTION_HEADINGS) -> Column:
    """Map from heading to the text behind it.

    Headings match anywhere, also inside words, in any case. Text before the first
    heading is dropped; of equal headings the last one wins; without any heading the
    map holds the cleaned text under ``body``.
    """
    pattern = any_of(headings)
    text = F.coalesce(text, F.lit(""))
    keys = F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda k: F.replace(F.lower(k), F.lit(" "), F.lit("_")),
    )
    found = F.struct(keys.alias("keys"), F.split(text, pattern, -1).alias("parts"))

    def to_map(f: Column) -> Column:
        # parts[0] precedes the first heading, so parts[i] (counting from 1 in
        # element_at) behind heading number n is element n + 1.
        return let(
            F.reverse(f["keys"]),
            lambda back: F.map_from_entries(
                F.transform(
                    F.array_distinct(f["keys"]),
                    lambda k: F.struct(
                        k,
                        strip_space(
                            F.element_at(
                                f["parts"],
                                (F.size(back) - F.array_position(back, k) + 2).cast("int"),
                            )
                        ),
                    ),
                )
            ),
        )

    return let(
        found,
        lambda f: F.when(F.size(f["keys"]) > 0, to_map(f)).otherwise(
            F.create_map(F.lit("body"), clean(text))
        ),
    )


def sections_long(df: DataFrame, sections: str = "sections") -> DataFrame:
    """One row per document and section."""
    others = [c for c in df.columns if c != sections]
    # The map is never empty. The plain form would add a filter on its size, which is pushed
    # below the projection that builds the map and builds it a second time.
    return df.select(*others, F.explode_outer(sections).alias("section", "section_text"))
