"""Small expression helpers shared by the other function modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space as Python's str.strip sees it; java.util.regex knows another set.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A lambda that refers to an outer expression evaluates it again for every
    element; binding it as the only element of an array avoids that.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def evaluated(df: DataFrame) -> DataFrame:
    """The same rows, with all columns computed at this point.

    A filter on a computed column is pushed below the projection and computes the column
    again there. Generated columns cannot be pushed through, so rows packed into a struct
    and taken out again keep expensive columns from being computed twice.
    """
    return df.select(F.inline_outer(F.array(F.struct(*df.columns))))


def present(value: Column) -> Column:
    """Null for null and for the empty string (no trimming first)."""
    return F.when(value != "", value)


def first_present(*values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[present(v) for v in values])


def strip_space(text: Column) -> Column:
    """Remove leading and trailing white space of any Unicode kind."""
    return F.btrim(text, F.lit(SPACES))


def unique_ignoring_case(values: Column) -> Column:
    """Distinct strings compared in lower case: trimmed, non-empty, first spelling kept.

    Exact repeats go first with the hash-based ``array_distinct``; only the few
    remaining spellings are compared with each other.
    """

    def by_first_spelling(spellings: Column) -> Column:
        return let(
            F.transform(spellings, F.lower),
            lambda lowered: F.filter(
                spellings,
                lambda s, i: (s != "") & (F.array_position(lowered, F.lower(s)) == i + 1),
            ),
        )

    return let(F.array_distinct(F.transform(values, strip_space)), by_first_spelling)


def json_string_array(values: Column) -> Column:
    """Text of a JSON array of strings with ``", "`` between the elements.

    A quote inside an element is escaped, so the three characters replaced here
    can only be an element boundary.
    """
    return F.replace(_ascii_json(values), F.lit('","'), F.lit('", "'))


def _ascii_json(values: Column) -> Column:
    """JSON text of an array of strings in ASCII, with hexadecimal digits in lower case.

    A backslash of the text itself is doubled, so an escape follows an even number of them.
    """
    text = F.to_json(values, {"writeNonAsciiCharacterAsCodePoint": "true"})
    escape = r"(?<!\\)(?:\\\\)*\\u[0-9A-F]{4}"

    def lowered(t: Column) -> Column:
        around = F.split(t, escape, -1)
        found = F.regexp_extract_all(t, F.lit(f"({escape})"), F.lit(1))
        pairs = F.zip_with(
            around,
            found,
            lambda a, e: F.concat(
                a,
                F.coalesce(
                    F.concat(
                        F.substring(e, F.lit(1), F.length(e) - 4), F.lower(F.right(e, F.lit(4)))
                    ),
                    F.lit(""),
                ),
            ),
        )
        return F.array_join(pairs, "")

    return F.when(text.rlike(escape), let(text, lowered)).otherwise(text)


def json_scalar(value: Column) -> Column:
    """JSON text of one string or number; ``null`` for null."""
    text = F.to_json(F.array(value))
    return F.when(value.isNull(), F.lit("null")).otherwise(
        F.substring(text, F.lit(2), F.length(text) - 2)
    )


def json_object(fields: dict[str, Column]) -> Column:
    """Text of a JSON object, keys in the given order, ``": "`` and ``", "`` between."""
    parts: list[Column] = []
    for n, (name, value) in enumerate(fields.items()):
        parts.append(F.lit(("{" if n == 0 else ", ") + f'"{name}": '))
        parts.append(json_scalar(value))
    return F.concat(*parts, F.lit("}"))
