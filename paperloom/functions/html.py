"""HTML to text with built-in expressions.

Supported: comments, doctype, processing instructions, tags with quoted attributes,
raw-text elements (script, style, template and ruby annotations are left out, to the end of
the text if they are not closed), named entities of HTML 4, those of Latin 1 also without a
semicolon, decimal and hexadecimal references.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.exprs import SPACE, first_present, let
from paperloom.functions.text import clean

LOOKS_LIKE_MARKUP = f"^{SPACE}*<"
# Whichever begins first hides the other: a comment may hold a script, a script a comment.
UNSHOWN = (
    r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|rt|rp)\b[^>]*>.*?(?:</\1\s*>|\z)"
)
ELEMENT_TAG = r"""<[A-Za-z/!?](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
# Fixed by the standard: entities that count without a semicolon; longer names come first.
BARE_ENTITIES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
ENTITY = (
    r"&(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;|(?:"
    + "|".join(BARE_ENTITIES)
    + "))"
)


def _named_entities() -> Column:
    names = {**{n: chr(c) for n, c in name2codepoint.items()}, "apos": "'"}
    names |= {n: html5[n] for n in BARE_ENTITIES}
    return F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.lit(c) for c in names.values()])
    )


def _decode_entity(entity: Column) -> Column:
    name = F.regexp_replace(entity, "^&|;$", "")
    digits = F.regexp_replace(name, "^#[xX]?", "")
    significant = F.regexp_replace(digits, "^0+(?=.)", "")
    hexadecimal = F.when(F.length(significant) <= 8, F.conv(significant, 16, 10))
    code = F.when(F.lower(name).startswith("#x"), hexadecimal).otherwise(digits)
    # Leading zeros say nothing; what is longer than 18 digits then is no character.
    code = F.regexp_replace(code, "^0+(?=.)", "")
    code = F.when(
        F.length(code) <= 18, F.try_to_number(code, F.lit("9" * 18)).cast("bigint")
    )
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(name.startswith("#"), F.when(valid, char)).otherwise(
        F.try_element_at(_named_entities(), name)
    )


def decode_entities(text: Column) -> Column:
    """Decode each reference once; unknown ones stay as they are."""

    def decoded(t: Column) -> Column:
        around = F.split(t, ENTITY, -1)
        chars = F.transform(
            F.regexp_extract_all(t, F.lit(ENTITY), F.lit(0)),
            lambda e: F.coalesce(_decode_entity(e), e),
        )
        return F.array_join(
            F.zip_with(around, chars, lambda a, c: F.concat(a, F.coalesce(c, F.lit("")))), ""
        )

    return F.when(F.contains(text, F.lit("&")), let(text, decoded)).otherwise(text)


def html_to_text(html: Column) -> Column:
    shown = F.regexp_replace(html, UNSHOWN, " ")
    return decode_entities(F.regexp_replace(shown, ELEMENT_TAG, " "))


def plain_text(payload: Column) -> Column:
    """Clean text of a payload that may or may not be markup."""
    payload = F.coalesce(payload, F.lit(""))
    return clean(
        F.when(F.regexp_like(payload, F.lit(LOOKS_LIKE_MARKUP)), html_to_text(payload)).otherwise(
            payload
        )
    )


def combined_text(abstract: Column, fulltext: Column) -> Column:
    """Cleaned abstract and full text with one space between, empty parts left out."""
    return F.concat_ws(" ", first_present(clean(abstract)), first_present(plain_text(fulltext)))

