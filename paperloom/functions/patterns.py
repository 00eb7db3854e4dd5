"""Regular expressions for word lists, arranged so that most positions fail at once.

``a|b|c`` in ignore-case mode compares every alternative at every position of the text.
Alternatives with different first letters cannot match at the same position, so grouping
them by first and second letter keeps both the matches and their preference, and a look
ahead on the set of first letters rejects most positions with one set lookup.
"""

from __future__ import annotations

# Characters outside ASCII that equal a letter when case is ignored.
FOLDS = {"s": "ſ", "k": "K", "i": "İı"}

IGNORE_CASE = "(?iuU)"


def _literal_start(alternative: str) -> bool:
    """Whether the first character stands for itself, exactly once."""
    first, following = alternative[:1], alternative[1:2]
    is_plain = first.isascii() and (first.isalnum() or first in "- ")
    return is_plain and following not in ("?", "*", "+", "{") and "|" not in alternative


def _one_of(letters: list[str]) -> str:
    forms = "".join(
        sorted({f for x in letters for f in (x.lower(), x.upper(), *FOLDS.get(x.lower(), ""))})
    )
    return "(?-iu:[" + forms.replace("-", r"\-") + "])"


def _grouped(alternatives: list[str], depth: int) -> str:
    if depth == 0 or len(alternatives) == 1 or not all(map(_literal_start, alternatives)):
        return "|".join(alternatives)
    groups: dict[str, list[str]] = {}
    for a in alternatives:
        groups.setdefault(a[0].lower(), []).append(a[1:])
    return "|".join(
        f"{_one_of([first])}(?:{_grouped(rests, depth - 1)})" for first, rests in groups.items()
    )


def any_of(alternatives: tuple[str, ...], whole_words: bool = False) -> str:
    """Pattern for the first alternative that matches, ignoring case as Unicode does."""
    body = f"(?:{_grouped(list(alternatives), depth=2)})"
    if all(map(_literal_start, alternatives)):
        body = f"(?={_one_of([a[0] for a in alternatives])}){body}"
    return IGNORE_CASE + (rf"\b{body}\b" if whole_words else body)
