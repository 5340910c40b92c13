"""Text columns: title cleaning, whitespace as Python sees it, token tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.bind import let, literal_list
from tagloom.functions.lexicon import FINAL_PREFIXES

# What str.strip() and str.split() treat as white space: as a character class, as
# the class without the plain space, and as a plain list of characters.
SPACE = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"
OTHER_SPACE = r"[\t\n\x0b\f\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SPACES = (
    " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# White space that is not already a single plain space, so that ordinary text
# is scanned but not rebuilt.
UNEVEN_SPACE = f"(?: (?={SPACE})|{OTHER_SPACE}){SPACE}*"


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends; inner white space stays."""
    return F.btrim(text, F.lit(SPACES))


def blank_to_null(text: Column) -> Column:
    """NULL for an empty string.  Mentions its input twice: bind a costly one with ``let``."""
    return F.when(text != "", text)


def clean_title(text: Column) -> Column:
    """Collapse each white-space run to one space, strip, and turn blank into NULL."""
    return let(F.trim(F.regexp_replace(text.cast("string"), UNEVEN_SPACE, " ")), blank_to_null)


def distinct_needles(tokens: tuple[str, ...]) -> list[str]:
    """The tokens that decide a containment test.

    A token that contains another token of the list can never change the
    outcome, so it is left out of the expression.
    """
    return [
        t for i, t in enumerate(tokens)
        if t not in tokens[:i] and not any(o != t and o in t for o in tokens)
    ]


def contains_any(text: Column, tokens: tuple[str, ...]) -> Column:
    """Whether ``text`` contains one of the tokens.

    ``exists`` over a literal array keeps the generated code small; a long OR
    of ``contains`` grows past the size the JIT compiles and runs slower.
    """
    needles = distinct_needles(tokens)
    if len(needles) <= 2:
        hit = text.contains(needles[0])
        for needle in needles[1:]:
            hit = hit | text.contains(needle)
        return hit
    return F.exists(literal_list(needles), lambda t: F.contains(text, t))


def final_label(value: Column) -> Column:
    """Whether a grid value already carries a final label; NULL is not final."""
    hit = value.startswith(FINAL_PREFIXES[0])
    for prefix in FINAL_PREFIXES[1:]:
        hit = hit | value.startswith(prefix)
    return F.coalesce(hit, F.lit(False))


def link_text(hyperlink: Column, value: Column) -> Column:
    """A hyperlink target wins over the cell text; an empty result is NULL."""
    return F.coalesce(blank_to_null(hyperlink), blank_to_null(value))
