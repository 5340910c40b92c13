"""Article text out of a page's HTML."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import lexicon as lx
from tagloom.functions.bind import evaluate_once, let
from tagloom.functions.text import blank_to_null, contains_any, strip

# --- fixed values: class-name pairs of the article container, in order of preference
CONTAINER_CLASSES = (
    ("article", "viewer"),
    ("viewer", "article"),
    ("artice", "viewer"),
    ("viewer", "artice"),
)


def entity_decoder():
    """Arrow UDF that decodes HTML entities.

    Built inside a function so that workers get it by value and need no copy
    of this package.
    """

    def decode(texts: pd.Series) -> pd.Series:
        import html

        return texts.map(html.unescape, na_action="ignore")

    return F.pandas_udf(decode, "string")


# --- fixed values: patterns of containers, scripts, notices and tags -----------
# Group 2 of the container keeps the closing tag, so a match is never empty.
CONTAINER = r"""(?isU)<([a-zA-Z0-9]+)[^>]*class=["'][^"']*\bFIRST\b[^"']*\bSECOND\b[^"']*["'][^>]*>(.*?</\1>)"""
SCRIPTS = r"(?isU)<(script|style|noscript)\b[^>]*>.*?</\1>"
NOTICE = r"(?is)<[^>]+>[^<]*\QPHRASE\E[^<]*</[^>]+>"
TAG = "<[^>]+>"


def _container_pattern(first: str, second: str) -> str:
    return CONTAINER.replace("FIRST", first).replace("SECOND", second)


def article_container(html: Column) -> Column:
    """Content of the first article container that matches, else the whole page."""
    def chosen(page: Column) -> Column:
        found = F.coalesce(
            *[
                let(F.regexp_extract(page, _container_pattern(*classes), 2), blank_to_null)
                for classes in CONTAINER_CLASSES
            ]
        )
        inner = F.regexp_replace(found, "</[^<>]*>$", "")
        return F.when(page.rlike("(?i)viewer"), F.coalesce(inner, page)).otherwise(page)

    return let(html, chosen)


def without_scripts(html: Column) -> Column:
    return F.regexp_replace(html, SCRIPTS, " ")


def without_notices(html: Column, phrases: Sequence[str] = lx.NOTICE_PHRASES) -> Column:
    """Drop each notice with the element right around it, then the bare phrase."""
    for phrase in phrases:
        cleared = F.regexp_replace(html, NOTICE.replace("PHRASE", phrase), " ")
        html = F.when(
            html.contains(phrase), F.replace(cleared, F.lit(phrase), F.lit(" "))
        ).otherwise(html)
    return html


def tags_to_lines(html: Column) -> Column:
    return F.regexp_replace(html, TAG, "\n")


def needs_decoding(text: Column) -> Column:
    """The text where it has an ampersand, else NULL: only these travel to Python."""
    return F.when(text.contains("&"), text)


def squeezed(text: Column) -> Column:
    """Newline runs, then blank runs, become one; both ends are stripped; blank is NULL."""
    lines = F.regexp_replace(F.regexp_replace(text, "\n{2,}", "\n"), "(?: (?=[ \t])|\t)[ \t]*", " ")
    return let(strip(lines), blank_to_null)


def is_readable(text: Column) -> Column:
    """Neither a list of links nor page chrome."""
    slashes = F.length(text) - F.length(F.replace(text, F.lit("/"), F.lit("")))
    return (slashes <= lx.MAX_SLASHES) & ~contains_any(text, lx.PAGE_CHROME)


def with_article_text(df: DataFrame, html: str = "html", out: str = "article_text") -> DataFrame:
    """Add the readable text of a page's article, NULL when there is none.

    ``html`` is replaced by ``out``: no later step needs the raw page.
    """
    page, text = F.col(html), F.col(out)
    content = without_scripts(article_container(blank_to_null(page)))
    lined = evaluate_once(df, out, let(content, lambda c: tags_to_lines(without_notices(c)))).drop(html)
    decoded = lined.withColumn(out, F.coalesce(entity_decoder()(needs_decoding(text)), text))
    whole = evaluate_once(decoded, out, squeezed(text))
    return whole.withColumn(out, F.when(is_readable(text), text))
