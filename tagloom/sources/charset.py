"""Bytes to text when the charset is only a guess."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: charsets tried after the declared one, in order ------------
FALLBACK_CHARSETS = ("utf-8", "cp949", "ms949", "euc-kr")


def _strict_decoder():
    """Arrow UDF over (bytes, declared charset); built here so workers get it by value."""
    fallbacks = FALLBACK_CHARSETS

    def decode(contents: pd.Series, declared: pd.Series) -> pd.Series:
        def one(data, charset):
            if data is None:
                return None
            for name in (charset, *fallbacks):
                if not name:
                    continue
                try:
                    return bytes(data).decode(name)
                except (UnicodeDecodeError, LookupError):
                    continue
            return bytes(data).decode("utf-8", errors="ignore")

        return pd.Series([one(d, c) for d, c in zip(contents, declared)], dtype=object)

    return F.pandas_udf(decode, "string")


def decode_page(content: Column, declared: Column) -> Column:
    """Text of raw page bytes; empty bytes give NULL.

    The declared charset is tried first, then the fallbacks, each strictly; if
    none fits, the bytes are read as UTF-8 without the bad ones.  A declared
    charset that does not exist is skipped.  Valid UTF-8 declared as such, or
    not declared, never leaves the JVM.
    """
    plain_utf8 = F.coalesce(F.lower(declared), F.lit("utf-8")).isin("", "utf-8", "utf8", "us-ascii", "ascii")
    fast = plain_utf8 & F.is_valid_utf8(content)
    present = F.length(content) > 0
    slow = _strict_decoder()(F.when(present & ~fast, content), declared)
    return F.when(present & fast, F.decode(content, "UTF-8")).otherwise(slow)
