"""Title rules on a stream.  They keep no state, so batch and stream share the columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.bind import evaluate_once
from tagloom.functions.rules import classify_general


def label_stream(posts: DataFrame, title: str = "title", out: str = "category") -> DataFrame:
    return evaluate_once(posts, out, classify_general(F.col(title)))
