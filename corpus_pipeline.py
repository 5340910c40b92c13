"""The corpus pipeline: each stage applies one operator to all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import curriculum, jaccard_join, line_templates, packing, toxicity
from tagloom.llm.queries import tokenizer_path
from tagloom.llm.shared import free_name, ship_package, stage, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose toxicity reaches the threshold; without labels of both kinds all stay."""
    column = free_name(docs, "toxicity")
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"), column=column, unknown=toxicity.UNKNOWN)
    return scored.where(F.col(column) < toxicity.THRESHOLD).select(*docs.columns)


def recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines whose templates recur across documents; ``n_chars`` follows the text if there is one."""
    kept = line_templates.without_recurring(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near copies the document with the smallest id; rows without an id stay."""
    classes = jaccard_join.near_copies(docs)
    copies = classes.where("doc_id <> class_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights and put into training order; repeats are rows of their own.

    Documents at a cut are whole or left out, but where that misses a target by far.
    """
    return curriculum.training_order(docs, far=curriculum.FAR)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    pieces = packing.tokenise(docs, tokenizer_path())
    return packing.pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def shipped(apply: Stage) -> Stage:
    """The stage, with the package sent to the workers first."""

    @wraps(apply)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return apply(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", shipped(toxic_documents)),
    ("line dedup", shipped(recurring_lines)),
    ("n-gram Jaccard join", shipped(near_copies)),
    ("mixing", shipped(mixing)),
    ("packing", shipped(packed_sequences)),
]

#: Training, grouping of near copies and packing have no SQL form; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what each returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
