"""The tiers behind the title rules: model answers, article text, second model.

A scorer is any function from requests ``(item, text)`` to attempts ``(item,
attempt, status, response)``: a join with recorded answers, or a
``mapInPandas`` that calls a service.  It only ever sees distinct texts that no
cheaper tier has settled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import lexicon as lx
from tagloom.functions.bind import evaluate_once
from tagloom.functions.html import with_article_text
from tagloom.functions.model_io import MAX_ATTEMPTS, response_label
from tagloom.functions.rules import classify_strict, is_weak
from tagloom.functions.text import clean_title
from tagloom.operators.lineage import cut_lineage
from tagloom.operators.skew import spread_lookup

Scorer = Callable[[DataFrame], DataFrame]
Stage = Callable[[DataFrame], DataFrame]

OK = "ok"


@dataclass(frozen=True)
class Scorers:
    """First and second model, each for titles and for article bodies."""

    title_first: Scorer
    title_second: Scorer
    body_first: Scorer
    body_second: Scorer


def item_key(text: Column) -> Column:
    return F.sha2(text, 256)


def recorded(attempts: DataFrame) -> Scorer:
    """Scorer that looks answers up in a table of past attempts."""

    def score(requests: DataFrame) -> DataFrame:
        return requests.select("item").join(attempts, "item")

    return score


ATTEMPT_SHAPE = "item string, attempt int, status string, response string"


def remembered(scorer: Scorer, folder: str) -> Scorer:
    """Scorer that asks only for texts without a stored answer, and stores what it learns in ``folder``.

    Stored attempts are Parquet, one folder for each call and answers keyed by
    item.  A text counts as answered once an attempt succeeded; one whose
    attempts all failed is asked again.  Requests are anti-joined with the
    answered items before scoring, so that a run over grown input asks for the
    new texts alone, and a run that is lost leaves the answers of its finished
    calls.  The answers are written before they are used.
    """

    def score(requests: DataFrame) -> DataFrame:
        spark = requests.sparkSession
        store = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = store.getFileSystem(spark._jsc.hadoopConfiguration())
        calls = [s.getPath() for s in system.listStatus(store)] if system.exists(store) else []
        whole = [p.toString() for p in calls if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        read = spark.read.schema(ATTEMPT_SHAPE)
        stored = read.parquet(*sorted(whole)) if whole else spark.createDataFrame([], ATTEMPT_SHAPE)
        known = stored.filter((F.col("status") == OK) & F.col("attempt").between(1, MAX_ATTEMPTS))
        asked = requests.join(known.select("item").distinct(), "item", "left_anti")
        fresh = f"{folder.rstrip('/')}/call-{uuid.uuid4().hex}"
        kinds = [field.split() for field in ATTEMPT_SHAPE.split(", ")]
        scorer(asked).select(*[F.col(name).cast(kind) for name, kind in kinds]).write.parquet(fresh)
        mine = known.join(requests.select("item").distinct(), "item", "left_semi")
        return mine.union(read.parquet(fresh).select(*mine.columns))

    return score


def first_success(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """Response of the first attempt that did not fail, among those allowed."""
    tried = attempts.filter(
        (F.col("status") == OK) & F.col("attempt").between(1, MAX_ATTEMPTS)
    )
    return tried.groupBy(*keys).agg(
        F.min_by(F.struct("response"), "attempt").alias("first")
    ).select(*keys, "first.response")


def answers(scorer: Scorer, requests: DataFrame) -> DataFrame:
    """Label per item; an item whose attempts all failed has no row."""
    settled = first_success(scorer(requests), ["item"])
    return evaluate_once(settled, "label", response_label(F.col("response"))).select("item", "label")


def requests_of(rows: DataFrame, text: str) -> DataFrame:
    """Distinct texts with their number of rows: ``(item, text, n)``."""
    return (
        rows.filter(F.col("item").isNotNull())
        .groupBy("item")
        .agg(F.first(text).alias("text"), F.count("*").alias("n"))
    )


def articles_of(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Article text of distinct links, each page extracted once: ``(link, article_text)``.

    A link without a page, or with a page not worth reading, has no row.
    """
    wanted = pages.select(F.col("url").alias("link"), "html").join(links.select("link"), "link", "left_semi")
    return with_article_text(wanted).filter(F.col("article_text").isNotNull())


def article_sources(targets: DataFrame, pages: DataFrame) -> DataFrame:
    """Each target with the page behind its link, NULL when there is none."""
    links = targets.filter(F.col("link").isNotNull()).select("link").distinct()
    wanted = pages.withColumnRenamed("url", "link").join(links, "link", "left_semi")
    return spread_lookup(targets, wanted, "link", [F.col("workbook"), F.col("row_num")])


def article_categories(
    targets: DataFrame,
    pages: DataFrame,
    scorers: Scorers,
    stage: Stage = cut_lineage,
) -> DataFrame:
    """Category of each target from the page behind its link: ``(workbook, row_num, article)``.

    Staged, so no later use of the result calls a model again.
    """
    links = targets.filter(F.col("link").isNotNull()).select("link").distinct()
    labels = body_labels(articles_of(links, pages), scorers, stage=stage)
    found = spread_lookup(targets, labels, "link", [F.col("workbook"), F.col("row_num")])
    return stage(found.select("workbook", "row_num", "article"))


def body_labels(
    articles: DataFrame,
    scorers: Scorers,
    key: str = "link",
    stage: Stage = cut_lineage,
) -> DataFrame:
    """Label of each article: title rules on the body, first model, second model, fallback."""
    ruled = evaluate_once(articles, "rule", classify_strict(F.col("article_text")))
    is_open = F.col("rule").isNull()
    keyed = stage(
        ruled.withColumn("item", F.when(is_open, item_key(F.col("article_text"))))
        .withColumn("article_text", F.when(is_open, F.col("article_text")))
    )
    requests = requests_of(keyed, "article_text")
    first = stage(answers(scorers.body_first, requests))
    second = answers(scorers.body_second, requests.join(first, "item", "left_anti"))
    labelled = spread_lookup(keyed.select(key, "rule", "item"), first.unionByName(second), "item", [F.col(key)])
    return labelled.select(key, F.coalesce("rule", "label", F.lit(lx.SIMPLE)).alias("article"))


def resolve_categories(
    targets: DataFrame,
    pages: DataFrame,
    scorers: Scorers,
    stage: Stage = cut_lineage,
) -> DataFrame:
    """Category and method of each target ``(workbook, row_num, title, link)``.

    Rules settle most rows and those never meet a join.  The rest passes the
    tiers in order; every text is scored once and every page read once however
    many rows share it.  ``stage`` runs after each tier and on the result, so
    neither a later tier nor any use of the result calls a model again.
    """
    row_id = [F.col("workbook"), F.col("row_num")]
    cleaned = evaluate_once(targets, "title", clean_title(F.col("title")))
    ruled = stage(evaluate_once(cleaned, "rule", classify_strict(F.col("title"))))
    is_open = F.col("title").isNotNull() & F.col("rule").isNull()
    settled = ruled.filter(~is_open).select(
        "workbook", "row_num", "link",
        F.when(F.col("title").isNull(), F.lit(lx.SIMPLE)).otherwise(F.col("rule")).alias("category"),
        F.when(F.col("title").isNull(), F.lit("empty")).otherwise(F.lit("rule")).alias("method"),
    )
    rows = (
        ruled.filter(is_open).drop("rule")
        .withColumn("link", F.when(F.col("link") != "", F.col("link")))
        .withColumn("item", item_key(F.col("title")))
    )

    # First model on the title.
    titles = requests_of(rows, "title")
    first = answers(scorers.title_first, titles).withColumnRenamed("label", "first")
    rows = spread_lookup(rows, first, "item", row_id)
    weak = is_weak(F.col("first"))
    wants_page = F.col("first").isNull() | weak
    rows = stage(rows.withColumn("page", F.when(wants_page, F.col("link"))))

    # The article behind the link.
    links = rows.filter(F.col("page").isNotNull()).select(F.col("page").alias("link")).distinct()
    articles = body_labels(articles_of(links, pages), scorers, stage=stage)
    rows = spread_lookup(rows, articles.withColumnRenamed("link", "page"), "page", row_id)
    wants_second = F.col("first").isNull() & F.col("article").isNull()
    rows = stage(rows.withColumn("item", F.when(wants_second, F.col("item"))))

    # Second model, only where the first failed and no article helped.
    last = requests_of(rows, "title")
    second = answers(scorers.title_second, last).withColumnRenamed("label", "second")
    rows = spread_lookup(rows, second, "item", row_id)

    strong = F.col("first").isNotNull() & ~weak
    resolved = rows.select(
        "workbook", "row_num", "link",
        F.when(strong, F.col("first"))
        .otherwise(F.coalesce("article", "first", "second", F.lit(lx.SIMPLE)))
        .alias("category"),
        F.when(strong, F.lit("llm"))
        .when(F.col("article").isNotNull() | F.col("first").isNotNull(), F.lit("article"))
        .otherwise(F.lit("fallback"))
        .alias("method"),
    )
    return stage(settled.unionByName(resolved))


def title_categories(
    titles: DataFrame, pages: DataFrame, scorers: Scorers, stage: Stage = cut_lineage
) -> DataFrame:
    """Category from the title alone, as if no row had a link."""
    unlinked = titles.withColumn("link", F.lit(None).cast("string"))
    return resolve_categories(unlinked, pages, scorers, stage=stage).select(
        "workbook", "row_num", "category"
    )
