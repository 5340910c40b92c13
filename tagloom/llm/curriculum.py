"""Mix sources to target weights along a curriculum whose weights change over training time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.shared import free_name, stage

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
FAR = 0.01
WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Share the sum of all sizes among ``sources(source, source_size)`` by weight.

    Sources take the weights in turn, by code point, null last.  No target
    exceeds ``most`` times its source; what is over goes to the others by
    weight.  Filling in order of ``most * size / weight`` finds the final level
    at once: a source is full if the rest of the demand, shared among it and
    those after it, gives it more than it may have.  The windows see one row
    per source.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    named = sources.withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ).withColumn("weight", weight)
    cap = F.col("source_size") * F.lit(most)
    filling = Window.orderBy(cap / F.col("weight"), "place")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    full = F.col("level") * F.col("weight") >= cap
    return (
        named.withColumn("level", level)
        .withColumn("open_level", F.max(F.when(~full, F.col("level"))).over(Window.partitionBy()))
        .withColumn("target", F.when(full, cap).otherwise(F.col("open_level") * F.col("weight")))
        .select("source", "source_size", "place", "weight", "target")
    )


def demand_time(share: Column, drift: Column) -> Column:
    """The training time in [0, 1] by which ``share`` of a source's words were asked for.

    A source's weight at time t is its mean times ``1 + drift * (1 - 2t)``.
    Its integral, ``(1 + drift) * t - drift * t**2``, is inverted.
    """
    root = F.sqrt(F.greatest(F.lit(0.0), (1 + drift) * (1 + drift) - 4 * drift * share))
    return F.when(drift == 0, share).otherwise(2 * share / (1 + drift + root))


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, range_digits: int = 3
) -> DataFrame:
    """Say how many words the mix takes of each document.

    ``docs`` has ``doc_id, text, source``; other columns are ignored.  Returns
    ``doc_id, source, content, size, source_size, target, place, start, whole,
    part_taken, taken``, one row for each row of ``docs``.

    A source with target ``q * source_size + rest`` gives every document q
    times and then, in the order of a hash of the id, documents up to ``rest``
    words; the document at the cut gives only its leading words.  So a source
    meets its rounded target exactly and nothing is random.

    The order within a source is cut into ranges of the hash (its leading
    hexadecimal digits), each with its own running sum, so a source with a
    third of all rows is no hot group.  A null or empty text has size 0 and is
    not taken; a corpus without words gives targets of 0, an empty table no
    rows.  Rows with the same id are ordered by their texts.
    """
    words = stage(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("")).alias("turn"),
            F.coalesce(F.md5("text"), F.lit("")).alias("content"),
        ),
        "sizes",
    ).withColumn("part", F.substring("turn", 1, range_digits))
    wanted = targets(words.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    runs = Window.partitionBy("source").orderBy("part")
    starts = (
        words.groupBy("source", "part")
        .agg(F.sum("size").alias("part_size"))
        .withColumn("ahead", F.sum("part_size").over(runs) - F.col("part_size"))
    )
    plan = starts.join(
        wanted.withColumnRenamed("source", "its_source"), F.col("source").eqNullSafe(F.col("its_source"))
    ).select(F.col("source").alias("of"), F.col("part").alias("of_part"), "ahead", "source_size", "target", "place")
    order = Window.partitionBy("source", "part").orderBy("turn", "doc_id", "content")
    inside = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    asked = F.round("target").cast("long")
    rest = F.round("target").cast("long") - F.col("whole") * F.col("source_size")
    return (
        words.withColumn("inside", inside)
        .join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part")))
        .withColumn("start", F.col("ahead") + F.col("inside"))
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(asked / F.col("source_size"))).otherwise(0))
        .withColumn("part_taken", F.greatest(F.lit(0), F.least("size", rest - F.col("start"))))
        .withColumn("taken", F.col("whole") * F.col("size") + F.col("part_taken"))
        .select(
            "doc_id", "source", "content", "size", "source_size", "target", "place", "start", "whole", "part_taken", "taken"
        )
    )


def repeats(mixed: DataFrame, drift: float = 0.5) -> DataFrame:
    """Give each repeat of a document its training position.

    Returns ``doc_id, source, content, start, words, of_words, position``: the
    words taken in this repeat and the words the document has.  Weights of sources
    at even places fall over training by ``drift`` and the others rise.
    """
    last = F.col("part_taken") > 0
    count = F.when(F.col("size") > 0, F.col("whole") + F.when(last, 1).otherwise(0)).otherwise(0).cast("int")
    sign = F.when(F.col("place") % 2 == 0, F.lit(-drift)).otherwise(F.lit(drift))
    share = (F.col("k") * F.col("source_size") + F.col("start")) / F.round("target")
    return (
        mixed.withColumn("repeats", count)
        .where("repeats > 0")
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("repeats") - 1)))
        .select(
            "doc_id",
            "source",
            "content",
            "start",
            F.when(F.col("k") < F.col("whole"), F.col("size")).otherwise(F.col("part_taken")).alias("words"),
            F.col("size").alias("of_words"),
            demand_time(share, sign).alias("position"),
        )
    )


def whole_at_cuts(mixed: DataFrame, far: float = FAR) -> DataFrame:
    """The mix with the document at each source's cut taken whole or not at all, whichever is nearer to the target.

    It stays cut only if both would miss the target by more than ``far`` of it.
    """
    part, size = F.col("part_taken"), F.col("size")
    nearest = F.when(2 * part >= size, size).otherwise(F.lit(0))
    kept = F.when((part > 0) & (part < size) & (F.abs(nearest - part) <= F.col("target") * far), nearest).otherwise(part).cast("long")
    return mixed.withColumn("part_taken", kept).withColumn("taken", F.col("whole") * size + F.col("part_taken"))


def training_order(docs: DataFrame, far: float | None = None, **options) -> DataFrame:
    """The documents of the mix, repeats included, sorted by range of training position.

    Keeps all columns of ``docs``; a document cut at its source's target keeps
    its leading words and the white space before each.  With ``far`` only
    those are cut that ``whole_at_cuts`` leaves.
    """
    placed = free_name(docs, "placed")
    mixed = mix(docs, **options)
    chosen = repeats(mixed if far is None else whole_at_cuts(mixed, far)).select(
        F.struct("doc_id", "content", "words", "of_words", "position").alias(placed)
    ).distinct()
    at = lambda field: F.col(f"{placed}.{field}")
    words = F.regexp_extract_all("text", F.lit(rf"([\x20\x09-\x0D]*{WORD})"), F.lit(1))
    leading = F.array_join(F.slice(words, 1, at("words").cast("int")), "")
    keys = F.col("doc_id").eqNullSafe(at("doc_id")) & (F.md5("text") == at("content"))
    return (
        docs.join(chosen, keys)
        .withColumn("text", F.when(at("words") < at("of_words"), leading).otherwise(F.col("text")))
        .orderBy(at("position"), at("doc_id"), at("content"))
        .select(*docs.columns)
    )
