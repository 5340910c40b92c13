"""Find benchmark texts in documents through a positional inverted index; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.shared import stage

WINDOW, SPAN = 10, 20
MOST_ROWS, ROW_BYTES = 500_000, 50  # of what is broadcast, 55 MB at most; so many bytes of strings count as a row more

# --- fixed values: what a word is -------------------------------------------------
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"  # words are what lies between, in lower case
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DOC = ["doc", "mark"]


def terms_of(text: Column) -> Column:
    """The words of a text with A-Z in lower case; other letters keep theirs.  Null has none.

    The text is split at what is no word: Spark collects the matches of a
    pattern one by one, at many times the cost.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, BETWEEN), "")


def lookup(df: DataFrame) -> DataFrame:
    """A staged table that larger ones are joined with: broadcast if it is short, shuffled if not, however small its file is.

    Left alone, Spark broadcasts by the size of the file, and equal values cost
    next to nothing there: 7 MB can hold three million rows, more than the
    driver has room for.
    """
    strings = [F.octet_length(c) for c, kind in df.dtypes if kind == "string"]
    strings += [F.octet_length(F.array_join(c, " ")) + 16 * F.size(c) for c, kind in df.dtypes if kind == "array<string>"]
    more = [F.coalesce(F.sum(F.coalesce(n, F.lit(0)).cast("long")), F.lit(0)) / ROW_BYTES for n in strings]
    return F.broadcast(df) if df.agg(sum(more, F.count("*"))).first()[0] <= MOST_ROWS else shuffled(df)


def shuffled(df: DataFrame) -> DataFrame:
    """A table of as many rows as documents or matches may give, never broadcast, see ``lookup``."""
    return df.hint("merge")


def keyed(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """``doc_id, text`` with ``doc`` and ``mark``, which tell apart rows that share an id, or have none, by their text."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(column).alias("text"))
    return rows.select(
        "*", F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc"), F.xxhash64(F.col("doc_id").isNull(), "text").alias("mark")
    )


def build_index(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """The positional index of all words of all documents: ``doc, mark, term, pos``.

    Each task writes its own documents' postings as one segment, sorted by
    the hash of the term, so that nothing is shuffled and the lists of a term
    lie together.  A sort by one number compares no rows, unlike one by strings.
    """
    postings = keyed(docs, key, column).select(*DOC, F.posexplode(terms_of(F.col("text"))).alias("pos", "term"))
    return stage(postings.select(*DOC, "term", "pos").sortWithinPartitions(F.xxhash64("term")), "postings")


def test_items(items: DataFrame, key: str = "item_id", column: str = "text") -> tuple[DataFrame, DataFrame]:
    """Different item texts ``item, words`` and the ids that have them: ``item, item_id``.  Items without words are left out."""
    rows = items.select(F.col(key).cast("string").alias("item_id"), terms_of(F.col(column)).alias("words")).where("size(words) > 0")
    rows = stage(rows.withColumn("item", F.md5(F.array_join("words", " "))), "items")
    ids = rows.where("item_id is not null").select("item", "item_id").distinct()
    return stage(rows.select("item", "words").distinct(), "item-texts"), stage(ids, "item-ids")


def window_probes(index: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """For each window of an item its two rarest terms: ``item, first, k1, term1, k2, term2``.

    ``k1`` and ``k2`` are places in the item; a window of one word has no
    second.  A window with a term that no document holds is left out.
    """
    terms = texts.select("item", F.posexplode("words").alias("k", "term"))
    vocabulary = stage(terms.select("term").distinct(), "vocabulary")
    counts = index.join(lookup(vocabulary), "term").groupBy("term").agg(F.count("*").alias("n"))
    place = F.struct("k", "n", "term")
    placed = terms.join(counts, "term", "left").groupBy("item").agg(F.array_sort(F.collect_list(place)).alias("places"))
    width = F.least(F.size("places"), F.lit(window))
    cuts = F.transform(F.sequence(F.lit(0), F.size("places") - width), lambda s: F.slice("places", s + 1, width))
    whole = F.filter(cuts, lambda c: ~F.exists(c, lambda p: p["n"].isNull()))
    by_count = lambda c: F.array_sort(F.transform(c, lambda p: F.struct(p["n"], p["term"], p["k"])))
    picked = F.transform(whole, lambda c: F.struct(c[0]["k"].alias("first"), F.slice(by_count(c), 1, 2).alias("rare")))
    rare = lambda i, name: F.get("w.rare", F.lit(i))[name]
    return placed.select("item", F.explode(picked).alias("w")).select(
        "item", "w.first", rare(0, "k").alias("k1"), rare(0, "term").alias("term1"), rare(1, "k").alias("k2"), rare(1, "term").alias("term2")
    )


def held(index: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """The rows of ``wanted(doc, mark, term, pos, ...)`` whose posting the index has.

    Postings of other documents and terms are left out before they move, by
    broadcast while the lists of documents and terms are short.  ``wanted``
    grows with the documents, so it is shuffled.
    """
    wanted = stage(wanted, name)
    docs = stage(wanted.select(*DOC).distinct(), f"{name}-documents")
    terms = stage(wanted.select("term").distinct(), f"{name}-terms")
    near = index.join(lookup(terms), "term", "left_semi").join(lookup(docs), DOC, "left_semi")
    return shuffled(wanted).join(near.select(*DOC, "term", "pos").distinct(), [*DOC, "term", "pos"])


def phrase_matches(index: DataFrame, texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """All occurrences of the items' windows: ``doc, mark, item, first, words``.

    ``first`` is the document's word at which ``words`` words of the item
    begin.  The list of a window's rarest term, each place less the term's
    place in the item, gives the shifts at which the item may lie; the list of
    the next rarest, adjusted alike, is intersected with it, and then those of
    all other terms at the shifts left.
    """
    probes = stage(window_probes(index, texts, window), "probes")
    firsts = stage(probes.select("item", F.col("k1").alias("k"), F.col("term1").alias("term")).distinct(), "rarest")
    shifts = index.join(lookup(firsts), "term").select(*DOC, "item", "k", (F.col("pos") - F.col("k")).alias("shift"))
    pairs = probes.select("item", F.col("k1").alias("k"), "k2", "term2").distinct()
    both = stage(shifts.join(lookup(stage(pairs, "pairs")), ["item", "k"]), "shifts")
    second = held(
        index, both.where("k2 is not null").select(*DOC, F.col("term2").alias("term"), (F.col("shift") + F.col("k2")).alias("pos"), "item", "shift").distinct(),
        "second",
    )
    left = second.select(*DOC, "item", "shift").union(both.where("k2 is null").select(*DOC, "item", "shift")).distinct()
    places = left.join(lookup(texts), "item").select(*DOC, "item", "shift", F.size("words").alias("size"), F.posexplode("words").alias("k", "term"))
    wanted = places.select(*DOC, "term", (F.col("shift") + F.col("k")).alias("pos"), "item", "shift", "k", "size")
    found = held(index, wanted.where("pos >= 0"), "all-terms")
    rows = found.groupBy(*DOC, "item", "shift").agg(F.array_sort(F.collect_set("k")).alias("ks"), F.least(F.first("size"), F.lit(window)).alias("words"))
    starts = F.filter(
        F.transform(F.col("ks"), lambda k, i: F.when(F.get("ks", i + F.col("words") - 1) == k + F.col("words") - 1, k)), lambda k: k.isNotNull()
    )
    return rows.select(*DOC, "item", F.explode(starts).alias("k"), "shift", "words").select(*DOC, "item", (F.col("shift") + F.col("k")).alias("first"), "words")


def near_matches(index: DataFrame, texts: DataFrame, window: int = WINDOW, span: int = SPAN) -> DataFrame:
    """Windows whose different terms all stand in ``span`` consecutive words, in any order: ``doc, mark, item, window, first``.

    ``window`` is the window's first word in the item, ``first`` the first
    word of such a stretch that begins with one of the terms.  Anchors are the
    places of the window's rarest term; the other lists meet them in bins of
    ``span`` words, so that each anchor sees less than ``2 * span`` places.
    """
    probes = stage(window_probes(index, texts, window), "near-probes")
    anchors = probes.select("item", F.col("first").alias("window"), F.col("term1").alias("term"))
    at = stage(index.join(lookup(stage(anchors, "anchors")), "term").select(*DOC, "item", "window", F.col("pos").alias("at")), "near-anchors")
    words = shuffled(texts.select("item", "words")).join(probes.select("item", F.col("first").alias("window")).distinct(), "item")
    needed = F.array_distinct(F.slice("words", F.col("window") + 1, F.lit(window)))
    needs = stage(words.select("item", "window", needed.alias("needed")), "near-needs")
    bins = F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda b: b + F.floor(F.col("at") / span)))
    wanted = at.join(lookup(needs), ["item", "window"]).select(*DOC, "item", "window", "at", F.size("needed").alias("terms"), F.explode("needed").alias("term"))
    wanted = stage(wanted.select("*", bins.alias("bin")), "near-wanted")
    docs = stage(wanted.select(*DOC).distinct(), "near-documents")
    terms = stage(wanted.select("term").distinct(), "near-terms")
    lists = index.join(lookup(terms), "term", "left_semi").join(lookup(docs), DOC, "left_semi").distinct()
    lists = lists.withColumn("bin", F.floor(F.col("pos") / span))
    close = shuffled(wanted).join(lists, [*DOC, "term", "bin"]).where(F.abs(F.col("pos") - F.col("at")) < span)
    seen = close.groupBy(*DOC, "item", "window", "at", "terms").agg(F.array_sort(F.collect_set(F.struct("pos", "term"))).alias("seen"))
    inside = lambda p: F.filter("seen", lambda o: (o["pos"] >= p) & (o["pos"] < p + span))
    full = lambda p: (p <= F.col("at")) & (p + span > F.col("at")) & (F.size(F.array_distinct(F.transform(inside(p), lambda o: o["term"]))) == F.col("terms"))
    starts = F.array_distinct(F.filter(F.transform("seen", lambda o: o["pos"]), full))
    return seen.select(*DOC, "item", "window", F.explode(starts).alias("first")).distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """What of each document stands in the items: ``doc_id, n_words, n_hit, n_items, item_ids``.

    A window is ``window`` consecutive words of an item, or all words of an
    item that has fewer.  A word of a document is hit if it lies in an
    occurrence of any window; ``item_ids`` are the items with occurring
    windows, as strings, sorted.

    Null, empty and wordless documents have no words and no hits; such items
    have no windows.  Each row of ``docs`` gives one row, also if its id is
    null or shared, and is judged by its own text; equal rows are judged
    alike.  Rows of ``items`` with one id are one item; those without an id
    mark words but are not listed.  Other columns are ignored; empty tables
    give no rows, or no hits.
    """
    index = build_index(docs)
    texts, ids = test_items(items)
    found = stage(phrase_matches(index, texts, window), "phrases")
    end = F.col("first") + F.col("words")
    spans = found.select(*DOC, "first", "words").distinct()
    before = Window.partitionBy(*DOC).orderBy("first", "words").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), end - F.greatest(F.col("first"), F.coalesce(F.col("reached"), F.lit(0))))
    hits = spans.withColumn("reached", F.max(end).over(before)).groupBy(*DOC).agg(F.sum(new).alias("n_hit"))
    listed = found.select(*DOC, "item").distinct().join(lookup(ids), "item").groupBy(*DOC).agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    sizes = index.groupBy(*DOC).agg((F.max("pos") + 1).alias("n_words"))
    number = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    ids_of = F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")
    return (
        keyed(docs).select("doc_id", *DOC)
        .join(shuffled(sizes), DOC, "left").join(shuffled(hits), DOC, "left").join(shuffled(listed), DOC, "left")
        .select("doc_id", number("n_words"), number("n_hit"), F.size(ids_of).cast("long").alias("n_items"), ids_of)
    )
