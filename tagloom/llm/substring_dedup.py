"""Remove words covered by windows that an earlier document has too, by Rabin-Karp hashes counted in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.arrays import slices, sliding_least, utf8, window_hashes, word_hashes, words_of
from tagloom.llm.shared import sized, stage

WINDOW, MARKER = 50, 12


def window_table(data, offsets, window: int):
    """Hashes of all windows inside texts, their text and their first word; and the least part-hash of each.

    A window's marker is the smallest hash among its runs of ``MARKER`` words:
    equal windows have equal markers, and neighbours mostly share one.
    """
    starts, ends, before = words_of(data, offsets)
    hashes = word_hashes(data, starts, ends)
    whole = window_hashes(hashes, window)
    run = min(MARKER, window)
    marker = sliding_least(window_hashes(hashes, run), window - run + 1)
    first = np.arange(len(whole))
    text = np.searchsorted(before, first, "right") - 1
    inside = first + window <= before[text + 1]
    return whole[inside], marker[inside], text[inside], first[inside] - before[text[inside]], (starts, ends, before)


def runs_of(sorted_flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    steps = np.diff(np.concatenate([[0], sorted_flags.astype(np.int8), [0]]))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def exact_copies(docs: DataFrame) -> DataFrame:
    """``doc_id`` of the documents whose whole text a smaller id has."""
    named = docs.select("doc_id", F.md5("text").alias("content"))
    first = named.groupBy("content").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    return named.join(first, "content").where("doc_id > first").select("doc_id").distinct()


def first_owners(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words to remove: ``doc_id, places``, the first words of all windows that a smaller ``doc_id`` has too.

    Every window has a hash, but only windows that may repeat are moved.
    First each document sends the distinct markers of its windows, about a
    twentieth of its words.  Only windows whose marker two documents share are
    then sent, each once for its document, and counted; no other window can
    repeat.  Both counts are
    partial aggregates (smallest and largest document of a hash), so a passage
    in a third of all documents is summed before it moves.
    """

    def markers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                _, marker, text, _, _ = window_table(*utf8(cut.column("text")), window)
                keys = marker + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                step = np.sort(np.unique(keys, return_index=True)[1])
                ids = cut.column("doc_id").to_numpy()[text[step]]
                yield pa.RecordBatch.from_arrays([pa.array(marker[step].view(np.int64)), pa.array(ids, pa.int64())], ["marker", "doc_id"])

    sent = stage(docs.mapInArrow(markers, "marker long, doc_id long"), "markers")
    owners = sent.groupBy("marker").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    shared = stage(sent.join(owners.select("marker"), "marker").groupBy("doc_id").agg(F.collect_list("marker").alias("markers")), "shared-markers")
    owning = docs.join(sized(shared.select("doc_id")), "doc_id", "left_semi")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                whole, marker, text, first, _ = window_table(*utf8(cut.column("text")), window)
                lists = cut.column("markers")
                owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
                held = lists.flatten().to_numpy().view(np.uint64)
                salt = np.uint64(0x9E3779B97F4A7C15)
                found = np.isin(marker + text.astype(np.uint64) * salt, held + owner.astype(np.uint64) * salt)
                whole, text, first = whole[found], text[found], first[found]
                order = np.lexsort((whole, text))
                whole, text, first = whole[order], text[order], first[order]
                new = np.ones(len(whole), bool)
                new[1:] = (whole[1:] != whole[:-1]) | (text[1:] != text[:-1])
                begins = np.append(np.flatnonzero(new), len(whole)).astype(np.int32)
                places = pa.ListArray.from_arrays(pa.array(begins), pa.array(first.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(whole[new].view(np.int64)), pa.array(cut.column("doc_id").to_numpy()[text[new]], pa.int64()), places],
                    ["window", "doc_id", "places"],
                )

    candidates = stage(
        owning.join(shared, "doc_id").select("doc_id", "text", "markers").mapInArrow(windows, "window long, doc_id long, places array<int>"),
        "windows",
    )
    least = candidates.groupBy("window").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    return (
        candidates.join(least, "window")
        .where("doc_id > low")
        .groupBy("doc_id")
        .agg(F.flatten(F.collect_list("places")).alias("places"))
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Cut repeated windows: ``doc_id, n_words, n_removed, removed, kept``.

    A window is ``window`` consecutive words (``[^\\x20\\x09-\\x0D]+``) of one
    document.  A word goes if a window over it also starts in a document with
    a smaller ``doc_id``; windows are judged on the input.  Overlapping and
    adjoining windows merge into the maximal intervals ``removed``.  ``kept``
    are the other words joined by one space.

    A document whose text an earlier one has loses all its words (if they fill
    a window) and takes no part in the search.  Only documents that change, or
    may, are moved; the others stay where they were read.

    Null and empty texts have no words and lose none, like texts shorter than
    a window.  ``doc_id`` is expected to name one row; of rows that share one
    each loses what any of them loses.  Rows without an id are kept whole.  Other columns are
    ignored; an empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    known = texts.where("doc_id is not null and text is not null")
    copies = stage(exact_copies(known), "copies")
    places = first_owners(known.join(sized(copies), "doc_id", "left_anti"), window)
    change = stage(
        places.select("doc_id", "places", F.lit(False).alias("copy"))
        .union(copies.select("doc_id", F.lit(None).cast("array<int>"), F.lit(True))),
        "changes",
    )
    touched = sized(change.select("doc_id"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                data, offsets = utf8(cut.column("text"))
                starts, ends, before = words_of(data, offsets)
                rows = []
                for i, places in enumerate(cut.column("places")):
                    low, high = before[i], before[i + 1]
                    gone = np.zeros(high - low + 1, np.int32)
                    if cut.column("copy")[i].as_py():
                        gone[0] = high - low >= window
                    elif places.is_valid:
                        at = places.values.to_numpy()
                        at = np.unique(at[at + window <= high - low])
                        np.add.at(gone, at, 1)
                        np.add.at(gone, at + window, -1)
                    flags = np.cumsum(gone)[:-1] > 0
                    a, b = runs_of(flags)
                    text = data[offsets[i] : offsets[i + 1]].tobytes()
                    kept = text.split()
                    if len(a):
                        kept = [w for w, f in zip(kept, flags.tolist(), strict=True) if not f]
                    rows.append((high - low, int(flags.sum()), [{"first": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)], b" ".join(kept).decode()))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
                span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
                kinds = [pa.int64(), pa.int64(), span, pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [cut.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                    ["doc_id", "n_words", "n_removed", "removed", "kept"],
                )

    shape = "doc_id long, n_words long, n_removed long, removed array<struct<first: long, end: long>>, kept string"
    whole = texts.join(touched, "doc_id", "left_anti").select(
        "doc_id", "text", F.lit(None).cast("array<int>").alias("places"), F.lit(False).alias("copy")
    )
    cut = texts.join(touched, "doc_id", "left_semi").join(change, "doc_id").select("doc_id", "text", "places", "copy")
    return whole.mapInArrow(cut_out, shape).union(cut.mapInArrow(cut_out, shape))
