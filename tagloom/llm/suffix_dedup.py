"""Remove bytes that lie in long repeated strings, by suffix sorting shards of what may repeat."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.arrays import byte_values, slices, sliding_least, utf8, window_hashes
from tagloom.llm.induced_sort import MEMORY_ITEMS, sorted_suffixes
from tagloom.llm.shared import sized, stage
from tagloom.llm.substring_dedup import runs_of

LENGTH, GRAM = 400, 64
# A marker of too many different segments is split by these longer grams, one after the other.
LONGER_GRAMS = (200, 320)
SHARD_BYTES = 4 << 20
_SALT = np.uint64(0x9E3779B97F4A7C15)


class Windows:
    """All strings of ``length`` bytes inside texts, and for each its marker, the least hash of its grams.

    Equal strings have equal markers, and neighbours mostly share one.
    """

    def __init__(self, column: pa.Array, length: int, gram: int = GRAM):
        self.data, self.offsets = utf8(column)
        self.gram = min(gram, length)
        self.width = length - self.gram + 1
        self.grams = window_hashes(byte_values(self.data), self.gram)
        self.marker = sliding_least(self.grams, self.width)
        count = len(self.marker)
        self.text = np.repeat(np.arange(len(column)), np.diff(self.offsets))
        self.inside = np.arange(count) + length <= self.offsets[1:][self.text[:count]]

    def marked_places(self) -> np.ndarray:
        """Where the grams stand that are the marker of some string."""
        held = np.where(self.inside, self.marker, np.uint64(0))
        edge = np.zeros(self.width - 1, np.uint64)
        high = ~sliding_least(~np.concatenate([edge, held, edge]), self.width)
        return np.flatnonzero((high == self.grams) & (high > 0)) if len(held) else np.zeros(0, np.int64)


    def segments(self, live: np.ndarray, ids: pa.Array, shift: np.ndarray, length: int) -> pa.RecordBatch:
        """Runs of ``live`` strings with one marker, with their bytes; ``shift`` is where each text starts in its document."""
        text = self.text[: len(self.marker)]
        at = np.flatnonzero(live)
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (self.marker[at[1:]] != self.marker[at[:-1]]) | (text[at[1:]] != text[at[:-1]])
        starts = at[new]
        counts = np.diff(np.append(np.flatnonzero(new), len(at)))
        inner = [bool(np.count_nonzero(self.grams[s : s + n + self.width - 1] == self.marker[s]) > 1) for s, n in zip(starts, counts, strict=True)]
        content = [self.data[s : s + n + length - 1].tobytes() for s, n in zip(starts, counts, strict=True)]
        owner = text[starts]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.marker[starts].view(np.int64)), ids.take(pa.array(owner)), pa.array(starts - self.offsets[owner] + shift[owner]),
             pa.array(counts), pa.array(inner, pa.bool_()), pa.array(content, pa.binary())],
            ["marker", "doc_id", "start", "strings", "inner", "content"],
        )


SEGMENT_SHAPE = "marker long, doc_id long, start long, strings long, inner boolean, content binary"


def repeated_texts(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, first`` for the documents of ``length`` bytes or more whose whole text another one has too."""
    named = docs.where(F.octet_length("text") >= length).select("doc_id", F.md5("text").alias("content"))
    classes = named.groupBy("content").agg(F.min("doc_id").alias("first"), F.count("*").alias("members")).where("members > 1")
    return named.join(classes, "content").select("doc_id", "first")


def candidate_segments(docs: DataFrame, length: int) -> DataFrame:
    """Runs of strings with one marker that stands in two places or more.

    Returns ``marker, doc_id, start, strings, inner, content, digest``: the
    bytes of ``strings`` consecutive strings from ``start`` on; ``inner`` says
    that the marker stands in them more than once.  Documents first send their
    distinct markers, one for about 170 bytes; only strings whose marker is
    shared go on, and no other string can repeat.
    """

    def markers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                found = Windows(cut.column("text"), length)
                places = found.marked_places()
                keys = found.grams[places] + found.text[places].astype(np.uint64) * _SALT
                _, own, times = np.unique(keys, return_index=True, return_counts=True)
                places = places[own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.grams[places].view(np.int64)), cut.column("doc_id").take(pa.array(found.text[places])), pa.array(times)],
                    ["marker", "doc_id", "times"],
                )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                found = Windows(cut.column("text"), length)
                lists = cut.column("markers")
                owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
                held = lists.flatten().to_numpy().view(np.uint64) + owner.astype(np.uint64) * _SALT
                text = found.text[: len(found.marker)]
                live = found.inside & np.isin(found.marker + text.astype(np.uint64) * _SALT, held)
                yield found.segments(live, cut.column("doc_id"), np.zeros(len(lists), np.int64), length)

    sent = stage(docs.mapInArrow(markers, "marker long, doc_id long, times long"), "markers")
    shared = sent.groupBy("marker").agg(F.sum("times").alias("times")).where("times > 1")
    lists = stage(sent.join(shared.select("marker"), "marker").groupBy("doc_id").agg(F.collect_list("marker").alias("markers")), "shared-markers")
    owning = docs.join(sized(lists.select("doc_id")), "doc_id", "left_semi").join(lists, "doc_id").select("doc_id", "text", "markers")
    return owning.mapInArrow(segments, SEGMENT_SHAPE).withColumn("digest", F.md5("content"))


def finer_segments(pieces: DataFrame, length: int, gram: int) -> DataFrame:
    """The strings of ``pieces(doc_id, start, content)`` as segments once more, by the least hash of longer grams.

    Strings that only share a short passage in different surroundings part
    here; equal strings have equal markers on every level.
    """

    def cut_finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, "content", 1 << 18):
                found = Windows(cut.column("content"), length, gram)
                yield found.segments(found.inside, cut.column("doc_id"), cut.column("start").to_numpy(), length)

    return pieces.select("doc_id", "start", "content").mapInArrow(cut_finer, SEGMENT_SHAPE).withColumn("digest", F.md5("content"))


def segment_kinds(segments: DataFrame) -> DataFrame:
    """Different segments of each marker: ``marker, digest, times, head, inner, size``."""
    return segments.groupBy("marker", "digest").agg(
        F.count("*").alias("times"), F.min(F.struct("doc_id", "start")).alias("head"), F.max("inner").alias("inner"), F.max("size").alias("size")
    )


def alike_spans(segments: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """``doc_id, low, high`` of the segments that stand in two places or more."""
    often = kinds.where("times > 1").select("marker", "digest")
    return segments.select("marker", "digest", "doc_id", "start", "strings").join(often, ["marker", "digest"]).select(
        "doc_id", F.col("start").alias("low"), (F.col("start") + F.col("strings") + length - 1).alias("high")
    )


def repeated_in_shard(contents: list[bytes], length: int, limit: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each content, the runs of places at which strings start that start elsewhere in the shard too."""
    sizes = np.array([len(c) for c in contents])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8).astype(np.uint16) + 1
    text[begins[1:] - 1] = 0
    repeated = np.zeros(len(text) + 1, bool)
    last = len(text)

    def emit(positions: np.ndarray, prefixes: np.ndarray) -> None:
        nonlocal last
        long = prefixes >= length
        repeated[positions[long]] = True
        repeated[np.concatenate([[last], positions[:-1]])[long]] = True
        last = positions[-1]

    sorted_suffixes(text, emit, limit)
    # a string that would run into the next content is none
    return [runs_of(repeated[a : a + max(0, n - length + 1)]) for a, n in zip(begins[:-1].tolist(), sizes.tolist(), strict=True)]


def head_segments(kinds: DataFrame, shard_bytes: int) -> DataFrame:
    """``marker, doc_id, start, size, sorts``: a segment of each kind that may share strings with another or itself.

    ``sorts`` says that all kinds of the marker fit in a shard together.
    """
    many = kinds.groupBy("marker").agg(F.count("*").alias("kinds"), F.sum("size").alias("marker_size"))
    return kinds.join(many, "marker").where("kinds > 1 or inner").select(
        "marker", F.col("head.doc_id"), F.col("head.start"), "size", (F.col("marker_size") <= shard_bytes).alias("sorts")
    )


def counted_spans(pieces: DataFrame, length: int) -> DataFrame:
    """``doc_id, low, high`` of the strings that start in two places of the segments, by counting their hashes.

    For markers of which many different segments are held on every level:
    each string has a key of its own, two independent rolling hashes of 64
    bits, so nothing but equal strings must meet, and those are counted before
    they move.
    """
    other = np.random.default_rng(400).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, "content", 1 << 18):
                data, offsets = utf8(cut.column("content"))
                text = np.repeat(np.arange(cut.num_rows), np.diff(offsets))[: max(0, len(data) - length + 1)]
                at = np.flatnonzero(np.arange(len(text)) + length <= offsets[1:][text])
                first, second = window_hashes(byte_values(data), length), window_hashes(other[data], length)
                low = at - offsets[text[at]] + cut.column("start").to_numpy()[text[at]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first[at].view(np.int64)), pa.array(second[at].view(np.int64)), cut.column("doc_id").take(pa.array(text[at])), pa.array(low)],
                    ["first", "second", "doc_id", "low"],
                )

    strings = stage(pieces.select("doc_id", "start", "content").mapInArrow(hashed, "first long, second long, doc_id long, low long"), "strings")
    repeated = strings.groupBy("first", "second").agg(F.count("*").alias("times")).where("times > 1")
    # consecutive strings make one span
    found = strings.join(repeated, ["first", "second"]).select("doc_id", "low").distinct()
    run = F.col("low") - F.row_number().over(Window.partitionBy("doc_id").orderBy("low"))
    return found.withColumn("run", run).groupBy("doc_id", "run").agg(
        F.min("low").alias("low"), (F.max("low") + length).alias("high")
    ).select("doc_id", "low", "high")


def sorted_spans(
    segments: DataFrame, kinds: DataFrame, length: int, shard_bytes: int, limit: int, longer: tuple[int, ...] = LONGER_GRAMS
) -> DataFrame:
    """``doc_id, low, high`` of what repeats in other segments, one segment of each kind standing for all.

    A shard holds all different segments of its markers, so equal strings meet
    in it.  Suffixes are sorted by external induction with their common
    prefixes; a string repeats if it shares ``length`` bytes with a neighbour.
    A marker with more than ``shard_bytes`` of different segments is split by
    the ``longer`` grams in turn, without moving bytes that meet no others;
    what is too large after the last is dealt out string by string and counted.
    """
    heads = stage(head_segments(kinds, shard_bytes), "heads")
    shards = max(1, math.ceil((heads.where("sorts").agg(F.sum("size")).first()[0] or 0) / shard_bytes))

    def sort(table: pa.Table) -> pa.Table:
        ids, starts = table.column("doc_id").to_numpy(), table.column("start").to_numpy()
        rows: list[list[np.ndarray]] = [[], [], []]
        for i, (a, b) in enumerate(repeated_in_shard(table.column("content").to_pylist(), length, limit)):
            rows[0].append(np.full(len(a), ids[i]))
            rows[1].append(starts[i] + a)
            rows[2].append(starts[i] + b + length - 1)
        return pa.table([pa.array(np.concatenate(c).astype(np.int64)) for c in rows], ["doc_id", "low", "high"])

    keys = ["marker", "doc_id", "start"]
    pieces = segments.select(*keys, "content")
    spans = (
        pieces.join(heads.where("sorts").select(*keys), keys)
        .withColumn("shard", F.pmod(F.xxhash64("marker"), F.lit(shards)))
        .groupBy("shard").applyInArrow(sort, "doc_id long, low long, high long")
    )
    hot = heads.where("not sorts")
    if hot.isEmpty():
        return spans
    large = stage(pieces.join(hot.select(*keys), keys), "large-markers")
    longer = tuple(g for g in longer if g < length)
    if not longer:
        return spans.union(counted_spans(large, length))
    finer = finer_segments(large, length, longer[0])
    listed = stage(finer.withColumn("size", F.octet_length("content")).drop("content"), "finer-segments")
    finer_kinds = stage(segment_kinds(listed), "finer-kinds")
    return spans.union(alike_spans(listed, finer_kinds, length)).union(
        sorted_spans(finer, finer_kinds, length, shard_bytes, limit, longer[1:])
    )


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, memory_items: int = MEMORY_ITEMS
) -> DataFrame:
    """Cut repeated strings: ``doc_id, n_bytes, n_removed, removed, kept``.

    Texts are UTF-8 bytes.  A byte goes if a string of ``length`` bytes over
    it also starts anywhere else, in the same document or another; strings are
    judged on the input and never cross documents.  ``removed`` holds the
    maximal removed runs, ``kept`` the other bytes.

    Equal texts are taken out first: they repeat as a whole, and one stands
    for all in the search.  Of the others only segments that may repeat are
    moved; equal segments are counted, and different ones with a common marker
    are suffix sorted in shards of about ``shard_bytes``; suffixes wait on disk
    beyond ``memory_items``.  A marker with more different segments than that
    is split by longer grams, and in the end down to its strings, which are
    counted.

    Null and empty texts have no bytes, and texts shorter than ``length`` lose
    none.  ``doc_id`` is expected to name one row; of rows that share one each
    loses what any of them loses.  Rows without an id are kept whole.  Other
    columns are ignored; an empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    known = texts.where("doc_id is not null and text is not null")
    equal = stage(repeated_texts(known, length), "equal-texts")
    copies = stage(equal.where("doc_id <> first").select("doc_id"), "copies")
    segments = stage(candidate_segments(known.join(sized(copies), "doc_id", "left_anti"), length), "segments")
    kinds = stage(segment_kinds(segments.withColumn("size", F.octet_length("content"))), "kinds")
    alike = alike_spans(segments, kinds, length)
    spans = alike.union(sorted_spans(segments, kinds, length, shard_bytes, memory_items))
    change = stage(
        spans.groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("spans"), F.lit(False).alias("whole"))
        .join(equal.select("doc_id"), "doc_id", "left_anti")
        .union(equal.select("doc_id", F.lit(None).cast("array<struct<low: long, high: long>>"), F.lit(True)).distinct()),
        "changes",
    )

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
        for batch in batches:
            for cut in slices(batch):
                data, offsets = utf8(cut.column("text"))
                rows = []
                for i, (spans, whole) in enumerate(zip(cut.column("spans"), cut.column("whole").to_pylist(), strict=True)):
                    own = data[offsets[i] : offsets[i + 1]]
                    flags = np.full(len(own), whole)
                    if spans.is_valid:
                        edge = np.zeros(len(own) + 1, np.int32)
                        pairs = spans.values.flatten()
                        np.add.at(edge, np.minimum(pairs[0].to_numpy(), len(own)), 1)
                        np.add.at(edge, np.minimum(pairs[1].to_numpy(), len(own)), -1)
                        flags = np.cumsum(edge)[:-1] > 0
                    a, b = runs_of(flags)
                    rows.append((len(own), int(flags.sum()), [{"low": int(x), "high": int(y)} for x, y in zip(a, b, strict=True)], own[~flags].tobytes()))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
                kinds = [pa.int64(), pa.int64(), span, pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [cut.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                    ["doc_id", "n_bytes", "n_removed", "removed", "kept"],
                )

    shape = "doc_id long, n_bytes long, n_removed long, removed array<struct<low: long, high: long>>, kept binary"
    touched = sized(change.select("doc_id"))
    same = texts.join(touched, "doc_id", "left_anti").select(
        "doc_id", "text", F.lit(None).cast("array<struct<low: long, high: long>>").alias("spans"), F.lit(False).alias("whole")
    )
    changed = texts.join(touched, "doc_id", "left_semi").join(change, "doc_id").select("doc_id", "text", "spans", "whole")
    return same.mapInArrow(cut_out, shape).union(changed.mapInArrow(cut_out, shape))
