"""Drop lines that recur across documents, by a log-template tree of fixed depth."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.arrays import mixed, segment_hashes, slices, utf8, word_hashes, words_of
from tagloom.llm.shared import components, free_name, sized, stage

DEPTH = 3
SIMILAR = 0.8
MIN_TEXTS = 10
LONG, LONG_TEXTS = 50, 2
# a connected set of more lines is dealt out over tasks, and so many of its lines are tried in one round
SET_LINES, HEADS = 20_000, 4_096
NONE = np.iinfo(np.int64).max


class Lines:
    """The lines of several texts, parsed at once.

    A line ends at a line feed or at the end of its text.  Its tokens are the
    words in it; tokens with a digit are variable and all count as one.
    ``leaf`` is reached by the number of tokens and the first ``depth`` of
    them; ``line`` hashes all tokens; ``marks`` has four bytes for each token.
    ``exact`` hashes the words themselves, digits and all.  Blank lines have
    no tokens.
    """

    def __init__(self, column: pa.Array, depth: int):
        self.data, self.offsets = data, offsets = utf8(column)
        held = np.flatnonzero(np.diff(offsets))
        breaks = np.flatnonzero(data == 10)
        breaks = breaks[~np.isin(breaks + 1, offsets)]
        self.starts = np.sort(np.concatenate([offsets[held], breaks + 1]))
        self.text = np.searchsorted(offsets, self.starts, "right") - 1
        self.ends = np.append(self.starts[1:], len(data))
        starts, ends, _ = words_of(data, offsets)
        hashes = word_hashes(data, starts, ends)
        digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
        self.first = np.searchsorted(starts, self.starts)
        self.last = np.append(self.first[1:], len(starts))
        self.exact = mixed(segment_hashes(hashes, self.first, self.last))
        hashes[digits[ends] > digits[starts]] = np.uint64(0)
        self.tokens = self.last - self.first
        lead = segment_hashes(hashes, self.first, np.minimum(self.last, self.first + depth))
        self.leaf = mixed(lead + self.tokens.astype(np.uint64))
        self.line = segment_hashes(hashes, self.first, self.last)
        self.marks = (hashes >> np.uint64(32)).astype(np.uint32)


def distinct_lines(docs: DataFrame, depth: int) -> DataFrame:
    """``text_hash, doc_id, leaf, line, marks`` for the distinct lines of each text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                found = Lines(cut.column("text"), depth)
                keys = found.line + found.text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                own = np.unique(keys, return_index=True)[1]
                own = np.sort(own[found.tokens[own] > 0])
                marks = pa.array([found.marks[a:b].tobytes() for a, b in zip(found.first[own], found.last[own], strict=True)], pa.binary())
                row = pa.array(found.text[own])
                yield pa.RecordBatch.from_arrays(
                    [cut.column("text_hash").take(row), cut.column("doc_id").take(row),
                     pa.array(found.leaf[own].view(np.int64)), pa.array(found.line[own].view(np.int64)), marks],
                    ["text_hash", "doc_id", "leaf", "line", "marks"],
                )

    texts = docs.where("text is not null").select(F.xxhash64("text").alias("text_hash"), F.col("doc_id").cast("long"), "text")
    return texts.mapInArrow(read, "text_hash long, doc_id long, leaf long, line long, marks binary")


def long_lines(docs: DataFrame, depth: int, long: int) -> DataFrame:
    """``text_hash, doc_id, line`` for the lines of ``long`` words or more of each text; ``line`` is their ``exact`` hash."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                found = Lines(cut.column("text"), depth)
                held = np.flatnonzero(found.tokens >= long)
                row = pa.array(found.text[held])
                yield pa.RecordBatch.from_arrays(
                    [cut.column("text_hash").take(row), cut.column("doc_id").take(row), pa.array(found.exact[held].view(np.int64))],
                    ["text_hash", "doc_id", "line"],
                )

    # fewer bytes than that cannot be so many words
    texts = docs.where(F.octet_length("text") >= 2 * long - 1).select(F.xxhash64("text").alias("text_hash"), F.col("doc_id").cast("long"), "text")
    return texts.mapInArrow(read, "text_hash long, doc_id long, line long").distinct()


def recurring_lines(lines: DataFrame, depth: int, similar: float, min_texts: int) -> DataFrame:
    """``line, first_doc`` for the lines of templates that ``min_texts`` different texts have.

    A leaf's most frequent line (the largest hash among equals) stands for its
    first template.  A line of the leaf that agrees with it in ``similar`` of
    the tokens joins it; where they differ, the template is variable.  The
    lines that are left make further templates in the same way, until no line
    left has enough texts with those that agree with it.
    """
    # marks are as long as the texts; they move only for leaves with enough texts
    held = lines.select("leaf", "line", "text_hash").distinct().groupBy("leaf").agg(F.count("*").alias("texts"))
    open_leaves = stage(held.where(F.col("texts") >= min_texts).select("leaf"), "open-leaves")
    lines = lines.join(sized(open_leaves), "leaf", "left_semi")
    counts = (
        lines.groupBy("leaf", "line", "text_hash").agg(F.min("doc_id").alias("low"), F.min("marks").alias("marks"))
        .groupBy("leaf", "line").agg(F.count("*").alias("texts"), F.min("low").alias("low"), F.min("marks").alias("marks"))
    )
    counts = stage(counts, "line-counts")
    leaves = counts.groupBy("leaf").agg(
        F.sum("texts").alias("all_texts"), F.max(F.struct("texts", "line", "marks")).alias("top")
    ).where(F.col("all_texts") >= min_texts)

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share = []
            for a, b in zip(batch.column("marks").to_pylist(), batch.column("top_marks").to_pylist(), strict=True):
                share.append(float(np.mean(np.frombuffer(a, np.uint32) == np.frombuffer(b, np.uint32))))
            keep = [batch.schema.get_field_index(n) for n in ("leaf", "line", "texts", "low", "marks", "top_line")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(share, pa.float64())], ["leaf", "line", "texts", "low", "marks", "top_line", "share"]
            )

    near = (
        counts.join(leaves.select("leaf", F.col("top.line").alias("top_line"), F.col("top.marks").alias("top_marks")), "leaf")
        .mapInArrow(agree, "leaf long, line long, texts long, low long, marks binary, top_line long, share double")
        .withColumn("is_top", F.col("share") >= similar)
        .withColumn("template", F.when(F.col("is_top"), F.col("top_line")).otherwise(F.col("line")))
    )
    near = stage(near.select("leaf", "line", "template", "texts", "low", "marks", "is_top"), "templates")
    recurring = (
        near.where("is_top").groupBy("leaf", "template").agg(F.sum("texts").alias("texts"), F.min("low").alias("first_doc"))
        .where(F.col("texts") >= min_texts)
    )
    known = near.join(recurring.select("leaf", "template", "first_doc", F.lit(True).alias("taken")), ["leaf", "template"], "left")
    known = stage(known, "first-templates")
    others = further_templates(known.where("taken is null").select("leaf", "line", "texts", "low", "marks"), depth, similar, min_texts)
    return known.where("taken").select("line", "first_doc").union(others)


def further_templates(
    rest: DataFrame, depth: int, similar: float, min_texts: int, set_lines: int | None = None, heads: int | None = None
) -> DataFrame:
    """``line, first_doc`` for the lines of the further templates of each leaf.

    From the most frequent line down, a line that still stands alone is a
    template if it and the lines left that agree with it in ``similar`` of the
    tokens have ``min_texts`` texts; they all join it.

    Lines that agree have a key in common: all marks but one where one token
    may differ, else one of as many runs of marks as tokens may differ and one
    more.  Keys are counted before lines move, so only lines with a neighbour,
    or frequent by themselves, are compared, and only those with enough texts
    in reach are tried.  Lines of a leaf that no chain of keys connects never
    meet, so each connected set of lines is worked through by itself: in one
    task up to ``set_lines`` lines, else by ``dealt_out``, with equal results.
    """
    open_leaves = rest.groupBy("leaf").agg(F.sum("texts").alias("left")).where(F.col("left") >= min_texts).select("leaf")
    rest = stage(rest.join(open_leaves, "leaf"), "further-lines")
    size = F.call_function("div", F.octet_length("marks"), F.lit(4)).cast("int")
    most = F.floor(size * F.lit(1 - similar) + F.lit(1e-6)).cast("int")
    free = F.greatest(size - depth, F.lit(0))
    edge = lambda b: F.floor(b * free / (most + 1)).cast("int")
    part = lambda at, n: F.substring("marks", at * 4 - 3, n * 4)
    but_one = F.transform(F.sequence(F.lit(1), F.greatest(free, F.lit(1))), lambda b: F.xxhash64("leaf", b, part(F.lit(1), depth + b - 1), part(depth + b + 1, size)))
    runs = F.transform(F.sequence(F.lit(0), most), lambda b: F.xxhash64("leaf", b, part(depth + 1 + edge(b), edge(b + 1) - edge(b))))
    keyed = stage(rest.select("leaf", "line", "texts", F.explode(F.when(most == 1, but_one).otherwise(runs)).alias("key")), "line-keys")
    held = keyed.groupBy("key").agg(F.sum("texts").alias("key_texts"), F.count("*").alias("key_lines"))
    reach = keyed.join(held, "key").groupBy("leaf", "line").agg(
        (F.sum("key_texts") - F.sum("texts") + F.max("texts")).alias("reach"), F.max("key_lines").alias("key_lines")
    ).where((F.col("key_lines") > 1) | (F.col("reach") >= min_texts)).select("leaf", "line", "reach")
    shared = keyed.join(held.where("key_lines > 1").select("key"), "key")
    tops = shared.groupBy("key").agg(F.min("line").alias("b"))
    sets = components(shared.join(tops, "key").select(F.col("line").alias("a"), "b"))
    near = rest.join(reach, ["leaf", "line"]).join(sets.withColumnRenamed("node", "line"), "line", "left")
    near = stage(near.select(F.coalesce("component", "line").alias("component"), "line", "texts", "low", "marks", "reach"), "line-sets")
    most_lines = SET_LINES if set_lines is None else set_lines
    large = near.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > most_lines)
    large = stage(large.select("component", F.ceil(F.col("n") / most_lines).cast("int").alias("slices")), "large-sets")
    small = near.join(sized(large), "component", "left_anti")

    def lead(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("line").to_numpy(), table.column("texts").to_numpy()))[::-1]
        line, texts, reach = (table.column(c).to_numpy()[order] for c in ("line", "texts", "reach"))
        low, marks = table.column("low").fill_null(NONE).to_numpy()[order], marks_of(table)[order]
        lines, firsts, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        while at < len(line):
            if reach[at] >= min_texts:
                ball = (marks == marks[at]).mean(1) >= similar
                if texts[ball].sum() >= min_texts:
                    lines.append(line[ball])
                    firsts.append(np.full(len(lines[-1]), low[ball].min()))
                    at -= int(ball[:at].sum())
                    line, texts, low, marks, reach = (x[~ball] for x in (line, texts, low, marks, reach))
                    continue
            at += 1
        first = np.concatenate(firsts)
        return pa.table([pa.array(np.concatenate(lines)), pa.array(first, mask=first == NONE)], ["line", "first_doc"])

    found = small.groupBy("component").applyInArrow(lead, "line long, first_doc long")
    if large.isEmpty():
        return found
    return found.union(dealt_out(near.join(sized(large), "component"), similar, min_texts, HEADS if heads is None else heads))


def marks_of(table: pa.Table) -> np.ndarray:
    """The marks of lines of one length, a row for each line."""
    return np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint32).reshape(len(table), -1)


def dealt_out(near: DataFrame, similar: float, min_texts: int, heads: int) -> DataFrame:
    """``line, first_doc`` for the templates of sets of any size, dealt out over ``slices`` tasks each.

    In each round the next ``heads`` lines of every set are tried.  Each slice
    of a set says, as one bit a head, with which of them its lines agree; the
    texts are summed by equal bits, which is all that is needed to decide on
    the heads one after another, as if all lines were at hand.  Lines that
    joined leave; heads that failed stay as possible members.  A task holds
    one slice, or the different bits of a set, and no pair of lines is written.
    """

    def agreeing(lines: pa.Table, tried: pa.Table) -> pa.Table:
        tried = tried.sort_by("at")
        # token by token: each is one contiguous comparison
        tokens, tops = np.ascontiguousarray(marks_of(lines).T), marks_of(tried) if len(tried) else np.zeros((0, 1), np.uint32)
        agree = np.zeros((len(tops), len(lines)), bool)
        for j, top in enumerate(tops):
            same = np.zeros(len(lines), np.int32)
            for token, mark in zip(tokens, top, strict=True):
                same += token == mark
            agree[j] = same / len(tokens) >= similar
        held = np.flatnonzero(agree.any(0))
        bits = pa.array([row.tobytes() for row in np.packbits(agree[:, held], axis=0).T], pa.binary())
        return pa.table([*(lines.column(c).take(pa.array(held)) for c in ("component", "line", "texts", "low")), bits], ["component", "line", "texts", "low", "bits"])

    def settle(groups: pa.Table, tried: pa.Table) -> pa.Table:
        tried = tried.sort_by("at")
        rows = lambda t: np.frombuffer(b"".join(t.column("bits").to_pylist()), np.uint8).reshape(len(t), -1)
        bits, own = rows(groups), rows(tried)
        texts, low = groups.column("texts").to_numpy(), groups.column("low").fill_null(NONE).to_numpy()
        alone, first, leading = np.ones(len(groups), bool), np.full(len(groups), NONE), np.zeros(own.shape[1], np.uint8)
        for j in range(len(own)):
            if (own[j] & leading).any():
                continue
            ball = alone & ((bits[:, j // 8] >> (7 - j % 8)) & 1).astype(bool)
            if texts[ball].sum() >= min_texts:
                first[ball] = low[ball].min()
                alone &= ~ball
                leading[j // 8] |= 1 << (7 - j % 8)
        gone = pa.array(np.flatnonzero(~alone))
        return pa.table(
            [groups.column("component").take(gone), groups.column("bits").take(gone), pa.array(first[~alone], mask=first[~alone] == NONE)],
            ["component", "bits", "first_doc"],
        )

    near = stage(near.withColumn("slice", F.pmod(F.xxhash64("line"), "slices").cast("int")), "large-lines")
    order = W.partitionBy("component").orderBy(F.desc("texts"), F.desc("line"))
    open_ = F.col("reach") >= min_texts
    rest, found = near.withColumn("open", open_), None
    while True:
        tried = rest.where("open").withColumn("at", F.row_number().over(order)).where(F.col("at") <= heads)
        tried = stage(tried.select("component", "slices", "line", "marks", "at"), "tried-lines")
        if tried.isEmpty():
            break
        each = tried.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        marked = rest.groupBy("component", "slice").cogroup(each.groupBy("component", "slice")).applyInArrow(
            agreeing, "component long, line long, texts long, low long, bits binary"
        )
        marked = stage(marked, "agreeing-lines")
        groups = marked.groupBy("component", "bits").agg(F.sum("texts").alias("texts"), F.min("low").alias("low"))
        own = stage(tried.join(marked.select("line", "bits"), "line").select("component", "at", "bits"), "tried-bits")
        joined = stage(groups, "equal-bits").groupBy("component").cogroup(own.groupBy("component")).applyInArrow(settle, "component long, bits binary, first_doc long")
        gone = stage(marked.join(joined, ["component", "bits"]).select("line", "first_doc"), "settled-lines")
        found = gone if found is None else found.union(gone)
        now = tried.select("line", F.lit(True).alias("now"))
        rest = rest.join(gone.select("line"), "line", "left_anti").join(now, "line", "left")
        rest = stage(rest.withColumn("open", F.col("open") & F.col("now").isNull()).drop("now"), "large-lines")
    none = near.limit(0).select("line", F.lit(None).cast("long").alias("first_doc"))
    return none if found is None else found


def without_recurring(
    docs: DataFrame, depth: int = DEPTH, similar: float = SIMILAR, min_texts: int = MIN_TEXTS, report: bool = False,
    long: int = LONG, long_texts: int = LONG_TEXTS,
) -> DataFrame:
    """The documents without lines that recur across documents.

    A template recurs if at least ``min_texts`` different texts have it; equal
    texts count once, so copies of a document make none of its lines recur.
    Its lines stay in the document with the smallest id that has it and are
    dropped from all others.  A line of ``long`` words or more recurs word for
    word in ``long_texts`` different texts already.  Every count is a partial aggregate and every
    look-up an equi-join, so a line in a third of all documents is summed
    before it moves.  Texts are read three times and moved once.

    Keeps all rows and columns of ``docs`` and changes ``text`` alone; with
    ``report`` it returns ``doc_id, n_lines, n_removed, kept`` instead.  Blank
    lines stay; a text without dropped lines stays as it is to the byte, a
    null text stays null with no lines, and a text that loses all lines
    becomes empty.  Rows without an id count and lose nothing.  Rows that
    share an id lose what any of them may lose.  An empty table gives no rows.
    """
    lines = stage(distinct_lines(docs, depth), "lines")
    recurring = recurring_lines(lines, depth, similar, min_texts)
    exact = stage(long_lines(docs, depth, long), "long-lines")
    repeated = (
        exact.groupBy("line", "text_hash").agg(F.min("doc_id").alias("low"))
        .groupBy("line").agg(F.count("*").alias("texts"), F.min("low").alias("first_doc"))
        .where(F.col("texts") >= long_texts).select("line", "first_doc")
    )
    owner, dropped = free_name(docs, "owner_of_lines"), free_name(docs, "dropped_lines")
    drop = (
        lines.select("doc_id", "line").join(recurring, "line").select("line", "doc_id", "first_doc")
        .union(exact.select("doc_id", "line").join(repeated, "line").select("line", "doc_id", "first_doc"))
        .where("doc_id <> first_doc")
        .groupBy(F.col("doc_id").alias(owner)).agg(F.collect_set("line").alias(dropped))
    )
    marked = docs.join(drop, docs["doc_id"] == drop[owner], "left").drop(owner)

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                found = Lines(cut.column("text"), depth)
                lists = cut.column(dropped)
                of = np.repeat(np.arange(len(lists)), np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
                salt = np.uint64(0x9E3779B97F4A7C15)
                gone_keys = lists.flatten().to_numpy().view(np.uint64) + of.astype(np.uint64) * salt
                own = found.text.astype(np.uint64) * salt
                gone = np.isin(found.line + own, gone_keys) & (found.tokens > 0)
                gone |= np.isin(found.exact + own, gone_keys) & (found.tokens >= long)
                texts = cut.column("text").to_pylist()
                before = np.searchsorted(found.text, np.arange(len(texts) + 1))
                for i in np.unique(found.text[gone]).tolist():
                    a, b = before[i], before[i + 1]
                    stays = np.flatnonzero(~gone[a:b]) + a
                    texts[i] = b"".join(found.data[found.starts[k] : found.ends[k]].tobytes() for k in stays).decode().removesuffix("\n")
                kept = pa.array(texts, pa.string())
                if report:
                    removed = np.bincount(found.text[gone], minlength=len(texts))
                    yield pa.RecordBatch.from_arrays(
                        [cut.column("doc_id"), pa.array(np.diff(before)), pa.array(removed), kept], ["doc_id", "n_lines", "n_removed", "kept"]
                    )
                else:
                    names = [n for n in cut.schema.names if n != dropped]
                    yield pa.RecordBatch.from_arrays([kept if n == "text" else cut.column(n) for n in names], names)

    shape = "doc_id long, n_lines long, n_removed long, kept string" if report else docs.schema
    return marked.mapInArrow(cut_out, shape)
