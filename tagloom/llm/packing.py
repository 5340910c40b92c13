"""Pack tokenised documents into sequences of fixed length: shortest pack first over the length histogram."""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.arrays import slices
from tagloom.llm.shared import stage

SIZE = 2048
END_ID = 1
CACHED_WORDS, CACHED_LENGTH = 300_000, 48
#: A space between two white-space characters: only there may a token begin before a space and end after it.
_TIGHT = re.compile(r"\s (?:\s|\Z)")

PIECES = (
    "part long, rank long, doc_id long, start long, length long, doc_tokens long, ids binary, ids_crc32 long"
)


_PLAIN_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


class WordEncoder:
    """Encode texts with a byte-level BPE tokenizer file, remembering the ids of words.

    A space after a visible character always begins a token, so a text is the
    concatenation of its words, each with the space before it.  Texts with a
    space inside white space or with a special token's string are encoded as a
    whole, and so is every text if the file splits in another way than plain
    byte-level tokenizers do.  Returns ids as little-endian unsigned 32-bit numbers.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        described = json.loads(self.whole.to_str())
        self.special = [t["content"] for t in described["added_tokens"]]
        # only this way of splitting is known to part at spaces; any other file is encoded text by text
        self.splits = described.get("normalizer") is None and _PLAIN_BYTE_LEVEL.items() <= (described.get("pre_tokenizer") or {}).items()
        split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {
            bytes(byte[c] for c in token): i for token, i in described["model"]["vocab"].items() if token not in self.special
        }
        self.word = tiktoken.Encoding("words", pat_str=split, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}

    def _bytes(self, text: str) -> bytes:
        return np.array(self.word(text), "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not self.splits or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if _TIGHT.search(text):
            return self._bytes(text)
        words = text.replace(" ", "\0 ").split("\0") if "\0" not in text else None
        if words is None:
            return self._bytes(text)
        known, out = self.known, []
        for word in words:
            ids = known.get(word)
            if ids is None:
                ids = self._bytes(word)
                if len(known) < CACHED_WORDS and len(word) <= CACHED_LENGTH:
                    known[word] = ids
            out.append(ids)
        return b"".join(out)


def tokenise(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs(doc_id, text)`` and cut each document into pieces of ``size`` ids and a rest.

    Every document ends with ``end_id``; a null or empty text has just that.
    ``part`` and ``rank`` name a piece: the task that made it and its place
    among that task's pieces of the same length.  The table is staged, so
    these names stay when executors are lost.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = WordEncoder(tokenizer_path), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for cut in slices(batch):
                rows = []
                for doc_id, text in zip(cut.column("doc_id").to_pylist(), cut.column("text").to_pylist(), strict=True):
                    ids = encoder(text or "") + end
                    tokens = len(ids) // 4
                    for start in range(0, tokens, size):
                        own = ids[4 * start : 4 * (start + size)]
                        length = len(own) // 4
                        rows.append((part, seen[length], doc_id, start, length, tokens, own, zlib.crc32(own)))
                        seen[length] += 1
                names = [c.split()[0] for c in PIECES.split(",")]
                kinds = [pa.int64()] * 6 + [pa.binary(), pa.int64()]
                columns = zip(*rows, strict=True) if rows else [[]] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return stage(docs.select("doc_id", "text").mapInArrow(encode, PIECES), "pieces")


def packing_patterns(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is used, for ``counts`` pieces of each length.

    Lengths are placed longest first into the shortest open pack; a whole run
    of equal packs is filled at once, so the work follows the histogram and
    not the number of pieces.
    """
    packs: list[tuple[int, int, tuple[int, ...], int]] = []
    made = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            made += 1
            if packs and packs[0][0] + length <= size:
                filled, _, pattern, uses = heapq.heappop(packs)
                placed = min(uses, left)
                if uses > placed:
                    heapq.heappush(packs, (filled, made, pattern, uses - placed))
                    made += 1
                heapq.heappush(packs, (filled + length, made, (*pattern, length), placed))
            else:
                placed = left
                heapq.heappush(packs, (length, made, (length,), placed))
            left -= placed
    return [(pattern, uses) for _, _, pattern, uses in sorted(packs)]


def pattern_slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length, rows of first rank, first sequence and offset; ranks of a row take sequences in turn."""
    slots: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, uses in patterns:
        offset = 0
        for length in pattern:
            slots[length].append((taken[length], sequence, offset))
            taken[length] += uses
            offset += length
        sequence += uses
    return {length: np.array(rows, np.int64) for length, rows in slots.items()}


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Give each of the staged ``pieces`` its ``sequence_id`` and ``offset``.

    The histogram has at most ``size`` rows and is all that the driver sees.
    A piece's rank among all of its length is its rank in its task plus the
    pieces of earlier tasks; the ids themselves are not moved.  The slots sent
    to the tasks depend on the histogram's lengths alone, not on the number of
    pieces.  Returns all columns of ``pieces`` but the ids, and the two.
    """
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = pattern_slots(packing_patterns(counts, size))
    per_task = pieces.groupBy("part", "length").agg(F.count("*").alias("own"))
    order = Window.partitionBy("length").orderBy("part")
    ahead = per_task.select(
        F.col("part").alias("of_part"), F.col("length").alias("of_length"),
        (F.sum("own").over(order) - F.col("own")).alias("ahead"),
    )
    ranked = (
        pieces.drop("ids")
        .join(ahead, (F.col("part") == F.col("of_part")) & (F.col("length") == F.col("of_length")))
        .withColumn("place", F.col("rank") + F.col("ahead"))
        .drop("of_part", "of_length", "ahead")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("place").to_numpy()
            found = np.zeros((2, len(rank)), np.int64)
            for own in np.unique(length):
                rows, at = slots[int(own)], np.flatnonzero(length == own)
                slot = np.searchsorted(rows[:, 0], rank[at], "right") - 1
                found[0, at] = rows[slot, 1] + rank[at] - rows[slot, 0]
                found[1, at] = rows[slot, 2]
            columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "place"]
            names = [n for n in batch.schema.names if n != "place"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found[0]), pa.array(found[1])], [*names, "sequence_id", "offset"])

    fields = ", ".join(f"{n} {t}" for n, t in ranked.drop("place").dtypes)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def sequences(pieces: DataFrame, packed: DataFrame, size: int = SIZE, pad_id: int = 0) -> DataFrame:
    """The packed ids themselves: ``sequence_id, ids, doc_starts``, padded to ``size`` unless a power of two long."""

    def joined(parts: list, offsets: list) -> bytes:
        order = np.argsort(offsets)
        ids = b"".join(parts[i] for i in order)
        length = len(ids) // 4
        return ids if length & (length - 1) == 0 else ids + np.full(size - length, pad_id, "<u4").tobytes()

    def assemble(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        offsets = table.column("offset").to_pylist()
        return pa.table({
            "sequence_id": pa.array([key[0].as_py()]), "ids": pa.array([joined(table.column("ids").to_pylist(), offsets)], pa.binary()),
            "doc_starts": pa.array([sorted(offsets)], pa.list_(pa.int64())),
        })

    placed = packed.select("part", "length", "rank", "sequence_id", "offset")
    return (
        pieces.select("part", "length", "rank", "ids").join(placed, ["part", "length", "rank"])
        .groupBy("sequence_id").applyInArrow(assemble, "sequence_id long, ids binary, doc_starts array<long>")
    )
