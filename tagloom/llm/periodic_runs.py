"""Find stretches of words that repeat with a period, from Lyndon arrays that grouping of suffixes yields."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tagloom.llm.arrays import powers, slices, utf8, window_hashes, word_hashes, words_of

LEAST, POWER, GRAM = 6, 4, 4
_STEP = 0xD6E8FEB86659FD93 | 1
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """For each place the length of the longest Lyndon word that starts there, by the first phase of grouping.

    Suffixes start in groups by their first symbol and groups are taken from
    the highest down (Baier, 2016).  Every suffix of the group at hand points
    to the nearest place on its left that lies in a lower group; a place with
    more pointers moves higher, right above the group it leaves, and its known
    prefix grows by that of each suffix that points to it.  In the end this
    prefix is the longest Lyndon word at its place.  The end of the text is
    below every symbol.  Takes time in proportion to the text but for the
    union-find over places whose group is done.
    """
    length = len(symbols)
    lengths = [1] * length
    names = sorted(set(symbols))
    first = {s: k for k, s in enumerate(names)}
    group = [first[s] for s in symbols]
    members: list[list[int]] = [[] for _ in names]
    for place, own in enumerate(group):
        members[own].append(place)
    below = list(range(-1, len(names) - 1))
    above = [*range(1, len(names)), -1]
    left = list(range(length + 1))  # shifted by one; 0 stands before the text
    at = len(names) - 1
    while at >= 0:
        own = [place for place in members[at] if group[place] == at]
        members[at] = []
        if own:
            step = lengths[own[0]]
            for place in own:
                left[place + 1] = place
            pointers: dict[int, int] = {}
            for place in own:
                root = place
                while left[root] != root:
                    root = left[root]
                walk = place + 1
                while left[walk] != root and walk != root:
                    left[walk], walk = root, left[walk]
                if root:
                    pointers[root - 1] = pointers.get(root - 1, 0) + 1
            moves: dict[tuple[int, int], list[int]] = {}
            for place, times in pointers.items():
                moves.setdefault((-times, group[place]), []).append(place)
            for (times, old), places in sorted(moves.items()):
                new = len(members)
                members.append(places)
                over = above[old]
                below.append(old)
                above.append(over)
                above[old] = new
                if over >= 0:
                    below[over] = new
                for place in places:
                    group[place] = new
                    lengths[place] -= times * step
        at = below[at]
    return lengths


class Prefixes:
    """Hashes of all stretches of a text, for common-extension questions that a direct comparison then settles."""

    def __init__(self, symbols: np.ndarray):
        values = np.random.default_rng(77).integers(1, 2**63, int(symbols.max()) + 1 if len(symbols) else 1, np.uint64)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(values[symbols] * powers(_STEP, len(symbols)), out=self.sums[1:])
        self.back = powers(_STEP, len(symbols) + 1, True)

    def of(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return (self.sums[starts + sizes] - self.sums[starts]) * self.back[starts]


def extension(symbols: np.ndarray, low: int, period: int) -> tuple[int, int]:
    """The largest stretch around ``low`` and ``low + period`` whose symbols ``period`` apart are equal: start and end."""
    end, step = low, 64
    while True:
        upto = min(end + step, len(symbols) - period)
        differ = symbols[end:upto] != symbols[end + period : upto + period]
        if differ.any():
            end += int(differ.argmax())
            break
        end = upto
        if end >= len(symbols) - period:
            break
        step *= 2
    start, step = low, 64
    while start > 0:
        down = max(0, start - step)
        differ = (symbols[down:start] != symbols[down + period : start + period])[::-1]
        if differ.any():
            start -= int(differ.argmax())
            break
        start, step = down, step * 2
    return start, end + period


def runs_in(symbols: np.ndarray, least: int = LEAST, power: int = POWER) -> list[tuple[int, int, int]]:
    """All runs of ``max(least, power * period)`` symbols or more: sorted ``(start, length, period)``.

    Every run has a Lyndon root under one of the two orders, and it is the
    longest Lyndon word at its place (Bannai et al., 2017).  Of both arrays
    those roots stay that, by their hashes, repeat ``power - 1`` times on the
    right; the leftmost root of a run does.  Each is extended to both sides.
    """
    if len(symbols) < least:
        return []
    _, ranks = np.unique(symbols, return_inverse=True)
    count = len(ranks)
    prefixes, found = Prefixes(ranks), set()
    places = np.arange(count)
    for ordered in (ranks, ranks.max() - ranks):
        sizes = np.array(lyndon_lengths(ordered.tolist()))
        fits = places + (power - 1) * sizes <= count
        at, size = places[fits], sizes[fits]
        alike = prefixes.of(at, (power - 2) * size) == prefixes.of(at + size, (power - 2) * size)
        ends: dict[int, int] = {}
        for low, period in zip(at[alike].tolist(), size[alike].tolist(), strict=True):
            if low + period <= ends.get(period, 0):
                continue  # inside the run found last
            start, end = extension(ranks, low, period)
            ends[period] = max(end, low)
            if end - start >= max(least, power * period):
                found.add((start, end - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def segments(hashes: np.ndarray, text: np.ndarray, least: int = LEAST, gram: int = GRAM) -> list[tuple[int, int]]:
    """Stretches of words that may hold runs: all their ``gram`` consecutive words stand elsewhere in the text too.

    In a run of ``max(6, 4 * period)`` words every four consecutive ones recur
    a period away, and a word that extends a run belongs to such four as well.
    So no run, and no extension of one, leaves its stretch.
    """
    if len(hashes) < least:
        return []
    grams = window_hashes(hashes, gram) ^ (text[: len(hashes) - gram + 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    inside = np.flatnonzero(text[: len(grams)] == text[gram - 1 :])
    order = inside[np.argsort(grams[inside], kind="stable")]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = grams[order[1:]] == grams[order[:-1]]
    often = np.zeros(len(grams), bool)
    often[order[same[1:] | same[:-1]]] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[0], often.astype(np.int8), [0]])))
    cuts = []
    for low, high in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        owner = text[low:high]
        parts = [low, *(low + 1 + np.flatnonzero(owner[1:] != owner[:-1])).tolist(), high]
        cuts += [(a, b + gram - 1) for a, b in zip(parts, parts[1:], strict=False) if b - a + gram - 1 >= least]
    return cuts


def find_runs(docs: DataFrame, key: str = "doc_id", column: str = "text", least: int = LEAST, power: int = POWER) -> DataFrame:
    """Periodic runs of the words of each text: ``doc_id, n_words, runs, collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  A run ``(start,
    length, period)`` is a stretch with smallest period ``period`` and at least
    ``max(least, power * period)`` words that no neighbouring word extends;
    runs are sorted by start, then period.  ``collapsed`` are the words, joined
    by one space, without those that a run holds after its first ``period``.

    Each document is searched where it is read, by itself, and nothing is
    shuffled.  ``power`` and ``least`` of 4 and 6 or more keep the search of
    ``segments`` exact; less is refused.

    Null, empty and blank texts have no words and no runs.  Rows are returned
    as they come, with repeated, null and equal keys; other columns are
    ignored; an empty table gives no rows.
    """
    if power < 4 or least < 6:
        raise ValueError("runs have at least six words and four periods")
    kind = docs.schema[key].dataType

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, column):
                data, offsets = utf8(cut.column(column))
                starts, ends, before = words_of(data, offsets)
                hashes = word_hashes(data, starts, ends)
                owner = np.repeat(np.arange(cut.num_rows), np.diff(before))
                rows: list[list[tuple[int, int, int]]] = [[] for _ in range(cut.num_rows)]
                for low, high in segments(hashes, owner, least):
                    own = int(owner[low])
                    shift = low - int(before[own])
                    rows[own] += [(s + shift, n, p) for s, n, p in runs_in(hashes[low:high], least, power)]
                texts = []
                for i, own in enumerate(rows):
                    words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                    if own:
                        gone = np.zeros(len(words) + 1, np.int32)
                        for start, size, period in own:
                            gone[start + period] += 1
                            gone[start + size] -= 1
                        words = [w for w, g in zip(words, np.cumsum(gone)[:-1].tolist(), strict=True) if not g]
                    texts.append(b" ".join(words).decode())
                listed = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in rows]
                yield pa.RecordBatch.from_arrays(
                    [cut.column(key), pa.array(np.diff(before).astype(np.int64)), pa.array(listed, RUN_TYPE), pa.array(texts, pa.string())],
                    [key, "n_words", "runs", "collapsed"],
                )

    shape = f"`{key}` {kind.simpleString()}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select(key, column).mapInArrow(search, shape)
