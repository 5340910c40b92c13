"""External induced suffix sorting with common-prefix lengths, in numpy.

The queues of suffixes (positions and common-prefix lengths) go to disk.  The
text at two bytes a symbol, symbol types, run lengths (8 bytes a symbol) and
the sorted seeds stay in memory, so a text is a shard of bounded size.  Follows eSAIS (Bingmann, Fischer and Osipov, 2013).
"""

from __future__ import annotations

import tempfile
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np

MEMORY_ITEMS = 4 << 20


class SymbolQueues:
    """A priority queue of (position, common prefix) tuples by first symbol, first in first out.

    Tuples of a symbol leave in the order they came.  When more than ``limit``
    tuples wait, all go to an unnamed temporary file, which vanishes with the
    process.
    """

    def __init__(self, limit: int):
        self.limit, self.held, self.waiting, self.file = limit, defaultdict(list), 0, None

    def push(self, symbol: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        self.held[symbol].append((positions, prefixes))
        self.waiting += len(positions)
        if self.waiting > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for runs in self.held.values():
            for i, run in enumerate(runs):
                if isinstance(run[0], np.ndarray):
                    at = self.file.tell()
                    self.file.write(np.ascontiguousarray(run[0]).tobytes())
                    self.file.write(np.ascontiguousarray(run[1]).tobytes())
                    runs[i] = (at, len(run[0]))
        self.waiting = 0

    def take(self, symbol: int, backwards: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The runs that wait under a symbol now; ``backwards`` gives the last run first."""
        runs, block, count = self.held.pop(symbol, []), [], 0
        for first, second in reversed(runs) if backwards else runs:
            if not isinstance(first, np.ndarray):
                self.file.seek(first)
                both = self.file.read(12 * second)
                first, second = np.frombuffer(both, np.int64, second), np.frombuffer(both, np.int32, second, 8 * second)
            else:
                self.waiting -= len(first)
            block.append((first, second))
            count += len(first)
            if count >= self.limit:
                yield self._joined(block, backwards)
                block, count = [], 0
        if block:
            yield self._joined(block, backwards)

    @staticmethod
    def _joined(block: list, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
        block = block[::-1] if backwards else block
        return block[0] if len(block) == 1 else tuple(np.concatenate(part) for part in zip(*block, strict=True))


class LeastSince:
    """The smallest common prefix among the tuples extracted after a given one, as a stack of running minima."""

    def __init__(self):
        self.ranks, self.values, self.count = np.zeros(0, np.int64), np.zeros(0, np.int32), 0

    def after(self, rank: int) -> int:
        at = np.searchsorted(self.ranks, rank, "right")
        return int(self.values[at]) if at < len(self.values) else np.iinfo(np.int32).max

    def add(self, prefixes: np.ndarray) -> None:
        low = np.minimum.accumulate(prefixes[::-1])[::-1]
        last = np.ones(len(low), bool)
        last[:-1] = low[:-1] < low[1:]
        keep = np.searchsorted(self.values, low[0])
        self.ranks = np.concatenate([self.ranks[:keep], np.flatnonzero(last) + self.count])
        self.values = np.concatenate([self.values[:keep], low[last]])
        self.count += len(prefixes)


def larger_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is larger than the next one; the last one is."""
    change = np.concatenate([np.flatnonzero(text[1:] != text[:-1]), [len(text) - 1]])
    down = np.ones(len(change), bool)
    down[:-1] = text[change[:-1]] > text[change[:-1] + 1]
    return np.repeat(down, np.diff(np.concatenate([[-1], change])))


def run_lengths(text: np.ndarray) -> np.ndarray:
    """How many equal symbols begin each suffix."""
    change = np.concatenate([np.flatnonzero(text[1:] != text[:-1]), [len(text) - 1]])
    return np.repeat(change, np.diff(np.concatenate([[-1], change]))) - np.arange(len(text)) + 1


class Induction:
    """One pass over the suffixes in order, which puts each suffix's left neighbour of one type into its queue."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, limit: int):
        self.text, self.wanted, self.queues = text, wanted, SymbolQueues(limit)
        self.least, self.last = LeastSince(), {}

    def extract(self, positions: np.ndarray, prefixes: np.ndarray) -> None:
        """Take tuples in order; each prefix is that shared with the tuple extracted just before.

        Two neighbours with the same first symbol share one symbol more than
        the smallest prefix extracted between their parents.
        """
        left = positions - 1
        parents = np.flatnonzero((left >= 0) & self.wanted[left])
        symbols = self.text[left[parents]]
        order = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[order]
        begins = np.concatenate([[0], np.flatnonzero(sorted_symbols[1:] != sorted_symbols[:-1]) + 1, [len(order)]])
        upto = np.minimum.accumulate(prefixes)
        for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
            if a == b:
                continue
            symbol, own = int(sorted_symbols[a]), parents[order[a:b]]
            shared = np.zeros(b - a, np.int32)
            if symbol in self.last:
                shared[0] = 1 + min(int(upto[own[0]]), self.least.after(self.last[symbol]))
            if b - a > 1:
                shared[1:] = 1 + np.minimum.reduceat(prefixes[: own[-1] + 1], own[:-1] + 1)
            self.last[symbol] = self.least.count + int(own[-1])
            self.queues.push(symbol, left[own], shared)
        self.least.add(prefixes)


def direct_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Symbols that the suffixes at ``a`` and ``b`` share, compared one by one up to ``most``."""
    out, alive, step = np.zeros(len(a), np.int64), np.arange(len(a)), 0
    while len(alive):
        x, y = a[alive] + step, b[alive] + step
        inside = (np.maximum(x, y) < len(text)) & (step < most[alive])
        alive, x, y = alive[inside], x[inside], y[inside]
        alive = alive[text[x] == text[y]]
        step += 1
        out[alive] = step
    return out


def named_parts(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, names and lengths of the parts from each start to the next one, inclusive.

    Several symbols make one key; ties continue with the next key.  A part
    that ends before another is the larger one, except at the text's end.
    """
    ends = np.append(starts[1:] + 1, len(text) + 1)
    lengths = ends - starts
    width = max(2, int(text.max() + 3).bit_length())
    per = 63 // width
    infinite = (1 << width) - 1

    def keys(which: np.ndarray, step: int) -> np.ndarray:
        key = np.zeros(len(which), np.int64)
        for j in range(step * per, (step + 1) * per):
            at = starts[which] + j
            held = at < np.minimum(ends[which], len(text))
            symbol = np.where(held, text[np.minimum(at, len(text) - 1)].astype(np.int64) + 1, infinite)
            key = key << width | np.where((at == len(text)) & (at < ends[which]), 0, symbol)
        return key

    def ranked(groups: np.ndarray, key: np.ndarray, base: np.ndarray):
        order = np.lexsort((key, groups))
        g, k = groups[order], key[order]
        fresh_group = np.concatenate([[True], g[1:] != g[:-1]])
        fresh = fresh_group | np.concatenate([[True], k[1:] != k[:-1]])
        place = np.arange(len(order))
        inside = place - np.maximum.accumulate(np.where(fresh_group, place, 0))
        first = np.maximum.accumulate(np.where(fresh, place, 0)) - (place - inside)
        out = np.empty(len(order), np.int64)
        out[order] = base[order] + first
        return out

    everything = np.arange(len(starts))
    rank = ranked(np.zeros(len(starts), np.int64), keys(everything, 0), np.zeros(len(starts), np.int64))
    step = 1
    while True:
        members = np.bincount(rank, minlength=len(starts))
        tied = np.flatnonzero((members[rank] > 1) & (lengths >= step * per))
        if not len(tied):
            break
        rank[tied] = ranked(rank[tied], keys(tied, step), rank[tied])
        step += 1
    order = np.argsort(rank, kind="stable")
    names = np.empty(len(starts), np.int64)
    names[order] = np.cumsum(np.concatenate([[0], np.diff(rank[order]) > 0]))
    return order, names, lengths


def doubled_order(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a short string of names in order, and the prefixes they share, by doubling compared lengths."""
    count, ranks, rank = len(names), [], names.astype(np.int64)
    while True:
        ranks.append(rank.astype(np.int32))
        step = 1 << (len(ranks) - 1)
        if int(rank.max()) == count - 1:
            order = np.argsort(rank, kind="stable")
            break
        after = np.zeros(count, np.int64)
        after[: max(0, count - step)] = rank[step:] + 1
        key = rank * (count + 1) + after
        order = np.argsort(key, kind="stable")
        rank = np.empty(count, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) > 0]))
    x, y, shared = order[:-1].copy(), order[1:].copy(), np.zeros(count - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        inside = np.flatnonzero(np.maximum(x, y) < count)
        equal = inside[ranks[level][x[inside]] == ranks[level][y[inside]]]
        x[equal] += 1 << level
        y[equal] += 1 << level
        shared[equal] += 1 << level
    return order, np.concatenate([[0], shared])


def seed_order(text: np.ndarray, starts: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The seed suffixes in order and the symbols each shares with the one before."""
    order, names, lengths = named_parts(text, starts)
    if int(names.max()) == len(starts) - 1:
        a, b = starts[order[:-1]], starts[order[1:]]
        return starts[order], np.concatenate([[0], direct_prefixes(text, a, b, np.maximum(lengths[order[:-1]], lengths[order[1:]]))])
    if len(names) <= limit:
        order, shared = doubled_order(names)
    else:
        positions, prefixes = [], []
        sorted_suffixes(names, lambda p, q: (positions.append(p), prefixes.append(q)), limit)
        order = np.concatenate(positions)[::-1]
        shared = np.concatenate([[0], np.concatenate(prefixes)[1:][::-1]])
    x, y, h = order[:-1], order[1:], shared[1:]
    whole = starts[x + h] - starts[x]
    rest = direct_prefixes(text, starts[x + h], starts[y + h], np.maximum(lengths[x + h], lengths[y + h]))
    return starts[order], np.concatenate([[0], whole + rest])


def sorted_suffixes(text: np.ndarray, emit: Callable[[np.ndarray, np.ndarray], object], limit: int = MEMORY_ITEMS) -> None:
    """Pass all suffixes of ``text`` to ``emit`` in falling order, each with the prefix shared with the one before.

    Seeds are the suffixes smaller than both the next and the previous one.
    They are sorted by their parts; names of equal parts make a shorter text,
    sorted the same way (in memory if it has at most ``limit`` names).  From
    the seeds, one pass induces the order of larger suffixes and a second
    one, backwards, that of smaller suffixes.
    """
    count, larger, runs = len(text), larger_types(text), run_lengths(text)
    symbols = np.unique(text).tolist()
    starts = np.flatnonzero(~larger[1:] & larger[:-1]) + 1
    seeds = SymbolQueues(limit)
    if len(starts):
        ordered, shared = seed_order(text, starts, limit)
        firsts = text[ordered]
        begins = np.concatenate([[0], np.flatnonzero(firsts[1:] != firsts[:-1]) + 1, [len(firsts)]])
        for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
            seeds.push(int(firsts[a]), ordered[a:b].astype(np.int64), shared[a:b].astype(np.int32))
        del ordered, shared, firsts
    up, found = Induction(text, larger, limit), SymbolQueues(limit)
    up.extract(np.array([count]), np.zeros(1, np.int32))
    for symbol in symbols:
        before = None
        while symbol in up.queues.held:
            for positions, prefixes in up.queues.take(symbol):
                found.push(symbol, positions, prefixes)
                up.extract(positions, prefixes)
                before = positions[-1]
        for positions, prefixes in seeds.take(symbol):
            prefixes = prefixes.copy()
            prefixes[0] = 0 if before is None else min(runs[before], runs[positions[0]])
            up.extract(positions, prefixes)
    down = Induction(text, ~larger, limit)
    for symbol in reversed(symbols):
        before = None
        while symbol in down.queues.held:
            for positions, prefixes in down.queues.take(symbol):
                emit(positions, prefixes)
                down.extract(positions, prefixes)
                before = positions[-1]
        following = 0
        first = True
        for positions, prefixes in found.take(symbol, backwards=True):
            shared = np.empty_like(prefixes)
            shared[1:] = prefixes[:0:-1]
            if first:
                shared[0] = 0 if before is None else min(runs[before], runs[positions[-1]])
            else:
                shared[0] = following
            following, first = prefixes[0], False
            emit(positions[::-1], shared)
            down.extract(positions[::-1], shared)
