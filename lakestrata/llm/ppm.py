"""Prediction by partial matching over bytes.

A context is the last bytes of a text, up to an order; the trie holds how often
each symbol followed each context. A symbol that a context has not seen costs an
escape to the next shorter one (method C: as likely as the number of different
symbols seen), where the symbols of the longer context are left out. Past the
empty context every remaining symbol is as likely as any other. Symbols are the
256 bytes and the end of a text; a text begins with a context of start marks.

All symbols that a context has seen its shorter contexts have seen too. So what
is left out after an escape is a fixed sum per context, and a whole block of
positions is scored by array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np

BITS = 9
END, START = 256, 257
SYMBOLS = 257


def grams(data: np.ndarray, at: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Context and symbol of every position, packed with 9 bits a symbol, the
    symbol lowest; and where each row's positions begin (a row has one more than
    bytes, for its end)."""
    rows, sizes = len(at) - 1, np.diff(at)
    pad = order + 1
    line = np.full(len(data) + rows * pad, START, np.uint16)
    shift = np.repeat(np.arange(rows) * pad + order, sizes)
    line[np.arange(len(data)) + shift] = data
    ends = at[1:] + np.arange(1, rows + 1) * pad - 1
    line[ends] = END
    packed = np.zeros(max(len(line) - order, 0), np.uint64)
    for i in range(order + 1):
        packed <<= np.uint64(BITS)
        packed |= line[i : len(line) - order + i]
    begins = at + np.arange(rows + 1)
    # Positions of start marks are not predicted.
    first = np.repeat(np.arange(rows) * order, sizes + 1)
    return packed[np.arange(begins[-1]) + first], begins


def mask(order: int) -> np.uint64:
    """The bits of a symbol and its last ``order`` symbols before."""
    return np.uint64((1 << BITS * (order + 1)) - 1)


class _Level:
    """Contexts of one order with what they have seen, sorted."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        contexts = keys >> np.uint64(BITS)
        first = np.flatnonzero(np.append(True, contexts[1:] != contexts[:-1])[: len(keys)])
        self.contexts = contexts[first]
        self.first = first.astype(np.int32)
        if len(first):
            self.total = np.add.reduceat(counts, first)
        else:
            self.total = np.zeros(0, np.int64)
        self.kinds = np.diff(np.append(first, len(keys))).astype(np.int32)
        # Occurrences, in the next shorter context, of the symbols seen here.
        self.excluded = np.zeros(len(first), np.int64)

    def exclude(self, shorter: "_Level", order: int) -> None:
        at = np.searchsorted(shorter.keys, self.keys & mask(order - 1))
        if len(self.first):
            self.excluded = np.add.reduceat(shorter.counts[at], self.first)


def _find(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value, or -1."""
    if not len(sorted_):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return np.where(sorted_[at] == values, at, -1)


class Trie:
    """Counts of all contexts up to an order, ready to score.

    ``low``: counts of orders 0 and 1 over all texts (packed pairs of order 1);
    ``high``: counts of the full order. For a part of the trie ``high`` holds the
    contexts of that part only. ``middle``: counts of order 2, where ``high`` does not
    hold all of the contexts of that order which it holds any of.
    """

    def __init__(self, order: int, low: tuple, high: tuple, middle: tuple | None = None):
        self.order = order
        self.levels: list[_Level] = []
        for m in range(order + 1):
            keys, counts = low if m < 2 else middle if m == 2 and middle else high
            folded, inverse = np.unique(np.asarray(keys, np.uint64) & mask(m), return_inverse=True)
            summed = np.bincount(inverse, counts, len(folded)).astype(np.int64)
            level = _Level(folded, summed)
            if m:
                level.exclude(self.levels[-1], m)
            self.levels.append(level)

    def log10(self, packed: np.ndarray) -> np.ndarray:
        """Log probability of each packed symbol after its context."""
        n = len(packed)
        out = np.zeros(n)
        todo = np.arange(n)
        # Totals that the longer context leaves out: occurrences and kinds.
        gone, gone_kinds = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for m in range(self.order, -1, -1):
            level = self.levels[m]
            keys = packed[todo] & mask(m)
            context = _find(level.contexts, keys >> np.uint64(BITS))
            pair = _find(level.keys, keys)
            known = context >= 0
            c = np.maximum(context, 0)
            if len(level.contexts):
                kinds = np.where(known, level.kinds[c] - gone_kinds[todo], 0)
                total = np.where(known, level.total[c] - gone[todo], 0)
                # Nothing new here: the level is passed at no cost.
                use = kinds > 0
                hit = use & (pair >= 0)
                whole = (total + kinds)[use].astype(float)
                share = np.where(hit[use], level.counts[np.maximum(pair[use], 0)], kinds[use])
                out[todo[use]] += np.log10(share / whole)
                gone[todo[known]] = level.excluded[c[known]]
                gone_kinds[todo[known]] = level.kinds[c[known]]
                todo = todo[~hit]
        out[todo] -= np.log10(np.maximum(SYMBOLS - gone_kinds[todo], 1))
        return out


class AdaptiveModel:
    """The same model as nested dictionaries, learning symbol by symbol.

    For short texts, and the plain statement of what ``Trie`` computes.
    """

    def __init__(self, order: int):
        self.order = order
        self.seen: dict[tuple, dict[int, int]] = {}

    def _contexts(self, history: list[int]) -> Iterator[tuple]:
        for m in range(self.order, -1, -1):
            yield tuple(history[len(history) - m :])

    def cost(self, history: list[int], symbol: int) -> float:
        excluded: set[int] = set()
        total = 0.0
        for context in self._contexts(history):
            counts = self.seen.get(context)
            if counts is None:
                continue
            left = {s: c for s, c in counts.items() if s not in excluded}
            if left:
                whole = sum(left.values()) + len(left)
                if symbol in left:
                    return total + log10(left[symbol] / whole)
                total += log10(len(left) / whole)
            excluded = set(counts)
        return total - log10(max(SYMBOLS - len(excluded), 1))

    def learn(self, history: list[int], symbol: int) -> None:
        for context in self._contexts(history):
            counts = self.seen.setdefault(context, {})
            counts[symbol] = counts.get(symbol, 0) + 1

    def score(self, text: bytes, learn: bool, score: bool = True) -> float:
        """Log probability of a text and its end, learning it as it goes if asked."""
        history, total = [START] * self.order, 0.0
        for symbol in [*text, END]:
            if score:
                total += self.cost(history, symbol)
            if learn:
                self.learn(history, symbol)
            history = [*history[1:], symbol] if self.order else history
        return total
