"""Suffix arrays in numpy: Larsson-Sadakane refinement, Kasai prefixes, search.

The text of a shard is put in full suffix order, which the step from one suffix
to the next in Kasai's method needs.
"""

from __future__ import annotations

import numpy as np

WORD = 8
_BYTE_STEPS = np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64)


def packed_words(text: np.ndarray, pad: int) -> np.ndarray:
    """The 8 bytes from each place as one number that sorts as they do; ``pad``
    zero bytes follow the text."""
    data = np.concatenate([text, np.zeros(pad + WORD, np.uint8)]).astype(np.uint64)
    out = data[: len(text) + pad].copy()
    for i in range(1, WORD):
        out <<= np.uint64(8)
        out |= data[i : len(text) + pad + i]
    return out


def suffix_array(words: np.ndarray, n: int) -> np.ndarray:
    """Order of the ``n`` suffixes.

    The first sort is by 8 bytes. Then each group of equal suffixes is sorted by
    the group of the suffix h places on, h doubling; groups of one are done and
    are not touched again. Places are 32-bit numbers meanwhile, which takes half the
    memory traffic; a shard has less than two gigabytes.
    """
    order = np.argsort(words[:n], kind="stable").astype(np.int32)
    group = np.zeros(n + 1, np.int32)
    ranked = words[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    starts = np.flatnonzero(new).astype(np.int32)
    # A group is named by its first place, plus one; zero is beyond the text.
    group[order] = np.repeat(starts + np.int32(1), np.diff(np.append(starts, n)))
    open_ = np.flatnonzero(~(new & np.append(new[1:], True))).astype(np.int32)
    h = WORD
    while len(open_):
        suffixes = order[open_]
        key = group[suffixes].astype(np.int64) << 32
        key |= group[np.minimum(suffixes, n - h) + h] if h < n else 0
        place = np.argsort(key, kind="stable")
        suffixes = suffixes[place]
        order[open_] = suffixes
        key = key[place]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(key)))
        group[suffixes] = np.repeat(open_[starts] + np.int32(1), sizes)
        open_ = open_[~(new & np.append(new[1:], True))]
        h *= 2
    return order.astype(np.int64)


def common_prefixes(
    words: np.ndarray, order: np.ndarray, chains: np.ndarray, limit: int
) -> np.ndarray:
    """Bytes, up to ``limit``, that each suffix of ``order`` shares with the one
    before it.

    Kasai: the next suffix of the text shares at least one byte less with the one
    before it. ``chains`` are the places (n + 1) at which the text is cut; all
    chains advance together, one place a step.
    """
    n = len(order)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    shared = np.zeros(n, np.int32)
    begins, sizes = chains[:-1], np.diff(chains)
    longest = np.argsort(-sizes, kind="stable")
    begins, sizes = begins[longest], sizes[longest]
    h = np.zeros(len(begins), np.int64)
    for step in range(int(sizes[0]) if len(sizes) else 0):
        alive = int(np.searchsorted(-sizes, -step, "left"))
        at = begins[:alive] + step
        other = before[at]
        h = np.maximum(h[:alive] - 1, 0)
        h[other < 0] = 0
        todo = np.flatnonzero((other >= 0) & (h < limit))
        while len(todo):
            differ = words[at[todo] + h[todo]] ^ words[other[todo] + h[todo]]
            same = np.full(len(todo), WORD)
            some = differ > 0
            # Leading zero bytes of the difference are equal bytes.
            same[some] = 7 - np.searchsorted(_BYTE_STEPS, differ[some], "right")
            h[todo] += same
            todo = todo[~some & (h[todo] < limit)]
        np.minimum(h, limit, out=h)
        shared[at] = h
    return shared[order]


def compare(a: np.ndarray, at: np.ndarray, b: np.ndarray, to: np.ndarray, length: int) -> np.ndarray:
    """-1, 0, 1 for pairs of strings of ``length`` bytes in two packed texts."""
    out = np.zeros(len(at), np.int8)
    todo = np.arange(len(at))
    for i in range(0, length, WORD):
        # The last word reaches back, so that it ends with the string.
        i = min(i, length - WORD)
        x, y = a[at[todo] + i], b[to[todo] + i]
        out[todo] = (x > y).astype(np.int8) - (x < y)
        todo = todo[x == y]
        if not len(todo):
            break
    return out


def found_in(
    a: np.ndarray, at: np.ndarray, b: np.ndarray, sorted_to: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings at ``at`` of text ``a`` stand in the sorted places
    ``sorted_to`` of text ``b``: first place not smaller, and first place larger."""
    bounds = []
    for past_equal in (False, True):
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(sorted_to))
        while (active := np.flatnonzero(low < high)).size:
            middle = (low[active] + high[active]) // 2
            c = compare(b, sorted_to[middle], a, at[active], length)
            right = c <= 0 if past_equal else c < 0
            low[active[right]] = middle[right] + 1
            high[active[~right]] = middle[~right]
        bounds.append(low)
    return bounds[0], bounds[1]
