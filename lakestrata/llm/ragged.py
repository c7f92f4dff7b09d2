"""Rows of different lengths in flat arrays, and the number that each known word has.

Both grow by doubling, so that a worker keeps what it has learned from the words of
one batch for the next one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class Ragged:
    """Rows of numbers, one after the other."""

    def __init__(self, dtype: type):
        self.values = np.zeros(1 << 12, dtype)
        self.ends = np.zeros(1 << 10, np.int64)
        self.rows = 0

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        """Add rows of these sizes; ``values`` holds them one after the other."""
        used = int(self.ends[self.rows])
        while len(self.values) < used + len(values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while len(self.ends) < self.rows + len(sizes) + 1:
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.values[used : used + len(values)] = values
        self.ends[self.rows + 1 : self.rows + 1 + len(sizes)] = used + np.cumsum(sizes)
        self.rows += len(sizes)

    def sizes(self, rows: np.ndarray) -> np.ndarray:
        return self.ends[rows + 1] - self.ends[rows]

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of these rows, and how many there are before each (n + 1)."""
        begins, sizes = self.ends[rows], self.sizes(rows)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(int(ends[-1])) + np.repeat(begins - ends[:-1], sizes)
        return self.values[places], ends


class Lexicon(dict):
    """Number of each known word, in the order in which words came; -1 for others."""

    def __missing__(self, word: str) -> int:
        return -1

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def add(self, words: list[str]) -> None:
        self.update(zip(words, range(len(self), len(self) + len(words))))


def distinct_words(words: pa.Array) -> tuple[list[str], np.ndarray]:
    """The distinct strings of a column, and the place of each row's among them."""
    coded = words.dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), np.asarray(coded.indices)
