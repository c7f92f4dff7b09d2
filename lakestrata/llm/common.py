"""What several operators share: stored steps, text bytes, folds, word hashes."""

from __future__ import annotations

import ctypes
import gc
import os
import re
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import run_folder

SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"
_LETTERS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
BLOCK_BYTES = 4 << 20
KNOWN_WORDS = 1 << 17


def with_package(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query or stage whose Python workers find this package, whatever folder
    the session was started in. The package lies at the same path on every node,
    or is installed there."""
    root = str(Path(__file__).resolve().parents[2])

    @wraps(build)
    def run(spark: SparkSession, *rest) -> DataFrame:
        variables = spark.sparkContext.environment
        paths = [p for p in variables.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            variables["PYTHONPATH"] = os.pathsep.join([root, *paths])
        return build(spark, *rest)

    return run


def _give_back() -> None:
    """Memory that Python, Arrow and the C library keep for later goes back to the
    machine; an idle worker would hold it beside the next stage's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidied(work: Callable) -> Callable:
    """A function over the batches of a task that gives memory back at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            _give_back()

    return run


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Later steps read the files, so a lost executor costs no work before them,
    and row keys made before the write stay as they are.
    """
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_prefix(df: DataFrame, prefix: str) -> str:
    """``prefix``, made longer until no column of ``df`` begins with it."""
    names = [c.lower() for c in df.columns]
    while any(c.startswith(prefix.lower()) for c in names):
        prefix = f"_{prefix}"
    return prefix


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; a NULL key counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(n)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row begins (n + 1).

    A NULL row has no bytes.
    """
    column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    at = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]], at - at[0]


def raw_bytes(value: pa.Scalar) -> bytes:
    """The bytes of a string or binary value; none for NULL."""
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def small_batches(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batch in parts, so that what is made from it stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def row_blocks(at: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes each; a longer row is a run of its own."""
    first, rows = 0, len(at) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, min(last, rows)
        first = last


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_table()


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters and digits, A-Z lower-cased; bytes of other scripts count
    as letters."""
    return _LETTERS.findall(text.lower())


class WordHashes(dict):
    """64-bit hash of each word, remembered up to a fixed number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
