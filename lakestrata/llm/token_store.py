"""Token ids in files of directly addressable codes, in ascending id order.

A token store is a Parquet folder. A row is a segment of consecutive ids:

``shard``, ``segment``  place of the segment in the order of the store
``first``               ids of the shard before the segment
``n_ids``               ids of the segment
``codes``               the ids (see ``dac``)
``doc_ids``, ``ends``   its documents, and how many ids come up to each end

Documents are not cut. Beside the segments, ``shards`` (one row per shard) holds
the ids of all shards before each.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import dac
from .common import row_blocks, text_bytes

SEGMENT_IDS = 1 << 18
KNOWN_PIECES = 1 << 20
ENCODED_AT_ONCE = 4 << 20
WORDS_A_TEXT = 100
_SEGMENT = (
    "shard int, segment int, first long, n_ids int, codes binary, "
    "doc_ids array<long>, ends array<int>"
)
# A space at either end of a text, or with white space beside it.
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_LOOSE = f"^ | $| {_WHITE}|{_WHITE} "


class _Known(dict):
    """Number of a word, -1 for a word that is not known."""

    def __missing__(self, word: str) -> int:
        return -1


class PieceEncoder:
    """Ids of whole texts by a tokenizer file, with the ids of known pieces kept.

    Byte-level pre-tokenizers never join what comes before a single space with
    what follows it, so a text is cut before such spaces and each distinct piece
    is encoded once. Texts with other white space around spaces or with the string of
    an added token, and texts of other tokenizers, are encoded whole. Strings of
    special tokens give those tokens, as in the library, unless ``special_as_text``.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        # Tasks are the parallel part; threads of its own would only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = "|".join([_LOOSE, *added])
        self.by_piece = "ByteLevel" in str(self.tokenizer.pre_tokenizer) and (
            self.tokenizer.normalizer is None
        )
        vocabulary = self.tokenizer.get_vocab()
        # A byte-level token has one character per byte.
        self.widths = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.widths[i] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.known = _Known()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 12, np.int64)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _learn(self, words: list[str], sizes: np.ndarray) -> None:
        """Encode words, each after a space, many in one text; where a word ends is
        seen from the bytes of its tokens."""
        groups = [words[i : i + WORDS_A_TEXT] for i in range(0, len(words), WORDS_A_TEXT)]
        flat = np.concatenate(self._encode([" " + " ".join(g) for g in groups]))
        goal = np.cumsum(sizes + 1)
        reached = np.cumsum(self.widths[flat])
        last = np.searchsorted(reached, goal)
        if not np.array_equal(reached[last], goal):
            raise ValueError("the tokenizer joins text over a single space")
        n, used = len(self.known), int(self.ends[len(self.known)])
        while len(self.ids) < used + len(flat):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.ends) < n + len(words) + 1:
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[used : used + len(flat)] = flat
        self.ends[n + 1 : n + 1 + len(words)] = used + last + 1
        self.known.update(zip(words, range(n, n + len(words))))

    def __call__(self, texts: pa.Array, end: Sequence[int] = ()) -> list[np.ndarray]:
        """Ids of each text, followed by ``end``; NULL counts as empty."""
        texts, end = texts.fill_null(""), np.array(end, np.uint32)
        if not self.by_piece:
            return [np.concatenate((ids, end)) for ids in self._encode(texts.to_pylist())]
        loose = np.asarray(pc.match_substring_regex(texts, self.whole))
        pieces = pc.split_pattern(texts.filter(pa.array(~loose)), " ")
        flat = pieces.flatten()
        cuts = np.asarray(pieces.offsets)
        cuts = cuts - cuts[0]
        # The first piece of a text follows no space and is encoded on its own.
        heads = iter(self._encode(flat.take(pa.array(cuts[:-1])).to_pylist()))
        coded = flat.dictionary_encode()
        if len(self.known) > KNOWN_PIECES:
            self._forget()
        words = coded.dictionary.to_pylist()
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        tails = np.ones(len(flat), bool)
        tails[cuts[:-1]] = False
        followed = np.zeros(len(words), bool)
        index = np.asarray(coded.indices)
        followed[index[tails]] = True
        new = np.flatnonzero((at < 0) & followed)
        if len(new):
            sizes = np.asarray(pc.binary_length(coded.dictionary)).astype(np.int64)
            first = len(self.known)
            self._learn([words[i] for i in new.tolist()], sizes[new])
            at[new] = np.arange(first, first + len(new))
        whole = iter(self._encode(texts.filter(pa.array(loose)).to_pylist()))
        ids, ends = self._gather(at[index[tails]])
        # Every text has one piece, its first, that is not among the tails.
        bounds = iter(ends[cuts - np.arange(len(cuts))].tolist())
        begin, out = next(bounds), []
        for is_loose in loose.tolist():
            if is_loose:
                out.append(np.concatenate((next(whole), end)))
            else:
                stop = next(bounds)
                out.append(np.concatenate((next(heads), ids[begin:stop], end)))
                begin = stop
        return out

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words with these numbers, one after the other, and how many
        there are before each word (n + 1)."""
        begins = self.ends[at]
        sizes = self.ends[at + 1] - begins
        ends = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(int(ends[-1])) + np.repeat(begins - ends[:-1], sizes)
        return self.ids[places], ends


@lru_cache(maxsize=1)
def _encoder(path: str, special_as_text: bool) -> PieceEncoder:
    """One for all tasks of a worker process."""
    return PieceEncoder(path, special_as_text)


def write_token_store(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = 0,
    special_as_text: bool = False,
) -> None:
    """Encode every ``text`` of ``docs`` (doc_id, text) and write the ids below ``path``.

    Documents follow in ascending doc_id order, NULL ids first; rows of one id in
    the order of a hash of their text. A NULL text is empty: only the end id is
    written. ``tokenizer``: a file of the tokenizers library that every executor
    has; strings of its special tokens are encoded as the library does it, or with
    ``special_as_text`` like any other text. Texts are spread by ranges of the key before they are encoded, so a task
    encodes once and writes its shard as it goes, a segment at a time.
    """
    spark = docs.sparkSession
    tail = [] if end_id is None else [end_id]

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, special_as_text)
        parts: list[np.ndarray] = []
        size, count, first, shard = 0, 0, 0, -1
        names: list[int | None] = []
        ends: list[int] = []

        def flush() -> pa.RecordBatch:
            nonlocal parts, size, count, first, names, ends
            codes = dac.encode(np.concatenate(parts))
            row = (shard, count, first, size, codes, names, ends)
            arrays = [
                pa.array([value], kind)
                for value, kind in zip(row, pa.schema(_FIELDS).types)
            ]
            first, count = first + size, count + 1
            parts, size, names, ends = [], 0, [], []
            return pa.record_batch(arrays, names=[n for n, _ in _FIELDS])

        for batch in batches:
            texts, shards = batch.column(1), batch.column(2)
            for at, last in row_blocks(text_bytes(texts)[1], ENCODED_AT_ONCE):
                encoded = encoder(texts.slice(at, last - at), tail)
                for i, ids in enumerate(encoded, at):
                    shard = shards[i].as_py()
                    parts.append(ids)
                    size += len(ids)
                    names.append(batch.column(0)[i].as_py())
                    ends.append(size)
                    if size >= SEGMENT_IDS:
                        yield flush()
        if parts:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), F.col("place")]
    # The row number only spreads equal rows over shards; their order is the same
    # either way.
    rows = (
        docs.select("doc_id", "text")
        .withColumn("place", F.xxhash64("text"))
        .withColumn("spread", F.monotonically_increasing_id())
        .repartitionByRange(*order, F.col("spread"))
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("shard"))
    )
    rows.mapInArrow(segments, _SEGMENT).write.parquet(f"{path}/segments")
    totals = _segments(spark, path).groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals.select(
        "shard", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")
    ).write.parquet(f"{path}/shards")


_FIELDS = [
    ("shard", pa.int32()),
    ("segment", pa.int32()),
    ("first", pa.int64()),
    ("n_ids", pa.int32()),
    ("codes", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())),
    ("ends", pa.list_(pa.int32())),
]


def _segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SEGMENT).parquet(f"{path}/segments")


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Segments and ``start``, the ids of the store before each."""
    shards = spark.read.schema("shard int, n_ids long, start long").parquet(f"{path}/shards")
    before = shards.select("shard", F.col("start").alias("before"))
    return (
        _segments(spark, path)
        .join(before, "shard")
        .withColumn("start", F.col("before") + F.col("first"))
        .drop("before")
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a store, from its files: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 (of its ids as little-endian uint32).
    An empty store has no rows.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                reader = dac.Reader(batch.column(1)[i].as_buffer().to_pybytes())
                names, ends = batch.column(2)[i].values, np.asarray(batch.column(3)[i].values)
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ids = memoryview(reader.slice(0, len(reader)).astype("<u4").tobytes())
                crcs = [
                    zlib.crc32(ids[4 * b : 4 * e]) for b, e in zip(begins.tolist(), ends.tolist())
                ]
                yield pa.record_batch(
                    [
                        names,
                        pa.array(begins + batch.column(0)[i].as_py()),
                        pa.array((ends - begins).astype(np.int64)),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return (
        _placed(spark, path)
        .select("start", "codes", "doc_ids", "ends")
        .mapInArrow(parts, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def read_ids(spark: SparkSession, path: str, begin: int, end: int) -> list[int]:
    """Ids of the store from place ``begin`` up to ``end``: only the segments that
    hold them are read, and of those only the chunks that are asked for. Places beyond
    the store, and any place of an empty store, give no ids."""
    wanted = _placed(spark, path).filter(
        (F.col("start") < end) & (F.col("start") + F.col("n_ids") > begin)
    )
    ids: list[int] = []
    for row in wanted.select("start", "n_ids", "codes").orderBy("start").toLocalIterator():
        first = max(begin - row.start, 0)
        last = min(end - row.start, row.n_ids)
        ids += dac.Reader(bytes(row.codes)).slice(first, last).tolist()
    return ids
