"""Best-fit packing of documents into sequences, planned on the histogram of lengths.

A document's ids are cut into pieces of at most ``size`` ids. How many pieces there
are of each length is all that the plan needs: best fit, longest first, places all
pieces of a length at once into groups of equally filled sequences. The plan is a
list of runs: so many pieces of a length, from this rank on, so many to a sequence.
It has a few rows per length, whatever the number of documents. Spark then gives
every piece its rank within its length, makes a slot of every place in a run, and
joins both on length and rank.
"""

from __future__ import annotations

import os
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import row_blocks, stored, text_bytes, tidied
from .ragged import Lexicon, Ragged, distinct_words

SEQUENCE_IDS = 4096
KNOWN_WORDS = 1 << 19
WORDS_A_TEXT = 200
SLOTS_A_ROW = 1 << 16
_PIECE = "doc_id long, piece int, start long, length int, ids binary, part int, place long"


class WordIds:
    """Ids of whole texts by a tokenizer that drops white space.

    What lies between white space is encoded once for each distinct word, many
    words in one text; the place of a token in that text says whose it is.
    Tokenizers whose pieces may hold white space encode every text whole.
    """

    def __init__(self, path: str):
        # Tasks are the parallel part; threads of its own would only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = self._drops_white_space()
        self._forget()

    def _drops_white_space(self) -> bool:
        together = self.tokenizer.encode("a b 1\t\n.", add_special_tokens=False).ids
        apart = [
            i
            for word in ("a", "b", "1", ".")
            for i in self.tokenizer.encode(word, add_special_tokens=False).ids
        ]
        return together == apart

    def _forget(self) -> None:
        self.known, self.ids = Lexicon(), Ragged(np.uint32)

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 100 * WORDS_A_TEXT):
            some = words[at : at + 100 * WORDS_A_TEXT]
            groups = [some[i : i + WORDS_A_TEXT] for i in range(0, len(some), WORDS_A_TEXT)]
            texts = [" ".join(g) for g in groups]
            for group, e in zip(groups, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
                lengths = np.fromiter(map(len, group), np.int64, len(group))
                begins = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
                first = np.fromiter((o[0] for o in e.offsets), np.int64, len(e.ids))
                owner = np.searchsorted(begins, first, "right") - 1
                self.ids.extend(np.array(e.ids, np.uint32), np.bincount(owner, minlength=len(group)))
            self.known.add(some)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many there are before
        each text (n + 1). NULL counts as empty."""
        texts = texts.fill_null("")
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            ends = np.concatenate([[0], np.cumsum([len(e.ids) for e in found])]).astype(np.int64)
            flat = [np.array(e.ids, np.uint32) for e in found]
            return np.concatenate([np.zeros(0, np.uint32), *flat]), ends
        words = pc.ascii_split_whitespace(texts)
        cuts = np.asarray(words.offsets).astype(np.int64)
        names, index = distinct_words(words.flatten())
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        numbers = self.known.numbers(names)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            first = len(self.known)
            self._learn([names[i] for i in new.tolist()])
            numbers[new] = np.arange(first, first + len(new))
        ids, ends = self.ids.take(numbers[index])
        return ids, ends[cuts - cuts[0]]


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    """One for all tasks of a worker process."""
    return WordIds(path)


def _ranks(values: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """How often each value came before, in ``seen`` and in this array; updates ``seen``."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    begins = np.flatnonzero(new)
    sizes = np.diff(np.append(begins, len(ordered)))
    ranks = np.empty(len(values), np.int64)
    ranks[order] = np.arange(len(values)) - np.repeat(begins, sizes) + seen[ordered]
    seen[ordered[begins]] += sizes
    return ranks


def cut_pieces(
    docs: DataFrame, tokenizer: str, size: int = SEQUENCE_IDS, end_id: int | None = 1
) -> DataFrame:
    """Every ``text`` of ``docs`` (doc_id, text) encoded, followed by ``end_id`` and cut
    into pieces of at most ``size`` ids; only a document's last piece is shorter.

    Columns: doc_id, piece (from 0), start (ids of the document before it), length,
    ids (little-endian uint32), and ``part`` and ``place``: the task that cut it and
    the pieces of the same length that this task cut before. Write the result (all
    columns or without ``ids``) before ``place_pieces`` reads it.

    A NULL or empty text is its end id alone, without ``end_id`` it has no piece.
    Rows that are alike are cut alike. ``tokenizer``: a file of the tokenizers library
    that every executor has.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = _word_ids(tokenizer), np.zeros(size + 1, np.int64)
        for batch in batches:
            for at, last in row_blocks(text_bytes(batch.column(1))[1]):
                rows = batch.slice(at, last - at)
                ids, ends = encoder(rows.column(1))
                if end_id is not None:
                    ids = np.insert(ids, ends[1:], end_id)
                    ends = ends + np.arange(len(ends))
                lengths = np.diff(ends)
                n_pieces = -(-lengths // size)
                row = np.repeat(np.arange(len(lengths)), n_pieces)
                if not len(row):
                    continue
                number = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = number * size
                length = np.minimum(lengths[row] - start, size)
                # Pieces follow one another without a gap, so their ends cut the ids.
                cuts = np.concatenate([[0], np.cumsum(length)]).astype(np.int32) * 4
                binary = pa.Array.from_buffers(
                    pa.binary(), len(row), [None, pa.py_buffer(cuts), pa.py_buffer(ids.astype("<u4"))]
                )
                yield pa.record_batch(
                    [
                        rows.column(0).take(pa.array(row)),
                        pa.array(number.astype(np.int32)),
                        pa.array(start),
                        pa.array(length.astype(np.int32)),
                        binary,
                        rows.column(2).take(pa.array(row)),
                        pa.array(_ranks(length, seen)),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids", "part", "place"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().alias("part")
    )
    return rows.mapInArrow(tidied(cut), _PIECE)


@dataclass(frozen=True)
class Run:
    """``pieces`` of ``length`` from rank ``first`` on: ``each`` to a sequence, from
    sequence ``sequence`` on, the first of each at ``offset``."""

    length: int
    first: int
    pieces: int
    each: int
    sequence: int
    offset: int


def plan_best_fit(counts: dict[int, int], size: int = SEQUENCE_IDS) -> list[Run]:
    """Best fit, longest first, for ``counts`` pieces of each length.

    A piece goes to the fullest sequence that has room for it. Sequences with equal
    room are a group; a length fills whole groups, cuts at most one, and opens at
    most one, so the plan grows with the number of lengths and not of pieces.
    """
    runs: list[Run] = []
    rooms: list[int] = []  # ascending
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, sequences)
    opened = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in groups:
                insort(rooms, room)
                groups[room] = []
            groups[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        if left and not 0 < length <= size:
            raise ValueError(f"a piece of {length} ids does not fit sequences of {size}")
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                n = -(-left // (size // length))
                put(size, opened, n)
                opened += n
                at = len(rooms) - 1
            room = rooms[at]
            first, n = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[at]
            each = room // length
            full = min(n, left // each)
            if full:
                runs.append(Run(length, rank, full * each, each, first, size - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:
                runs.append(Run(length, rank, left, left, first + full, size - room))
                put(room - left * length, first + full, 1)
                left, full = 0, full + 1
            put(room, first + full, n - full)
    return runs


def place_pieces(pieces: DataFrame, size: int = SEQUENCE_IDS) -> DataFrame:
    """``sequence_id`` and ``offset`` of every piece; all other columns but ``part``
    and ``place`` stay.

    ``pieces``: a stored result of ``cut_pieces``, or any stored table of which
    ``length`` says how long a row is and (``part``, ``place``) counts equal lengths.
    Sequences are filled without gaps from offset 0. The driver sees one count per
    length, ``size`` at most. An empty table gives an empty one.
    """
    spark = pieces.sparkSession
    counted = stored(
        pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts"
    )
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")
    )
    histogram = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    runs = plan_best_fit({r.length: r.n for r in histogram}, size)
    plan = spark.createDataFrame(
        [(r.length, r.first, r.pieces, r.each, r.sequence, r.offset) for r in runs],
        "length int, first long, pieces long, each int, sequence long, at int",
    )
    chunk = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1, F.lit(SLOTS_A_ROW)))
    last = F.least(F.col("chunk") + SLOTS_A_ROW, F.col("pieces")) - 1
    slots = (
        plan.withColumn("chunk", chunk)
        .repartition("length", "first", "chunk")
        .withColumn("i", F.explode(F.sequence(F.col("chunk"), last)))
        .select(
            F.col("length").alias("_length"),
            (F.col("first") + F.col("i")).alias("_rank"),
            (F.col("sequence") + F.expr("i div each")).alias("sequence_id"),
            (F.col("at") + F.col("i") % F.col("each") * F.col("length")).alias("offset"),
        )
    )
    ranked = pieces.join(before.hint("merge"), ["part", "length"]).withColumn(
        "_rank", F.col("_before") + F.col("place")
    )
    kept = [c for c in pieces.columns if c not in ("part", "place")]
    return (
        ranked.join(
            slots.withColumnRenamed("_length", "length").hint("merge"), ["length", "_rank"]
        ).select(*kept, "sequence_id", "offset")
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, size: int = SEQUENCE_IDS, end_id: int | None = 1
) -> DataFrame:
    """The packed sequences: sequence_id, n_ids, ids (little-endian uint32), and per
    piece in order its doc_id and length. A sequence is at most ``size`` ids, so a
    group is small."""
    pieces = stored(cut_pieces(docs, tokenizer, size, end_id), "pieces")
    row = F.struct("offset", "doc_id", "length", "ids")
    held = (
        place_pieces(pieces, size)
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(row)).alias("held"))
    )
    return held.select(
        "sequence_id",
        F.aggregate("held", F.lit(0), lambda n, piece: n + piece["length"]).alias("n_ids"),
        F.aggregate("held.ids", F.expr("X''"), lambda ids, part: F.concat(ids, part)).alias("ids"),
        F.col("held.doc_id").alias("doc_ids"),
        F.col("held.length").alias("lengths"),
    )
