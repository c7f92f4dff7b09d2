"""Alignment of the tokens of two tokenizers over the bytes of the same text.

A token's bytes are a row of a token-byte incidence matrix in compressed sparse rows.
Gustavson's product A·Bᵀ goes through the rows of A and adds up the rows of Bᵀ that
they name: its entries are the overlap links, the pairs of tokens that share bytes,
with how many. Byte offsets where tokens of both end cut the tokens into groups; the
product of the token-group incidence matrices gives the shared-group links.

Both tokenizers cut before a single space that lies between other characters, so a
text is aligned piece by piece and a piece that comes again is not aligned again. Per
block of texts Spark stores the distinct pieces of each document and the id pairs of
each piece. Pair counts are summed over the corpus from one row per block and pair;
they come back to the blocks by a join on the pair, in which no pair has more rows
than there are blocks.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import row_blocks, stored, text_bytes, tidied
from .ragged import Lexicon, Ragged, distinct_words

KNOWN_PIECES = 1 << 18
PIECES_A_TEXT = 100
ALIGNED_BYTES = 1 << 18
# Spaces that do not lie between two characters other than white space.
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_LOOSE = f"^ | $| {_WHITE}|{_WHITE} "
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACE = "▁"


@dataclass
class Csr:
    """A sparse matrix by rows: row i has columns ``columns[starts[i]:starts[i + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        order = np.argsort(self.columns, kind="stable")
        sizes = np.bincount(self.columns, minlength=self.width)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        return Csr(starts, rows[order], self.values[order], len(self.starts) - 1)

    def times(self, other: Csr) -> Csr:
        """Gustavson's product: row i is the sum of the rows of ``other`` that row i
        names. Terms of a row are put in order and added by column."""
        sizes = np.diff(other.starts)[self.columns]
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        first = np.repeat(other.starts[self.columns] - (np.cumsum(sizes) - sizes), sizes)
        at = np.arange(len(first)) + first
        key = np.repeat(rows, sizes) * other.width + other.columns[at]
        value = np.repeat(self.values, sizes) * other.values[at]
        if len(key) and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else []
        key = key[new] if len(key) else key
        value = np.add.reduceat(value, new) if len(key) else value
        rows, columns = np.divmod(key, max(other.width, 1))
        starts = np.searchsorted(rows, np.arange(len(self.starts)))
        return Csr(starts, columns, value, other.width)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Row and column of every entry."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts)), self.columns


def byte_incidence(ends: np.ndarray) -> Csr:
    """Tokens × bytes, for tokens that lie one after the other and end at ``ends``."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(n), np.ones(n, np.int64), n)


def group_incidence(ends: np.ndarray, cuts: np.ndarray) -> Csr:
    """Tokens × groups: a token is in the group that ends where it ends or next."""
    n = len(ends)
    return Csr(np.arange(n + 1), np.searchsorted(cuts, ends), np.ones(n, np.int64), len(cuts))


def overlap_links(a_ends: np.ndarray, b_ends: np.ndarray) -> Csr:
    """A tokens × B tokens: the bytes that both cover."""
    return byte_incidence(a_ends).times(byte_incidence(b_ends).transposed())


def shared_group_links(a_ends: np.ndarray, b_ends: np.ndarray, cuts: np.ndarray) -> Csr:
    """A tokens × B tokens of the same group."""
    return group_incidence(a_ends, cuts).times(group_incidence(b_ends, cuts).transposed())


def byte_level_alphabet() -> dict[str, int]:
    """Character of each byte in byte-level vocabularies: printable bytes stand for
    themselves, the others for characters from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}


class _Vocabulary:
    """Bytes of every token."""

    def __init__(self, tokens: list[bytes]):
        self.bytes = Ragged(np.uint8)
        self.bytes.extend(
            np.frombuffer(b"".join(tokens), np.uint8), np.fromiter(map(len, tokens), np.int64, len(tokens))
        )


class PieceLinks:
    """What the two tokenizers make of each piece of text, kept for pieces that come again.

    ``a_path``: a byte-level file of the tokenizers library; strings of its added
    tokens are plain text. ``b_path``: a sentencepiece model that puts a space before
    a text. A piece stands behind a space.
    """

    def __init__(self, a_path: str, b_path: str):
        # Tasks are the parallel part; threads of its own would only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        names, alphabet = self.a.get_vocab(), byte_level_alphabet()
        tokens = [b""] * (max(names.values()) + 1)
        for token, i in names.items():
            tokens[i] = bytes(alphabet[c] for c in token if c in alphabet)
        self.a_bytes = _Vocabulary(tokens).bytes
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        # Pieces that reach over a space would join what is aligned apart.
        self.by_piece = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        tokens = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.b_bytes = _Vocabulary(tokens).bytes
        self.forget()

    def forget(self) -> None:
        self.known, self.groups = Lexicon(), []
        self.pairs = Ragged(np.int64)
        # a tokens, b tokens, groups, links, overlaps, shared-group links, 1 if lost
        self.figures = np.zeros((1 << 10, 7), np.int64)

    def _a_ids(self, pieces: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, each behind a space, and how many of each. Many pieces
        are one text; the bytes of the tokens say where a piece ends."""
        texts = [
            " " + " ".join(pieces[i : i + PIECES_A_TEXT])
            for i in range(0, len(pieces), PIECES_A_TEXT)
        ]
        found = self.a.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.int64) for e in found])
        goal = np.cumsum(sizes)
        reached = np.cumsum(self.a_bytes.sizes(ids))
        last = np.searchsorted(reached, goal)
        if not np.array_equal(reached[last], goal):
            raise ValueError("the tokenizer joins text over a single space")
        return ids, np.diff(np.concatenate([[-1], last]))

    def _b_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.b.encode(pieces, num_threads=1)
        n = np.fromiter(map(len, found), np.int64, len(found))
        flat = [i for ids in found for i in ids]
        return np.array(flat, np.int64), n

    def _learn(self, pieces: list[str]) -> None:
        """Align pieces that were not seen before."""
        spaced = [b" " + p.encode() for p in pieces]
        sizes = np.fromiter(map(len, spaced), np.int64, len(spaced))
        a, n_a = self._a_ids(pieces, sizes)
        b, n_b = self._b_ids(pieces)
        text = np.frombuffer(b"".join(spaced), np.uint8)
        kept = _same_bytes(self.a_bytes, a, n_a, text, sizes)
        kept &= _same_bytes(self.b_bytes, b, n_b, text, sizes)
        a, b = a[np.repeat(kept, n_a)], b[np.repeat(kept, n_b)]
        n_a, n_b = n_a * kept, n_b * kept
        a_ends = np.cumsum(self.a_bytes.sizes(a))
        b_ends = np.cumsum(self.b_bytes.sizes(b))
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        overlaps = overlap_links(a_ends, b_ends)
        i, j = overlaps.pairs()
        owner = np.repeat(np.arange(len(pieces)), n_a)
        count = lambda rows: np.bincount(owner[rows], minlength=len(pieces))
        together = a_ends[i] == b_ends[j]
        shared = shared_group_links(a_ends, b_ends, cuts).pairs()[0]
        piece_of_cut = owner[np.searchsorted(a_ends, cuts)]
        n_groups = np.bincount(piece_of_cut, minlength=len(pieces))
        n_links = count(i[together])
        self.pairs.extend(a[i[together]] << 32 | b[j[together]], n_links)
        rows = np.stack([n_a, n_b, n_groups, n_links, count(i), count(shared), ~kept], axis=1)
        first = len(self.known)
        while len(self.figures) < first + len(pieces):
            self.figures = np.concatenate([self.figures, np.zeros_like(self.figures)])
        self.figures[first : first + len(pieces)] = rows
        self.groups += _group_texts(a, b, a_ends, b_ends, cuts, n_groups)
        self.known.add(pieces)

    def learn(self, pieces: list[str]) -> None:
        """Align new pieces, so many at a time that matrices stay small."""
        sizes = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)
        for first, last in row_blocks(np.concatenate([[0], sizes]), ALIGNED_BYTES):
            self._learn(pieces[first:last])


def _same_bytes(
    vocabulary: Ragged, ids: np.ndarray, n: np.ndarray, text: np.ndarray, sizes: np.ndarray
) -> np.ndarray:
    """For every piece whether its tokens' bytes are those of the text."""
    found, ends = vocabulary.take(ids)
    ends = ends[np.concatenate([[0], np.cumsum(n)])]
    begins = np.cumsum(sizes) - sizes
    same = np.diff(ends) == sizes
    if same.all() and np.array_equal(found, text):
        return same
    for i in np.flatnonzero(same).tolist():
        same[i] = np.array_equal(
            found[ends[i] : ends[i + 1]], text[begins[i] : begins[i] + sizes[i]]
        )
    return same


def _joined(ids: np.ndarray, last: np.ndarray) -> pa.Array:
    """Decimal ids joined by commas, up to each of ``last``."""
    cuts = np.concatenate([[0], last + 1]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(cuts, pa.array(ids).cast(pa.string())), ",")


def _group_texts(
    a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray,
    cuts: np.ndarray, n_groups: np.ndarray,
) -> list[str]:
    """Per piece its groups as text, ``a1,a2|b1;a3|b2,b3``."""
    groups = pc.binary_join_element_wise(
        _joined(a, np.searchsorted(a_ends, cuts)), _joined(b, np.searchsorted(b_ends, cuts)), "|"
    )
    bounds = np.concatenate([[0], np.cumsum(n_groups)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(bounds, groups), ";").to_pylist()


@lru_cache(maxsize=1)
def _piece_links(a_path: str, b_path: str) -> PieceLinks:
    """One for all tasks of a worker process."""
    return PieceLinks(a_path, b_path)


_FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_shared"]
_BLOCK = (
    "block long, doc_id long, "
    + ", ".join(f"{c} long" for c in _FIGURES)
    + ", groups string, pieces binary, times binary, pairs array<long>, totals array<long>, "
    "places binary, cuts binary"
)


def _cut(texts: pa.Array, by_piece: bool) -> tuple[pa.Array, np.ndarray]:
    """Pieces of all texts and where each text's begin (n + 1). An empty text has none."""
    if not by_piece:
        lists = [[t] if t else [] for t in texts.to_pylist()]
    elif pc.any(pc.match_substring_regex(texts, _LOOSE)).as_py():
        lists = [_CUT.split(t) if t else [] for t in texts.to_pylist()]
    else:
        pieces = pc.split_pattern(texts, " ")
        if not pc.any(pc.equal(texts, "")).as_py():
            cuts = np.asarray(pieces.offsets).astype(np.int64)
            return pieces.flatten(), cuts - cuts[0]
        lists = [p if t else [] for p, t in zip(pieces.to_pylist(), texts.to_pylist())]
    cuts = np.concatenate([[0], np.cumsum([len(p) for p in lists])]).astype(np.int64)
    return pa.array([p for pieces in lists for p in pieces], pa.string()), cuts


def _linked(links: PieceLinks, rows: pa.RecordBatch, block: int) -> pa.RecordBatch:
    """Rows of a block: one per text, and one more for its pieces and their pairs."""
    pieces, cuts = _cut(rows.column(1).fill_null(""), links.by_piece)
    names, index = distinct_words(pieces)
    if len(links.known) > KNOWN_PIECES:
        links.forget()
    numbers = links.known.numbers(names)
    new = np.flatnonzero(numbers < 0)
    if len(new):
        first = len(links.known)
        links.learn([names[i] for i in new.tolist()])
        numbers[new] = np.arange(first, first + len(new))
    figures = links.figures[numbers]
    n_rows = len(cuts) - 1
    row = np.repeat(np.arange(n_rows), np.diff(cuts))
    sums = np.zeros((n_rows, figures.shape[1]), np.int64)
    full = np.flatnonzero(np.diff(cuts))
    if len(full):
        sums[full] = np.add.reduceat(figures[index], cuts[full], axis=0)
    # Bytes are joined piece by piece, so a text is lost where one of its pieces is.
    lost = sums[:, 6] > 0
    sums[lost] = 0
    kept = ~lost[row]
    # Distinct pieces of each text, and how often it holds them.
    key, times = np.unique(row[kept] * max(len(names), 1) + index[kept], return_counts=True)
    owner, piece = np.divmod(key, max(len(names), 1))
    bounds = np.searchsorted(owner, np.arange(n_rows + 1))
    codes, ends = links.pairs.take(numbers)
    pairs, places = np.unique(codes, return_inverse=True)
    used = np.bincount(piece, times, len(names))
    totals = np.bincount(places, np.repeat(used, np.diff(ends)), len(pairs)).astype(np.int64)
    texts = [links.groups[i] for i in numbers.tolist()]
    joined = [
        ";".join([texts[i] for i in index[first:last].tolist()]) if n else ""
        for first, last, n in zip(cuts[:-1].tolist(), cuts[1:].tolist(), sums[:, 0].tolist())
    ]
    as_bytes = lambda x, i: x[bounds[i] : bounds[i + 1]].astype("<u4").tobytes()
    none = [None]
    columns = [
        pa.array([block] * (n_rows + 1), pa.int64()),
        pa.concat_arrays([rows.column(0), pa.nulls(1, pa.int64())]),
        *(pa.array([*sums[:, c].tolist(), None], pa.int64()) for c in range(6)),
        pa.array(joined + none, pa.string()),
        pa.array([as_bytes(piece, i) for i in range(n_rows)] + none, pa.binary()),
        pa.array([as_bytes(times, i) for i in range(n_rows)] + none, pa.binary()),
        pa.array([None] * n_rows + [pairs], pa.list_(pa.int64())),
        pa.array([None] * n_rows + [totals], pa.list_(pa.int64())),
        pa.array([None] * n_rows + [places.astype("<u4").tobytes()], pa.binary()),
        pa.array([None] * n_rows + [ends.astype("<u4").tobytes()], pa.binary()),
    ]
    return pa.record_batch(columns, names=[c.split()[0] for c in _BLOCK.split(", ")])


def linked_blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Every ``text`` of ``docs`` (doc_id, text) aligned, in blocks of texts: a row per
    document, and per block one row without figures that holds its id pairs.

    ``groups`` holds the ids of a document's groups as text, ``a1,a2|b1;a3|b2,b3``;
    it may be left out of what is stored for ``count_links``.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, number = _piece_links(a_path, b_path), 0
        for batch in batches:
            for first, last in row_blocks(text_bytes(batch.column(1))[1]):
                rows = batch.slice(first, last - first)
                yield _linked(links, rows, rows.column(2)[0].as_py() << 32 | number)
                number += 1

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.spark_partition_id().cast("long").alias("part"),
    )
    return rows.mapInArrow(tidied(link), _BLOCK)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair (A id · 2³² + B id), count (links of the corpus that join it) and ``best``,
    1 if no other pair of the B id has more. A B id has no more pairs than A has ids."""
    counted = (
        blocks.filter(F.col("pairs").isNotNull())
        .select(F.explode(F.arrays_zip("pairs", "totals")).alias("x"))
        .groupBy(F.col("x.pairs").alias("pair"))
        .agg(F.sum("x.totals").alias("count"))
        .filter(F.col("count") > 0)
    )
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF))
    best = (F.col("count") == F.max("count").over(of_b)).cast("int").alias("best")
    return counted.select("pair", "count", best)


def count_links(blocks: DataFrame) -> DataFrame:
    """The documents of stored ``linked_blocks``, with ``n_best`` (links whose pair is
    the most frequent one of its B id) and ``count_sum`` (pair counts over links)."""
    counts = stored(pair_counts(blocks), "pair-counts")
    places = blocks.filter(F.col("pairs").isNotNull()).select(
        F.col("block").alias("of_block"), F.posexplode("pairs").alias("place", "pair")
    )
    found = places.join(counts, "pair").select("of_block", "place", "count", "best")
    fixed = [c.split()[0] for c in _BLOCK.split(", ")]
    others = [f for f in blocks.schema.fields if f.name not in fixed[9:] and f.name != "block"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)

    def sums(rows: pa.Table, counted: pa.Table) -> pa.Table:
        is_block = pc.is_valid(rows.column("places"))
        block = rows.filter(is_block)
        rows = rows.filter(pc.invert(is_block))
        places = np.frombuffer(block.column("places")[0].as_py(), "<u4")
        cuts = np.frombuffer(block.column("cuts")[0].as_py(), "<u4").astype(np.int64)
        n_pairs = int(places.max()) + 1 if len(places) else 0
        result = []
        for name in ("best", "count"):
            of_pair = np.zeros(n_pairs, np.int64)
            of_pair[counted.column("place").to_numpy()] = counted.column(name).to_numpy()
            before = np.concatenate([[0], np.cumsum(of_pair[places])])
            of_piece = np.diff(before[cuts])
            total = [
                int(of_piece[np.frombuffer(p, "<u4")] @ np.frombuffer(t, "<u4").astype(np.int64))
                for p, t in zip(rows.column("pieces").to_pylist(), rows.column("times").to_pylist())
            ]
            result.append(pa.array(total, pa.int64()))
        rows = rows.select([f.name for f in others])
        return rows.append_column("n_best", result[0]).append_column("count_sum", result[1])

    sides = blocks.drop("pairs", "totals").groupBy("block").cogroup(found.groupBy("of_block"))
    return sides.applyInArrow(sums, f"{schema}, n_best long, count_sum long")


def align_tokens(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b (tokens), n_groups, n_links (pairs of tokens that end at the
    same byte), n_overlaps (pairs that share bytes), n_shared (pairs in one group),
    groups (their ids as text), n_best and count_sum, for every row of ``docs``.

    A NULL or empty text, and one whose tokens do not give back its bytes, has no
    tokens: zeros and ''. Rows that are alike count each time. An empty table gives
    an empty result.
    """
    return count_links(stored(linked_blocks(docs, a_path, b_path), "linked"))
