"""Removal of long repeated strings by suffix arrays over shards.

Every 200-byte window has an anchor: its 48-byte string with the least hash. Equal
windows have equal anchors at equal places, so windows are dealt to shards by
anchor, and only those whose anchor occurs twice. The consecutive windows of one
anchor are a segment; equal segments are one with a count. Each shard sorts the
suffixes of its segments. A crowded anchor is cut over several shards. Windows of
these shards are cut at sampled splitters, and each range is merged by binary search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_bytes, row_blocks, stored, text_bytes
from .suffix import common_prefixes, found_in, packed_words, suffix_array

LENGTH = 200
GRAM = 48
SHARD_BYTES = 2 << 20
CROWDED = 4096
RANGE = 1 << 14
SAMPLES = 16
_BLOCK = 1 << 18
_CACHED = 1 << 14
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(48).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 48 bytes from each place."""
    with np.errstate(over="ignore"):
        h, size = _BYTES[data], 1
        kept = h
        while size < 32:
            h = h[:-size] * _power(size) + h[size:]
            size *= 2
            if size == 16:
                kept = h
        n = len(data) - GRAM + 1
        return h[:n] * _power(16) + kept[32 : 32 + n]


def anchors(data: np.ndarray, at: np.ndarray, length: int = LENGTH):
    """Of all rows of a block: row, hash and place of each anchor, and the first
    and last window that it stands for. Places count from the row's begin.

    Rows are taken some at a time, so that what is made of them stays in the cache.
    """
    found = []
    for a, b in row_blocks(at, _CACHED):
        row, *rest = _anchors(data[at[a] : at[b]], at[a : b + 1] - at[a], length)
        found.append((row + a, *rest))
    return tuple(map(np.concatenate, zip(*found))) if found else _anchors(data, at, length)


def _anchors(data: np.ndarray, at: np.ndarray, length: int):
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none.astype(np.uint64), none, none, none
    grams = gram_hashes(data)
    with np.errstate(over="ignore"):
        mixed = (grams ^ (grams >> np.uint64(31))) * _MIX
    # Of equal hashes the leftmost counts: the place stands in the low bits.
    least = mixed >> np.uint64(32) << np.uint64(32) | np.arange(len(mixed), dtype=np.uint64)
    width, size = length - GRAM + 1, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    least = np.minimum(least[: len(least) - rest], least[rest:])
    chosen = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(chosen)]
    inside = np.flatnonzero(np.arange(len(chosen)) + length <= at[row + 1])
    row, chosen = row[inside], chosen[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(inside))[: len(first)] - 1
    row, place = row[first], chosen[first]
    begin = at[row]
    return row, grams[place], place - begin, inside[first] - begin, inside[last] - begin


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def _all_anchors(texts: DataFrame) -> DataFrame:
    """k1, k2, text -> k1, k2, anchor, place: one row per anchor."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(2))
            for a, b in row_blocks(at, _BLOCK):
                row, grams, place, _, _ = anchors(data[at[a] : at[b]], at[a : b + 1] - at[a])
                counts = np.bincount(row, minlength=b - a)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        _lists(grams.view(np.int64), counts, pa.int64()),
                        _lists(place.astype(np.int32), counts, pa.int32()),
                    ],
                    names=["k1", "k2", "anchors", "places"],
                )

    found = texts.mapInArrow(
        find, "k1 long, k2 long, anchors array<long>, places array<int>"
    )
    return found.select(
        "k1", "k2", F.explode(F.arrays_zip("anchors", "places")).alias("a")
    ).select("k1", "k2", F.col("a.anchors").alias("anchor"), F.col("a.places").alias("place"))


_SEGMENTS = (
    "k1 long, k2 long, copies long, anchor long, s1 long, s2 long, first int, windows int, "
    "data binary"
)


def _segments(texts: DataFrame) -> DataFrame:
    """k1, k2, copies, places, text -> the segments of the anchors at those places."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(4))
            wanted = batch.column(3)
            for a, b in row_blocks(at, _BLOCK):
                base, ends = data[at[a] : at[b]], at[a : b + 1] - at[a]
                row, grams, place, first, last = anchors(base, ends)
                asked = [np.asarray(wanted[i].values, np.int64) for i in range(a, b)]
                sizes = np.fromiter(map(len, asked), np.int64, b - a)
                goal = np.repeat(np.arange(b - a), sizes) << 32 | np.concatenate(asked)
                kept = np.flatnonzero(np.isin(row << 32 | place, goal))
                row, grams, first, last = row[kept], grams[kept], first[kept], last[kept]
                whole = base.tobytes()
                begin = ends[row] + first
                parts = [
                    whole[x:y] for x, y in zip(begin.tolist(), (begin + last - first + LENGTH).tolist())
                ]
                prints = b"".join(xxhash.xxh3_128_digest(p) for p in parts)
                prints = np.frombuffer(prints, np.int64).reshape(-1, 2)
                rows = pa.array(row + a)
                yield pa.record_batch(
                    [
                        *(batch.column(i).take(rows) for i in range(3)),
                        pa.array(grams.view(np.int64)),
                        pa.array(prints[:, 0]),
                        pa.array(prints[:, 1]),
                        pa.array(first.astype(np.int32)),
                        pa.array((last - first + 1).astype(np.int32)),
                        pa.array(parts, pa.binary()),
                    ],
                    names=[f.split()[0] for f in _SEGMENTS.split(", ")],
                )

    return texts.select("k1", "k2", "copies", "places", "text").mapInArrow(cut, _SEGMENTS)


def window_hashes(data: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Hash of the ``length`` bytes from each place."""
    with np.errstate(over="ignore"):
        sizes, doubled = [1], [_BYTES[data]]
        while sizes[-1] * 2 <= length:
            h, size = doubled[-1], sizes[-1]
            doubled.append(h[:-size] * _power(size) + h[size:])
            sizes.append(size * 2)
        n = len(data) - length + 1
        out, done = doubled[-1][:n], sizes[-1]
        for size, h in zip(sizes[-2::-1], doubled[-2::-1]):
            if length & size:
                out = out * _power(size) + h[done : done + n]
                done += size
    return out


class _Shard:
    """Segments of a shard: packed text, sorted windows, owner of each place."""

    def __init__(self, table: pa.Table | pa.RecordBatch):
        column = table.column("data")
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        data, self.at = text_bytes(column)
        self.windows = np.asarray(table.column("windows")).astype(np.int64)
        self.n = len(data)
        self.words = packed_words(data, 2 * LENGTH + 64)

    def starts(self) -> np.ndarray:
        """Places at which a window of this shard begins."""
        ends = np.cumsum(self.windows)
        shift = np.repeat(self.at[:-1] - (ends - self.windows), self.windows)
        return np.arange(int(ends[-1]) if len(ends) else 0) + shift

    def sort(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the windows in order, and which equal the one before them."""
        order = suffix_array(self.words, self.n)
        shared = common_prefixes(self.words, order, self.at, LENGTH)
        is_start = np.zeros(self.n, bool)
        is_start[self.starts()] = True
        at = np.flatnonzero(is_start[order])
        if not len(at):
            return order[at], np.zeros(0, bool)
        # What a window shares with the window before it is the least of all
        # suffixes between; those after the last window count for none.
        least = np.minimum.reduceat(shared[: at[-1] + 1], np.concatenate([[0], at[:-1] + 1]))
        least[0] = 0
        return order[at], least >= LENGTH


def _twice(equal: np.ndarray) -> np.ndarray:
    """Which windows of a sorted shard occur in it again."""
    return equal | np.append(equal[1:], False)[: len(equal)]


_RUNS = "anchor long, s1 long, s2 long, begin int, stop int"


def _runs(table: pa.Table | pa.RecordBatch, at: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    """Segment, first and last window of the runs that ``places`` make up; the
    segments of ``table`` begin at ``at``."""
    places = np.sort(places)
    owner = np.searchsorted(at, places, "right") - 1
    new = np.ones(len(places), bool)
    new[1:] = (np.diff(places) != 1) | (np.diff(owner) != 0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(places))[: len(first)] - 1
    own = owner[first]
    rows = pa.array(own.astype(np.int64))
    keys = []
    for name in ("anchor", "s1", "s2"):
        column = table.column(name).take(rows)
        keys.append(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
    return pa.record_batch(
        [
            *keys,
            pa.array((places[first] - at[own]).astype(np.int32)),
            pa.array((places[last] - at[own]).astype(np.int32)),
        ],
        names=["anchor", "s1", "s2", "begin", "stop"],
    )


def _repeated_in_shard(key: tuple, table: pa.Table) -> pa.Table:
    shard = _Shard(table)
    order, equal = shard.sort()
    own = np.searchsorted(shard.at, order, "right") - 1
    again = _twice(equal) | (np.asarray(table.column("n")) > 1)[own]
    return pa.Table.from_batches([_runs(table, shard.at, order[again])])


_LISTED = {"s1": "long", "s2": "long", "n": "long", "data": "binary"}
_PARTS = (
    "anchor long, part long, "
    + ", ".join(f"{name} array<{kind}>" for name, kind in _LISTED.items())
    + ", sorted array<int>, equal array<boolean>"
)


def _sorted_part(key: tuple, table: pa.Table) -> pa.Table:
    """One row that holds a part of a crowded anchor, with its sorted windows."""
    order, equal = _Shard(table).sort()
    lists = [table.column(name).combine_chunks() for name in _LISTED]
    lists += [pa.array(order.astype(np.int32)), pa.array(equal)]
    return pa.table(
        [
            pa.array([key[0].as_py()], pa.int64()),
            pa.array([key[1].as_py()], pa.int64()),
            *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists),
        ],
        names=["anchor", "part", *_LISTED, "sorted", "equal"],
    )


def _values(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    """The numbers of a list; none for NULL."""
    cell = batch.column(name)[row]
    return cell.values.to_numpy(zero_copy_only=False) if cell.is_valid else np.zeros(0, np.int64)


def _row(batch: pa.RecordBatch, row: int, **more) -> pa.RecordBatch:
    """A row with the keys of a part; each further column is one list or value."""
    columns = {"anchor": batch.column("anchor").slice(row, 1), "part": batch.column("part").slice(row, 1)}
    for name, value in more.items():
        columns[name] = pa.array([value])
    return pa.record_batch(list(columns.values()), names=list(columns))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts -> the different windows of each by rank in its order, with a hash."""
    for batch in batches:
        for row in range(batch.num_rows):
            text, _ = text_bytes(batch.column("data")[row].values)
            ranks = np.flatnonzero(~_values(batch, "equal", row))
            hashes = window_hashes(text)[_values(batch, "sorted", row)[ranks]]
            yield _row(batch, row, ranks=ranks.astype(np.int32), hashes=hashes.view(np.int64))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts with ranks -> text of the part, ranks and places of these windows in order."""
    for batch in batches:
        for row in range(batch.num_rows):
            text, _ = text_bytes(batch.column("data")[row].values)
            ranks = np.sort(_values(batch, "ranks", row))
            places = _values(batch, "sorted", row)[ranks]
            yield _row(batch, row, text=text.tobytes(), ranks=ranks, places=places)


def _sampler(step: int):
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every ``step``-th window of a part, from a place that its number gives."""
        for batch in batches:
            for row in range(batch.num_rows):
                text = raw_bytes(batch.column("text")[row])
                keys = f"{batch.column('anchor')[row]} {batch.column('part')[row]}"
                chosen = _values(batch, "places", row)[xxhash.xxh64_intdigest(keys) % step :: step]
                yield pa.record_batch(
                    [
                        pa.array([batch.column("anchor")[row].as_py()] * len(chosen), pa.int64()),
                        pa.array([text[p : p + LENGTH] for p in chosen.tolist()], pa.binary()),
                    ],
                    names=["anchor", "window"],
                )

    return sample


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted windows of a part, cut at the splitters by binary search."""
    for batch in batches:
        for row in range(batch.num_rows):
            text, _ = text_bytes(batch.column("text").slice(row, 1))
            ranks, places = _values(batch, "ranks", row), _values(batch, "places", row)
            cell = batch.column("splitters")[row]
            splitters, at = text_bytes(cell.values if cell.is_valid else pa.array([], pa.binary()))
            cuts, _ = found_in(
                packed_words(splitters, LENGTH + 64),
                at[:-1],
                packed_words(text, LENGTH + 64),
                places,
                LENGTH,
            )
            edges = np.concatenate([[0], cuts, [len(places)]])
            for i in np.flatnonzero(np.diff(edges)).tolist():
                inside = slice(edges[i], edges[i + 1])
                windows = text[places[inside][:, None] + np.arange(LENGTH)]
                yield _row(batch, row, range=np.int32(i), ranks=ranks[inside], windows=windows.tobytes())


def _two_merged(words: np.ndarray, same: np.ndarray, blocks: list[np.ndarray]) -> np.ndarray:
    """Different windows of two sorted blocks in order, found by binary search of
    the one's in the other; ``same`` leads from a window to an equal one."""
    if len(blocks) == 1:
        return blocks[0]
    a, b = blocks
    low, high = found_in(words, a * LENGTH, words, b * LENGTH, LENGTH)
    met = high > low
    same[a[met]] = b[low[met]]
    return np.insert(b, low[~met], a[~met])


def _merged_range(key: tuple, table: pa.Table) -> pa.Table:
    """Pieces of all parts between two splitters -> ranks of windows in two parts."""
    data, at = text_bytes(table.column("windows").combine_chunks())
    words = packed_words(data, LENGTH + 64)
    edges = at // LENGTH
    same = np.arange(edges[-1])
    blocks = [np.arange(a, b) for a, b in zip(edges[:-1], edges[1:])]
    while len(blocks) > 1:
        blocks = [_two_merged(words, same, blocks[i : i + 2]) for i in range(0, len(blocks), 2)]
    while (same[same] != same).any():
        same = same[same]
    again = np.bincount(same, minlength=len(same))[same] > 1
    ranks = table.column("ranks").combine_chunks().flatten().filter(pa.array(again))
    counts = np.add.reduceat(again.astype(np.int64), edges[:-1])
    return pa.table(
        [table.column("anchor"), table.column("part"), _lists(ranks, counts, pa.int32())],
        names=["anchor", "part", "ranks"],
    )


def _runs_of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts with the ranks met in other parts -> runs of windows that occur again."""
    for batch in batches:
        for row in range(batch.num_rows):
            order, equal = _values(batch, "sorted", row), _values(batch, "equal", row).astype(bool)
            _, at = text_bytes(batch.column("data")[row].values)
            own = np.searchsorted(at, order, "right") - 1
            met = np.zeros(len(order), bool)
            met[_values(batch, "ranks", row)] = True
            # The first of equal windows stands for all of them.
            first = np.maximum.accumulate(np.where(equal, 0, np.arange(len(order))))
            again = _twice(equal) | met[first] | (_values(batch, "n", row) > 1)[own]
            anchor = pa.array([batch.column("anchor")[row].as_py()] * (len(at) - 1), pa.int64())
            keys = {name: batch.column(name)[row].values for name in ("s1", "s2")}
            yield _runs(pa.table({"anchor": anchor, **keys}), at, order[again])


def _met_in_parts(parts: DataFrame) -> DataFrame:
    """anchor, part, text, ranks, places: of each part the windows whose hash is in
    another part of the anchor too."""
    each = parts.mapInArrow(_hashed, "anchor long, part long, ranks array<int>, hashes array<long>")
    each = stored(
        each.select("anchor", "part", F.explode(F.arrays_zip("ranks", "hashes")).alias("w")).select(
            "anchor", "part", F.col("w.ranks").alias("rank"), F.col("w.hashes").alias("hash")
        ),
        "repeat-hashes",
    )
    shared = each.groupBy("anchor", "hash").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    ranks = (
        each.join(shared.select("anchor", "hash"), ["anchor", "hash"], "left_semi")
        .groupBy("anchor", "part")
        .agg(F.collect_list("rank").alias("ranks"))
    )
    return parts.join(ranks, ["anchor", "part"]).mapInArrow(
        _met, "anchor long, part long, text binary, ranks array<int>, places array<int>"
    )


def _in_ranges(met: DataFrame) -> DataFrame:
    """anchor, part, range, ranks, windows: each window once, in the range between
    sampled splitters that holds about ``RANGE`` windows of all parts."""
    step = max(1, RANGE // SAMPLES)
    samples = met.mapInArrow(_sampler(step), "anchor long, window binary")
    splitters = samples.groupBy("anchor").agg(F.sort_array(F.collect_list("window")).alias("all"))
    splitters = splitters.select(
        "anchor",
        F.array_distinct(F.filter("all", lambda w, i: i % SAMPLES == SAMPLES - 1)).alias("splitters"),
    )
    return met.join(splitters, "anchor", "left").mapInArrow(
        _pieces, "anchor long, part long, range int, ranks array<int>, windows binary"
    )


def _runs_of_crowded(segments: DataFrame) -> DataFrame:
    """Runs of the segments of crowded anchors, which are dealt to parts.

    Each part is sorted once. Windows that only one part holds stay where they are;
    the others go, once each, to the range of their order, where the parts' pieces
    are merged by binary search. What is sent grows with the windows, not with the
    pairs of parts.
    """
    parts = stored(
        segments.groupBy("anchor", "part").applyInArrow(_sorted_part, _PARTS), "repeat-parts"
    )
    met = stored(_met_in_parts(parts), "repeat-met")
    found = (
        _in_ranges(met)
        .groupBy("anchor", "range")
        .applyInArrow(_merged_range, "anchor long, part long, ranks array<int>")
        .groupBy("anchor", "part")
        .agg(F.flatten(F.collect_list("ranks")).alias("ranks"))
    )
    return parts.join(found, ["anchor", "part"], "left").mapInArrow(_runs_of_parts, _RUNS)


def _repeated_runs(segments: DataFrame) -> DataFrame:
    """anchor, s1, s2, begin, stop: windows of distinct segments that occur again."""
    distinct = segments.groupBy("anchor", "s1", "s2").agg(
        F.first("windows").alias("windows"),
        F.first("data").alias("data"),
        F.sum("copies").alias("n"),
    )
    distinct = stored(distinct, "repeat-segments")
    size = distinct.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    crowded = (
        distinct.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("members"))
        .filter(F.col("members") > CROWDED)
        .select("anchor", F.ceil(F.col("members") / F.lit(CROWDED)).alias("parts"))
    )
    crowded = stored(crowded, "repeat-crowded")
    shard = F.pmod(F.xxhash64("anchor"), F.lit(1 + size // SHARD_BYTES))
    within = (
        distinct.join(crowded, "anchor", "left_anti")
        .groupBy(shard.alias("shard"))
        .applyInArrow(_repeated_in_shard, _RUNS)
    )
    if crowded.isEmpty():
        return within
    part = F.pmod(F.xxhash64("s1", "s2"), F.col("parts")).cast("long")
    return within.unionByName(
        _runs_of_crowded(distinct.join(crowded, "anchor").withColumn("part", part))
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Each text without the bytes that a 200-byte string covers which also starts
    elsewhere: doc_id, n_bytes, n_removed, n_spans, kept (the bytes left).

    ``docs``: doc_id, text; other columns are not read. Texts are UTF-8 bytes; a
    NULL text has none. Strings are judged on the input, overlaps and the same
    document included; none reaches over the end of a document. Equal texts are
    compared once, with their count; every row is returned.
    """
    keyed = docs.select(
        "doc_id",
        "text",
        F.xxhash64("text").alias("k1"),
        F.xxhash64(F.lit("second"), "text").alias("k2"),
    )
    long_ = keyed.filter(F.octet_length("text") >= LENGTH)
    found = _all_anchors(long_.select("k1", "k2", "text"))
    counts = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    # Stored, as a join with sums in the same stage could not split a crowded anchor.
    twice = stored(counts.filter("n > 1").select("anchor"), "repeat-anchors")
    places = (
        found.join(twice, "anchor", "left_semi")
        .groupBy("k1", "k2")
        .agg(F.collect_set("place").alias("places"))
    )
    texts = long_.groupBy("k1", "k2").agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")
    )
    segments = stored(_segments(texts.join(places, ["k1", "k2"])), "repeat-places")
    runs = _repeated_runs(segments)
    spans = (
        segments.select("anchor", "s1", "s2", "k1", "k2", "first")
        .join(runs, ["anchor", "s1", "s2"])
        .groupBy("k1", "k2")
        .agg(
            F.collect_list(
                F.struct(
                    (F.col("first") + F.col("begin")).alias("begin"),
                    (F.col("first") + F.col("stop") + LENGTH).alias("stop"),
                )
            ).alias("spans")
        )
    )
    judged = keyed.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    return judged.mapInArrow(
        _cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = text_bytes(batch.column(1))
        spans = batch.column(2)
        removed, runs, kept = [], [], []
        for i in range(batch.num_rows):
            text = data[at[i] : at[i + 1]]
            if not spans[i].is_valid:
                removed.append(0)
                runs.append(0)
                kept.append(text.tobytes())
                continue
            found = spans[i].values
            edge = np.zeros(len(text) + 1, np.int64)
            np.add.at(edge, np.asarray(found.field("begin")), 1)
            np.add.at(edge, np.asarray(found.field("stop")), -1)
            gone = np.cumsum(edge[:-1]) > 0
            removed.append(int(gone.sum()))
            runs.append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()))
            kept.append(text[~gone].tobytes())
        yield pa.record_batch(
            [
                batch.column(0),
                pa.array(np.diff(at)),
                pa.array(removed, pa.int64()),
                pa.array(runs, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )
