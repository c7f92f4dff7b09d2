"""Benchmark decontamination by templates.

Numbers, units and names of a text become typed placeholders. Windows of the
resulting tokens are hash-joined with the windows of the benchmark items. Where
windows meet, the values behind the placeholders (slots) must be equal or map
one to one along an alignment; so a question asked with other numbers or names is
found, one whose values are mixed up is not, and a copy with one value changed is
found by its other windows. Placeholders alone are no evidence: such a window only
meets the same values, and other values need equal tokens around them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, free_prefix, raw_bytes, row_blocks, small_batches, stored, text_bytes, tidied

# Units that turn into a placeholder right after a number.
UNITS = (
    "%", "mm", "cm", "m", "km", "in", "inch", "inches", "ft", "feet", "mile", "miles",
    "mg", "g", "kg", "t", "oz", "lb", "lbs", "ton", "tons", "ml", "l", "liter", "liters",
    "litre", "litres", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h",
    "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years",
    "c", "f", "k", "degree", "degrees", "usd", "eur", "gbp", "dollar", "dollars", "cent",
    "cents", "euro", "euros", "v", "w", "kw", "hz", "khz", "mhz", "kb", "mb", "gb", "tb",
)

_BREAK, _WORD, _TITLED, _NUMBER, _UNIT = range(5)
_FILTER_BITS = 22
KNOWN_TOKENS = 1 << 17
SHORT_TOKEN = 64
TEXT_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HOLDERS = np.array([3, 5, 7], np.uint64) * _STEP


@dataclass(frozen=True)
class LeakSettings:
    """A document holds an item if it has at least ``coverage`` of the item's
    windows, or ``run`` of them in one alignment. Windows with other values than
    the item's count where the alignment has ``literals`` equal tokens, or half of
    those of a shorter item."""

    window: int = 5
    coverage: float = 0.8
    run: int = 9
    literals: int = 5


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _STEP
    return h ^ (h >> np.uint64(29))


def _word_hash(word: bytes) -> int:
    """What ``_hashes`` gives for this token."""
    if len(word) > SHORT_TOKEN:
        return xxhash.xxh64_intdigest(word)
    h = 0
    for byte in word:
        h = (h * int(_MIX) + byte + 1) % 2**64
    return int(_mixed(np.array([h], np.uint64))[0])


def _hashes(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each token of at most ``SHORT_TOKEN`` bytes, byte after byte for all
    tokens at once."""
    h = np.zeros(len(starts), np.uint64)
    order = np.argsort(starts - ends, kind="stable")  # longest first
    at, lengths = starts[order], (ends - starts)[order]
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right") if len(at) else []
    with np.errstate(over="ignore"):
        for i, n in enumerate(active):
            h[:n] = h[:n] * _MIX + (lower[at[:n] + i] + np.uint64(1))
        out = np.empty_like(h)
        out[order] = _mixed(h)
    return out


class _Codes(dict):
    """Kind and hash of tokens that are long or hold characters beyond ASCII."""

    def __missing__(self, token: bytes) -> tuple[int, int]:
        if len(self) >= KNOWN_TOKENS:
            self.clear()
        text = token.decode("utf-8", "replace")
        kind = _TITLED if text[:1].isupper() and not text.isupper() else _WORD
        if token[:1].isdigit():
            kind = _NUMBER
        lower = text.lower().encode()
        if lower in _UNIT_NAMES:
            kind = _UNIT
        value = self[token] = (kind, _word_hash(lower))
        return value


_UNIT_NAMES = {u.encode() for u in UNITS}
_UNIT_HASHES = np.sort(np.array([_word_hash(u) for u in sorted(_UNIT_NAMES)], np.uint64))


def _byte_classes() -> np.ndarray:
    """-1 for bytes between tokens, else the kind of a token that begins with the byte."""
    classes = np.full(256, -1, np.int8)
    classes[65:91] = classes[97:123] = classes[128:] = _WORD
    classes[48:58] = _NUMBER
    classes[np.frombuffer(b".!?:;\n", np.uint8)] = _BREAK
    classes[ord("%")] = _UNIT
    return classes


_CLASSES = _byte_classes()


@dataclass
class _Tokens:
    """Tokens of many texts in a row, without breaks. ``begins`` says where each
    text's begin (n + 1). ``forms`` are hashes in three forms, all with numbers and
    units typed, ``holders`` which tokens are placeholders in each; ``values`` are the
    hashes of the tokens as they are.

    Names are words in the first form. In the second a name is a capitalised word
    that does not begin a sentence, in the third any capitalised word.
    """

    text: bytes
    starts: np.ndarray
    ends: np.ndarray
    begins: np.ndarray
    values: np.ndarray
    forms: list[np.ndarray]
    holders: list[np.ndarray]

    def token(self, i: int) -> str:
        return self.text[self.starts[i] : self.ends[i]].lower().decode("utf-8", "replace")


def _tokens(texts: list[bytes], codes: _Codes) -> _Tokens:
    """Tokens are runs of letters (A-Z and all beyond ASCII), numbers with points or
    commas between digits, percent signs, and breaks: . ! ? : ; and line ends."""
    text = b"\n".join(texts)  # a break between texts
    data = np.frombuffer(text, np.uint8)
    classes = _CLASSES[data]
    points = np.flatnonzero((data == ord(".")) | (data == ord(",")))
    points = points[(points > 0) & (points < len(data) - 1)]
    digit = classes == _NUMBER
    classes[points[digit[points - 1] & digit[points + 1]]] = _NUMBER
    new = (classes == _BREAK) | (classes == _UNIT)
    new[1:] |= classes[1:] != classes[:-1]
    new[:1] = True
    cuts = np.append(np.flatnonzero(new), len(data))
    found = np.flatnonzero(classes[cuts[:-1]] >= 0)
    starts, ends = cuts[found], cuts[found + 1]
    kind = classes[starts]
    before_any = lambda flags: np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
    capitals = before_any((data >= 65) & (data <= 90))
    beyond = before_any(data >= 128)
    capital = capitals[ends] - capitals[starts]
    first = capitals[starts + 1] > capitals[starts]
    kind[(kind == _WORD) & first & (capital < ends - starts)] = _TITLED
    apart = np.flatnonzero((beyond[ends] > beyond[starts]) | (ends - starts > SHORT_TOKEN))
    ends_of_short = ends.copy()
    ends_of_short[apart] = starts[apart] + 1
    values = _hashes(LOWER[data], starts, ends_of_short)
    if len(apart):
        known = [
            codes[text[b:e]] for b, e in zip(starts[apart].tolist(), ends[apart].tolist())
        ]
        kind[apart] = [k for k, _ in known]
        values[apart] = np.array([h for _, h in known], np.uint64)
    before = np.concatenate([[_BREAK], kind[:-1]])
    # Only after a number does a unit differ from a word, and where it is capitalised.
    asked = np.flatnonzero((kind == _TITLED) | ((kind == _WORD) & (before == _NUMBER)))
    kind[asked[np.isin(values[asked], _UNIT_HASHES)]] = _UNIT
    kept = kind != _BREAK
    starts, ends = starts[kept], ends[kept]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    begins = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
    values, kind, before = values[kept], kind[kept], before[kept]
    number, titled = kind == _NUMBER, kind == _TITLED
    unit = (kind == _UNIT) & (before == _NUMBER)
    plain = values.copy()
    plain[number], plain[unit] = _HOLDERS[0], _HOLDERS[1]
    forms, holders = [plain], [number | unit]
    for named in (titled & (before != _BREAK), titled):
        form = plain.copy()
        form[named] = _HOLDERS[2]
        forms.append(form)
        holders.append(holders[0] | named)
    return _Tokens(text, starts, ends, begins, values, forms, holders)


def _window_hashes(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` tokens from each place."""
    total = np.full(len(at), np.uint64(size))
    with np.errstate(over="ignore"):
        for i in range(size):
            total ^= h[at + i]
            total *= _MIX
            total ^= total >> np.uint64(29)
        total *= _STEP
    return total ^ (total >> np.uint64(32))


def _among(h: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Which hashes pass the filter."""
    found = seen[h >> np.uint64(64 - _FILTER_BITS)]
    at = np.flatnonzero(found)
    found[at] = seen[h[at] & np.uint64((1 << _FILTER_BITS) - 1)]
    return found


def _windows_of(texts: list[bytes], n: int, codes: _Codes, seen: np.ndarray | None):
    """(text, position, positions of the text, tokens, hash, slots, their offsets) of
    all windows that pass the filter. A text of fewer than ``n`` tokens is one window."""
    t = _tokens(texts, codes)
    lengths = np.diff(t.begins)
    owner = np.repeat(np.arange(len(texts)), lengths)
    left = np.repeat(t.begins[1:], lengths) - np.arange(len(owner))
    # In the second and third form only windows with a capitalised word are new.
    named = t.holders[2] & ~t.holders[0]
    for size in range(1, n + 1):
        if size == n:
            at = np.flatnonzero(left >= n)
        else:
            at = t.begins[:-1][lengths == size]
        if not len(at):
            continue
        earlier: list[tuple[np.ndarray, np.ndarray]] = []
        for form, holder in zip(t.forms, t.holders):
            if earlier:
                count = np.concatenate([[0], np.cumsum(named)])
                at = at[count[at + size] > count[at]] if len(earlier) == 1 else at
            h = _window_hashes(form, at, size)
            # A window of placeholders alone goes by its values.
            literal = np.concatenate([[0], np.cumsum(~holder)])
            bare = np.flatnonzero(literal[at + size] == literal[at])
            h[bare] = _window_hashes(t.values, at[bare], size)
            new = np.ones(len(at), bool)
            for places, other in earlier:
                new &= h != other[np.searchsorted(places, at)]
            earlier.append((at, h))
            if seen is not None:
                new &= _among(h, seen)
            for i in np.flatnonzero(new).tolist():
                first, row = int(at[i]), int(owner[at[i]])
                holes = np.flatnonzero(holder[first : first + size]).tolist()
                slots = [t.token(first + j) for j in holes]
                positions = max(int(lengths[row]) - n, 0) + 1
                yield row, first - int(t.begins[row]), positions, size, h[i], slots, holes


def template_windows(
    rows: DataFrame, ids: list[str], n: int, seen: np.ndarray | None = None
) -> DataFrame:
    """One row per window of ``text``: the ``ids`` columns, ``pos``, ``total`` (window
    positions of the text), ``size`` (tokens of the window), ``h``, ``slots`` (values
    behind placeholders) and ``holes`` (their offsets in the window).

    With ``seen``, a filter of fixed size, only windows that may be among those
    it was made from. A window with capitalised words has up to three forms: names
    as words, names inside sentences typed, and all capitalised words typed.
    """
    rows = rows.select(*ids, "text")
    held = rows.sparkSession.sparkContext.broadcast(seen)
    schema = rows.select(
        *ids,
        F.lit(0).alias("pos"),
        F.lit(0).alias("total"),
        F.lit(0).alias("size"),
        F.lit(0).cast("long").alias("h"),
        F.array(F.lit("")).alias("slots"),
        F.array(F.lit(0)).alias("holes"),
    ).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, filter_ = _Codes(), held.value
        for whole in batches:
            for first, last in row_blocks(text_bytes(whole.column(len(ids)))[1], TEXT_BYTES):
                batch = whole.slice(first, last - first)
                texts = [raw_bytes(text) for text in batch.column(len(ids))]
                found = list(zip(*_windows_of(texts, n, codes, filter_))) or [[]] * 7
                row, pos, total, size, h, slots, holes = found
                keys = [batch.column(i).take(pa.array(row, pa.int64())) for i in range(len(ids))]
                yield pa.record_batch(
                    [
                        *keys,
                        pa.array(pos, pa.int32()),
                        pa.array(total, pa.int32()),
                        pa.array(size, pa.int32()),
                        pa.array(np.array(h, np.uint64).view(np.int64)),
                        pa.array(slots, pa.list_(pa.string())),
                        pa.array(holes, pa.list_(pa.int32())),
                    ],
                    names=[*ids, "pos", "total", "size", "h", "slots", "holes"],
                )

    return rows.mapInArrow(tidied(cut), schema)


def _filter_of(windows: DataFrame) -> np.ndarray:
    """Which of 2^22 places the hashes fall into, whatever their number."""
    h = F.col("h")
    mask = (1 << _FILTER_BITS) - 1
    places = F.array(
        F.shiftrightunsigned(h, 64 - _FILTER_BITS), h.bitwiseAND(F.lit(mask).cast("long"))
    )
    found = windows.select(F.explode(places).alias("p")).distinct().toPandas()
    seen = np.zeros(1 << _FILTER_BITS, bool)
    seen[found["p"].to_numpy(np.int64)] = True
    return seen


def _most_frequent(values: dict[int, tuple[str, str]]) -> set[tuple[str, str]]:
    """The pairs of values that stand at more places than any other pair with the
    same value on either side; of a tie, none."""
    often = Counter(values.values())
    most: list[Counter] = [Counter(), Counter()]
    for pair, n in often.items():
        for side, value in zip(most, pair):
            side[value] = max(side[value], n)
    holders = [Counter(p[i] for p, n in often.items() if most[i][p[i]] == n) for i in (0, 1)]
    return {
        p
        for p, n in often.items()
        if all(most[i][p[i]] == n and holders[i][p[i]] == 1 for i in (0, 1))
    }


def _counted(windows: list[dict], total: int, literals: int) -> tuple[list[int], bool]:
    """Of the windows of an alignment, the places of those whose slots are equal or
    do not contradict the most frequent mapping; and whether all slots are equal."""
    values = {}
    for w in windows:
        for hole, asked, given in zip(w["holes"], w["asked"], w["given"]):
            values[w["pos"] + hole] = (asked, given)
    kept = _most_frequent(values)
    equal = {w["pos"] for w in windows if w["asked"] == w["given"]}
    mapped, literal, size = set(equal), set(), windows[0]["size"]
    for w in windows:
        if w["pos"] in equal or kept.issuperset(zip(w["asked"], w["given"])):
            mapped.add(w["pos"])
            literal.update(range(w["pos"], w["pos"] + size))
    literal = {p for p in literal if p not in values or values[p][0] == values[p][1]}
    enough = len(literal) >= min(literals, (total - 1 + size) // 2)
    return sorted(mapped if enough else equal), all(a == g for a, g in values.values())


def _judged(literals: int):
    """total and, last, the windows of an alignment -> places that count, all equal."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch):
                totals = part.column("total").to_pylist()
                found = [
                    _counted(w.as_py(), total, literals)
                    for w, total in zip(part.column("windows"), totals)
                ]
                yield pa.record_batch(
                    [
                        *part.columns[:-1],
                        pa.array([p for p, _ in found], pa.list_(pa.int32())),
                        pa.array([same for _, same in found], pa.bool_()),
                    ],
                    names=[*part.schema.names[:-1], "places", "same"],
                )

    return tidied(judge)


def benchmark_leaks(
    docs: DataFrame, benchmark: DataFrame, settings: LeakSettings = LeakSettings()
) -> DataFrame:
    """Documents that hold a benchmark item: doc_id, text_hash, item_id,
    n_windows (of the item, found), coverage, exact (every slot has its own value).

    ``docs``: doc_id, text. ``benchmark``: item_id, text. Other columns are not
    read. A NULL or empty text holds nothing and is held by nothing; a text of
    fewer tokens than a window is one window and meets only equal sequences.
    Repeated rows give one result row; rows of one doc_id with other texts are
    told apart by text_hash, and NULL ids are kept.
    """
    s = settings
    items = stored(
        template_windows(benchmark.select("item_id", "text"), ["item_id"], s.window),
        "benchmark-windows",
    ).distinct()
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = template_windows(keyed, ["doc_id", "text_hash"], s.window, _filter_of(items))
    met = found.select(
        "doc_id", "text_hash", "h", F.col("pos").alias("at"), F.col("slots").alias("given")
    ).join(items.withColumnRenamed("slots", "asked"), "h")
    lines = (
        met.filter(F.size("asked") == F.size("given"))
        .groupBy("doc_id", "text_hash", "item_id", "total", (F.col("at") - F.col("pos")).alias("d"))
        .agg(F.collect_set(F.struct("pos", "size", "holes", "asked", "given")).alias("windows"))
        .select("doc_id", "text_hash", "item_id", "total", "windows")
    )
    judged = lines.select(
        "doc_id", "text_hash", "item_id", "total",
        F.array(F.lit(0)).alias("places"), F.lit(True).alias("same"),
    ).schema
    lines = lines.mapInArrow(_judged(s.literals), judged)
    covered = (
        lines.select(
            "doc_id", "text_hash", "item_id", "total", "same",
            F.size("places").alias("run"), F.explode("places").alias("place"),
        )
        .groupBy("doc_id", "text_hash", "item_id", "total")
        .agg(
            F.countDistinct("place").alias("n_windows"),
            F.max("run").alias("longest"),
            F.min("same").alias("exact"),
        )
    )
    coverage = F.col("n_windows") / F.col("total")
    return covered.filter((coverage >= s.coverage) | (F.col("longest") >= s.run)).select(
        "doc_id", "text_hash", "item_id", "n_windows", coverage.alias("coverage"), "exact"
    )


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, settings: LeakSettings = LeakSettings()
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns."""
    leak = free_prefix(docs, "leak_")
    leaks = (
        benchmark_leaks(docs, benchmark, settings)
        .select(F.col("doc_id").alias(f"{leak}id"), F.col("text_hash").alias(f"{leak}hash"))
        .distinct()
    )
    same = F.col("doc_id").eqNullSafe(F.col(f"{leak}id")) & (
        F.xxhash64("text") == F.col(f"{leak}hash")
    )
    return docs.join(leaks, same, "left_anti")
