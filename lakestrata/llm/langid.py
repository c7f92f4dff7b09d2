"""Language identification in two steps: the family, then the language within it.

Linear support vector machines over frequencies of byte n-grams: one against the
rest for families, one against one for the languages of a family.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fits_broadcast
from .common import LOWER, free_prefix, row_blocks, stored, text_bytes

# Languages by family, as ISO 639 codes. Others make up a family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af lb fy yi",
    "romance": "fr es it pt ro ca gl oc ast rm sc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu se",
    "turkic": "tr az kk ky uz tt tk",
    "indic": "hi ur bn pa gu mr ne si sa or as",
    "iranian": "fa ps ku tg",
    "semitic": "ar he am mt",
    "dravidian": "ta te kn ml",
    "sinitic": "zh yue wuu",
    "malayic": "id ms jv su tl",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

UNKNOWN = "und"
SIZES = (2, 3, 4)
BINS = 15
_SCALE = 16.0
_MULTIPLIER = np.uint32(2654435761)


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], "other")


def gram_bins(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Bin of the n-gram that begins at each byte, for each n. Zero bytes stand
    between rows, so that no n-gram holds bytes of two."""
    rows, pad = len(at) - 1, max(SIZES) - 1
    line = np.zeros(len(data) + rows * pad + pad, np.uint32)
    places = np.arange(len(data)) + np.repeat(np.arange(rows) * pad, np.diff(at))
    line[places] = LOWER[data]
    packed = np.zeros_like(line)
    out = []
    for n in range(max(SIZES)):
        packed[: len(line) - n] |= line[n:] << np.uint32(8 * n)
        if n + 1 in SIZES:
            salted = packed[places] * _MULTIPLIER ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
            out.append((salted * _MULTIPLIER) >> np.uint32(32 - BINS))
    return out


@dataclass(frozen=True)
class LanguageSettings:
    """``per_language`` and ``per_family`` bound the distinct labelled texts that the
    machines of a language and of a family learn from. A family of more than
    ``members`` languages is cut into several, so pairs grow with the languages and
    not with their square."""

    per_language: int = 1500
    per_family: int = 6000
    members: int = 16
    epochs: int = 6
    regularization: float = 1e-4


@dataclass(frozen=True)
class LanguageModel:
    """Weights of each machine by n-gram bin, with the bias as last number."""

    families: tuple[str, ...]
    languages: dict[str, tuple[str, ...]]
    family_weights: np.ndarray
    pair_weights: dict[tuple[str, str], np.ndarray]


def _machine(rows: list, signs: np.ndarray, s: LanguageSettings, seed: int) -> np.ndarray:
    """Primal sub-gradient descent on the hinge loss, balanced by class."""
    w, scale = np.zeros((1 << BINS) + 1), 1.0
    rng = np.random.default_rng(seed)
    sides = [np.flatnonzero(signs > 0), np.flatnonzero(signs < 0)]
    step = 0
    total = np.zeros_like(w)
    for epoch in range(s.epochs):
        for i in range(len(rows)):
            side = sides[i % 2]
            row = side[rng.integers(len(side))]
            at, x = rows[row]
            step += 1
            # The first steps would be huge; an offset tames them.
            rate = 1.0 / (s.regularization * (step + 1 / s.regularization))
            margin = signs[row] * scale * (w[at] @ x)
            scale *= 1.0 - rate * s.regularization
            if margin < 1:
                w[at] += signs[row] * rate / scale * x
        if epoch * 2 >= s.epochs:
            total += scale * w
    return total


def _features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    bins = np.concatenate(gram_bins(data, np.array([0, len(data)])))
    at, counts = np.unique(bins, return_counts=True)
    x = counts * (_SCALE / max(len(data), 1))
    return np.append(at, 1 << BINS).astype(np.int64), np.append(x, 1.0)


def _families(langs: list[str], members: int) -> dict[str, tuple[str, ...]]:
    """Languages by family, both in order of name; a large family in parts."""
    whole: dict[str, list[str]] = {}
    for lang in sorted(langs):
        whole.setdefault(family_of(lang), []).append(lang)
    return {
        family if not at else f"{family} {at // members + 1}": tuple(found[at : at + members])
        for family, found in sorted(whole.items())
        for at in range(0, len(found), members)
    }


def first_places(rows: DataFrame, n: int) -> DataFrame:
    """Of ``rows`` (lang, place) the ``n`` smallest distinct places of each language,
    with ``rank`` (from 1). A task sends no more than ``n`` of each on."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            index, place = np.asarray(coded.indices), np.asarray(batch.column(1))
            for i, lang in enumerate(coded.dictionary.to_pylist()):
                both = np.concatenate([held.get(lang, place[:0]), place[index == i]])
                held[lang] = np.unique(both)[:n]
        for lang, places in held.items():
            yield pa.record_batch(
                [pa.repeat(pa.scalar(lang), len(places)), pa.array(places)], names=["lang", "place"]
            )

    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    return (
        rows.select("lang", "place")
        .mapInArrow(smallest, "lang string, place long")
        .distinct()
        .select("lang", "place", rank.alias("rank"))
        .filter(F.col("rank") <= n)
    )


def _sample(docs: DataFrame, s: LanguageSettings) -> DataFrame:
    """lang, place, rank and text of the distinct labelled texts that are learned from."""
    known = (
        docs.select("text", "lang")
        .filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
        .withColumn("place", F.xxhash64("text", F.lit(5)))
    )
    places = stored(first_places(known, s.per_language), "label-places")
    if fits_broadcast(places):
        places = F.broadcast(places)
    # Copies of a text are one row before the shuffle and after it.
    return stored(
        known.join(places, ["lang", "place"])
        .groupBy("lang", "place", "rank")
        .agg(F.min("text").alias("text")),
        "labelled",
    )


def train_language_id(
    docs: DataFrame, settings: LanguageSettings = LanguageSettings()
) -> LanguageModel:
    """Fit on distinct labelled texts, taken by a hash of the text: every language has
    as many as it has, up to ``settings.per_language``.

    ``docs``: text, lang. Rows with a NULL lang, or a text that is NULL or has no
    letter, are left out; copies count once. All languages are learned. Each machine
    is a group of its own: one against the rest for a family, one against one for two
    languages of a family. The driver gets their weights, 256 KB a machine.
    """
    s, spark = settings, docs.sparkSession
    sample = _sample(docs, s)
    families = _families([r.lang for r in sample.select("lang").distinct().collect()], s.members)
    if not families:
        return LanguageModel((), {}, np.zeros((0, (1 << BINS) + 1)), {})
    family = spark.createDataFrame(
        [(lang, name) for name, langs in families.items() for lang in langs],
        "lang string, family string",
    )
    # Machines that a language takes part in, and the other side of each.
    pairs = spark.createDataFrame(
        [
            (own, a, b, own == a)
            for langs in families.values()
            for a, b in combinations(langs, 2)
            for own in (a, b)
        ],
        "lang string, a string, b string, is_first boolean",
    )
    columns = ["a", "b", "is_first", "lang", "place", "text"]
    two = sample.join(F.broadcast(pairs), "lang").select(*columns)
    # The first texts of every language of a family in turn.
    turn = Window.partitionBy("family").orderBy("rank", "lang")
    named = (
        sample.join(F.broadcast(family), "lang")
        .withColumn("turn", F.row_number().over(turn))
        .filter(F.col("turn") <= s.per_family)
    )
    names = F.array(*[F.lit(f) for f in families]) if len(families) > 1 else F.array().cast("array<string>")
    one = (
        named.withColumn("a", F.explode(names))
        .withColumn("b", F.lit(""))
        .withColumn("is_first", F.col("a") == F.col("family"))
        .select(*columns)
    )

    def fit(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("lang", "ascending"), ("place", "ascending")])
        features = [_features(text.encode()) for text in rows.column("text").to_pylist()]
        signs = np.where(rows.column("is_first").to_numpy(), 1.0, -1.0)
        weights = _machine(features, signs, s, 0)
        return pa.table(
            {
                "a": rows.column("a").slice(0, 1),
                "b": rows.column("b").slice(0, 1),
                "w": pa.array([weights.tolist()], pa.list_(pa.float64())),
            }
        )

    machines = one.unionByName(two).groupBy("a", "b")
    found = machines.applyInArrow(fit, "a string, b string, w array<double>").collect()
    weights = {(r.a, r.b): np.array(r.w) for r in found}
    none = np.zeros((1 << BINS) + 1)
    return LanguageModel(
        tuple(families),
        families,
        np.array([weights.pop((f, ""), none) for f in families]),
        weights,
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def _margins(bins: list[np.ndarray], at: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Margin of each row: mean weight of its n-grams, and the bias."""
    total = np.zeros(len(bins[0]) + 1)
    np.cumsum(sum(w[b] for b in bins), out=total[1:])
    sizes = np.maximum(np.diff(at), 1)
    return (total[at[1:]] - total[at[:-1]]) * (_SCALE / sizes) + w[-1]


def _predict(
    data: np.ndarray, at: np.ndarray, model: LanguageModel
) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each row."""
    rows = len(at) - 1
    bins = gram_bins(data, at)
    langs = np.full(rows, UNKNOWN, object)
    margins = np.array([_margins(bins, at, w) for w in model.family_weights])
    family = margins.argmax(axis=0)
    score = np.ones(rows)
    if len(margins) > 1:
        ordered = np.sort(margins, axis=0)
        score = _sigmoid(2 * (ordered[-1] - ordered[-2]))
    sizes = np.diff(at)
    for f, name in enumerate(model.families):
        members = model.languages[name]
        chosen = np.flatnonzero(family == f)
        if not len(chosen):
            continue
        inside = np.repeat(family == f, sizes)
        own = [b[inside] for b in bins]
        cuts = np.concatenate([[0], np.cumsum(sizes[chosen])])
        votes = np.zeros((len(members), len(chosen)))
        for a, b in combinations(range(len(members)), 2):
            p = _sigmoid(2 * _margins(own, cuts, model.pair_weights[members[a], members[b]]))
            votes[a] += p
            votes[b] += 1 - p
        best = votes.argmax(axis=0)
        langs[chosen] = np.array(members, object)[best]
        if len(members) > 1:
            score[chosen] *= votes.max(axis=0) / (len(members) - 1)
    return langs, score


def identify_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of ``docs``, ``lang_pred`` and ``lang_score`` (0 to 1).

    Only the whole ``text`` is looked at. A text that is NULL or has no letter is
    ``und`` with score 0, as is every text if the model has learned no language.
    Columns of those two names are replaced.
    """
    docs = docs.drop("lang_pred", "lang_score")
    names = docs.columns
    at_text = names.index("text")
    held = docs.sparkSession.sparkContext.broadcast(model)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            data, at = text_bytes(batch.column(at_text))
            has_letter = np.asarray(batch.column(len(names))).astype(bool)
            for a, b in row_blocks(at, 1 << 20):
                langs = np.full(b - a, UNKNOWN, object)
                score = np.zeros(b - a)
                if known.families:
                    langs, score = _predict(data[at[a] : at[b]], at[a : b + 1] - at[a], known)
                    langs[~has_letter[a:b]], score[~has_letter[a:b]] = UNKNOWN, 0.0
                yield pa.record_batch(
                    [
                        *(c.slice(a, b - a) for c in batch.columns[:-1]),
                        pa.array(langs.tolist(), pa.string()),
                        pa.array(score),
                    ],
                    names=[*names, "lang_pred", "lang_score"],
                )

    schema = docs.select(
        "*", F.lit("").alias("lang_pred"), F.lit(0.0).cast("double").alias("lang_score")
    ).schema
    return docs.withColumn(free_prefix(docs, "has_letter"), lettered).mapInArrow(predict, schema)
