"""Mixing sources to target weights by a low-discrepancy schedule.

The documents of a source, in shuffled order and repeated without end, are its
stream of words. Slot i of the mix takes the source whose share of the unit line
holds the fractional part of i times the golden ratio; the r-th slot of a source
takes the r-th block of its stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, WORD, free_prefix, stored

WEIGHTS = (1.0, 2.0, 3.0)
_GOLDEN, _CIRCLE = 1_327_217_885, 1 << 31  # golden ratio of 2^31, made odd
_BINS = 4096
_PARTS = 4096
_CHUNK = 1 << 16


@dataclass(frozen=True)
class Mix:
    """``targets``: one row per source. ``rows``: one per document row, with its
    place in its source's stream. ``pieces``: what each slot takes of a row."""

    targets: DataFrame
    rows: DataFrame
    pieces: DataFrame


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = 3, share: float = 1.0
) -> DataFrame:
    """``source``, ``source_size`` -> the same, ``number`` and ``target``.

    Sources in code point order, NULL last, weigh ``weights`` in turn and share
    ``share`` of all words. No target exceeds ``repeats`` times its source; the
    excess is shared by weight among the others until none is above. The windows
    run over one row per source.
    """
    numbered = sizes.withColumn(
        "number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    cap = F.col("source_size") * F.lit(float(repeats))
    every = Window.orderBy("level", "number")
    earlier = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Sources reach their cap in the order of cap / weight. ``fill`` is the words
    # per unit of weight if all sources before are at their cap; the first one
    # that this does not fill up settles it.
    leveled = numbered.withColumns(
        {
            "weight": F.element_at(cycle, (F.col("number") % len(weights) + 1).cast("int")),
            "cap": cap,
        }
    ).withColumn("level", F.col("cap") / F.col("weight"))
    rest = F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(
        F.sum("cap").over(earlier), F.lit(0.0)
    )
    weight_left = F.sum("weight").over(whole) - F.coalesce(
        F.sum("weight").over(earlier), F.lit(0.0)
    )
    filled = leveled.withColumn("fill", rest / weight_left)
    settled = F.coalesce(
        F.first(F.when(F.col("level") >= F.col("fill"), F.col("fill")), True).over(whole),
        F.max("level").over(whole),
    )
    return filled.withColumn("settled", settled).select(
        "source",
        "source_size",
        "number",
        F.least("cap", F.col("settled") * F.col("weight")).alias("target"),
    )


def _running(rows: DataFrame, by: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the same ``by``."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))


def _placed(classes: DataFrame) -> DataFrame:
    """``start``: the words of the source before each class of equal rows, in
    shuffled order. A source is cut into parts of the shuffled order, which are
    summed first, so that no task holds a whole source."""
    parted = classes.withColumn("words", F.col("size") * F.col("copies")).withColumn(
        "place", F.xxhash64("number", "doc_id", "row_hash", F.lit(7))
    )
    parted = parted.withColumn("part", F.pmod(F.shiftrightunsigned("place", 40), F.lit(_PARTS)))
    parts = parted.groupBy("number", "part").agg(F.sum("words").alias("part_words"))
    parts = _running(parts, ["number"], "part", "part_words", "part_start").drop("part_words")
    local = Window.partitionBy("number", "part").orderBy("place", "doc_id", "row_hash")
    local = local.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("words").over(local), F.lit(0))
    return (
        parted.withColumn("inside", inside)
        .join(parts, ["number", "part"])
        .withColumn("start", F.col("part_start") + F.col("inside"))
        .drop("place", "part", "part_start", "inside", "words")
    )


def _slots(targets: DataFrame, block: int) -> DataFrame:
    """slot, number, rank: the source of each slot and its rank within the source.

    Where the schedule gives a source a slot less than its target needs, the
    missing ones follow at the end.
    """
    spark = targets.sparkSession
    every = Window.orderBy("number")
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    upto = every.rowsBetween(Window.unboundedPreceding, 0)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("target").over(whole)
    lined = targets.filter("target > 0").select(
        "number",
        F.ceil(F.round("target") / block).alias("needed"),
        (F.coalesce(F.sum("target").over(before), F.lit(0.0)) / total).alias("low"),
        # The last share ends at 1, whatever rounding has left.
        F.when(F.lead("number").over(every).isNull(), 1.0)
        .otherwise(F.sum("target").over(upto) / total)
        .alias("high"),
    )
    needed = lined.agg(F.coalesce(F.sum("needed"), F.lit(0))).first()[0]
    slots = spark.range(needed).select(
        F.col("id").alias("slot"),
        (((F.col("id") % _CIRCLE) * _GOLDEN) % _CIRCLE / F.lit(float(_CIRCLE))).alias("point"),
    )
    bins = lined.withColumn(
        "bin",
        F.explode(
            F.sequence(
                F.floor(F.col("low") * _BINS),
                F.least(F.floor(F.col("high") * _BINS), F.lit(_BINS - 1).cast("long")),
            )
        ),
    )
    drawn = (
        slots.withColumn("bin", F.floor(F.col("point") * _BINS))
        .join(bins, "bin")
        .filter((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
        .select("slot", "number", F.floor(F.col("slot") / _CHUNK).alias("chunk"))
    )
    chunks = drawn.groupBy("number", "chunk").agg(F.count(F.lit(1)).alias("n"))
    chunks = _running(chunks, ["number"], "chunk", "n", "chunk_start")
    inside = F.row_number().over(Window.partitionBy("number", "chunk").orderBy("slot")) - 1
    ranked = (
        drawn.withColumn("inside", inside)
        .join(chunks, ["number", "chunk"])
        .select("slot", "number", (F.col("chunk_start") + F.col("inside")).alias("rank"))
    )
    given = chunks.groupBy("number").agg(F.sum("n").alias("given"))
    missing = (
        lined.join(given, "number", "left")
        .withColumn("given", F.coalesce("given", F.lit(0)))
        .filter("needed > given")
        .withColumn("rank", F.explode(F.sequence(F.col("given"), F.col("needed") - 1)))
        .select((F.lit(needed) + F.col("rank")).alias("slot"), "number", "rank")
    )
    return ranked.unionByName(missing)


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    repeats: int = 3,
    share: float = 1.0,
    block: int = 256,
) -> Mix:
    """Schedule ``docs`` (doc_id, source, text; other columns only tell rows apart).

    A word is a run of other than ASCII white space; NULL and empty texts have
    none and are never taken. A NULL source is a source of its own, a NULL
    doc_id an id like any other. Equal rows are one class of so many copies and
    follow each other in the stream. What a source gives is its target, rounded;
    no row is taken more than ``repeats`` times. Reruns give the same mix.
    """
    keyed = docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        F.xxhash64(*docs.columns).alias("row_hash"),
    )
    classes = stored(
        keyed.groupBy("source", "doc_id", "row_hash", "size").agg(
            F.count(F.lit(1)).alias("copies")
        ),
        "mix-classes",
    )
    sizes = classes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size")
    )
    targets = stored(source_targets(sizes, weights, repeats, share), "mix-targets")
    known = targets.select(F.col("source").alias("known"), "number", "source_size", "target")
    numbered = classes.join(known, F.col("source").eqNullSafe(F.col("known"))).drop("known")
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    rows = stored(
        _placed(numbered)
        .withColumn("copy", copy)
        .withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
        .drop("copies"),
        "mix-rows",
    )
    # One row per round in which the stream comes by the row before the target ends.
    end = F.round("target").cast("long")
    rounds = (
        rows.filter("size > 0")
        .withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .withColumn("first", F.col("start") + F.col("round") * F.col("source_size"))
        .withColumn("last", F.least(F.col("first") + F.col("size"), end))
        .filter("first < last")
        .withColumn(
            "rank",
            F.explode(
                F.sequence(F.floor(F.col("first") / block), F.floor((F.col("last") - 1) / block))
            ),
        )
    )
    begins = F.greatest("first", F.col("rank") * block) - F.col("first")
    ends = F.least("last", (F.col("rank") + 1) * block) - F.col("first")
    pieces = (
        rounds.withColumns({"begin": begins, "stop": ends})
        .select("number", "rank", "doc_id", "row_hash", "copy", "start", "round", "begin", "stop")
        .join(_slots(targets, block), ["number", "rank"])
    )
    return Mix(targets, rows, pieces)


def taken_words(mix: Mix) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken."""
    taken = (
        mix.pieces.withColumn("words", F.col("stop") - F.col("begin"))
        .groupBy("number", "start")
        .agg(F.sum("words").alias("taken"))
    )
    # Rows without words share their start with the next row, but take nothing.
    full = mix.rows.filter("size > 0").join(taken, ["number", "start"], "left")
    empty = mix.rows.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return full.unionByName(empty).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def mixed_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mix as rows with the columns of ``docs``, one per row and round.

    A row that is taken in part keeps its text from the first word that is taken to
    the end of the last, white space between them as it is; ``n_chars``, if there, is
    then its length.
    """
    names, mark = docs.columns, free_prefix(docs, "mix_")
    row, size, begin, stop = (f"{mark}{c}" for c in ("row", "size", "begin", "stop"))
    parts = mix.pieces.groupBy("doc_id", "row_hash", "copy", "start", "round").agg(
        F.min("begin").alias(begin), F.max("stop").alias(stop)
    )
    parts = parts.select(
        F.col("doc_id").alias(f"{mark}id"), F.col("row_hash").alias(f"{mark}hash"), begin, stop
    )
    texts = docs.withColumns(
        {row: F.xxhash64(*names), size: word_count(F.col("text"))}
    ).dropDuplicates([row, "doc_id"])
    same = (F.col(row) == F.col(f"{mark}hash")) & F.col("doc_id").eqNullSafe(F.col(f"{mark}id"))
    whole = (F.col(begin) == 0) & (F.col(stop) == F.col(size))
    # A word with the white space behind it is one part of the text.
    white = F.lit(" \t\n\x0b\x0c\r")
    words = F.split(F.ltrim("text", white), f"(?<=[{SPACES}])(?=[^{SPACES}])")
    some = F.rtrim(
        F.array_join(
            F.slice(
                words,
                (F.col(begin) + 1).cast("int"),
                (F.col(stop) - F.col(begin)).cast("int"),
            ),
            "",
        ),
        white,
    )
    mixed = texts.join(parts, same).withColumn("text", F.when(whole, F.col("text")).otherwise(some))
    if "n_chars" in names:
        mixed = mixed.withColumn(
            "n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text"))
        )
    return mixed.select(*names)
