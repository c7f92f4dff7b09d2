"""How far the word use of sources differs, within each language.

The groups are the (lang, source) pairs; every two groups of a language are compared
over all terms the language keeps. The work is a cube: group blocks × group blocks ×
term blocks. A task owns cells (i, j, k): it gets the rows of group blocks i and j in
term block k, makes them dense, and adds up the divergence of all its pairs of groups
over its terms. Slices are replicated to the cells that need them; the partial
divergences of a pair are then added along the term axis.

Divergences are symmetric, so cells have i <= j and give both directions. A term that
no group of a cell uses adds the same to a pair each time; it is counted, not sent.
All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, stored, tidied

MIN_DOCS = 10
GROUPS_A_BLOCK = 32
TERMS_A_BLOCK = 4096
ONE = 1_000_000_000
COUNTED_AT_ONCE = 1 << 18
_COUNTS = "lang string, source string, term string, n long, docs long"


def _term_bytes() -> bytes:
    """Bytes of terms, A-Z as a-z; all others are spaces. Every byte of a character
    above 0x7F is at least 0x80."""
    kept = np.zeros(256, bool)
    kept[65:91] = kept[97:123] = kept[128:] = True
    return np.where(kept, LOWER, 32).astype(np.uint8).tobytes()


_TERMS = _term_bytes()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that hold it).

    Terms are runs of letters A-Z, lower-cased, and of characters above 0x7F. NULL
    lang, source and text count as ''. Tasks count before they shuffle, so a frequent
    term of a large group is a few rows; all rows of a term of a language meet in one
    place, where later sums per term need no other shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[dict, dict]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in groups.items():
                size = len(n)
                yield pa.record_batch(
                    [
                        pa.repeat(pa.scalar(lang, pa.string()), size),
                        pa.repeat(pa.scalar(source, pa.string()), size),
                        pa.array(list(n), pa.binary()).cast(pa.string()),
                        pa.array(n.values(), pa.int64()),
                        pa.array(docs.values(), pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )

        for batch in batches:
            for i in range(batch.num_rows):
                key = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                n, docs = groups.setdefault(key, ({}, {}))
                held -= len(n)
                own: dict[bytes, int] = {}
                text = batch.column(2)[i].as_buffer().to_pybytes()
                for term in text.translate(_TERMS).split():
                    own[term] = own.get(term, 0) + 1
                for term, times in own.items():
                    n[term] = n.get(term, 0) + times
                    docs[term] = docs.get(term, 0) + 1
                held += len(n)
                if held > COUNTED_AT_ONCE:
                    yield from flush()
                    groups, held = {}, 0
        yield from flush()

    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    counted = docs.select(text("lang"), text("source"), text("text")).mapInArrow(
        tidied(count), _COUNTS
    )
    return (
        counted.repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def share(count: str, total: str, terms: str) -> Column:
    """Smoothed share of a term in billionths, from 1: exact on decimals, as a long."""
    return F.expr(
        f"1L + coalesce((cast({ONE} as decimal(10,0)) * cast({count} + 2 as decimal(20,0))) "
        f"div cast(nullif({total} + 2 * {terms}, 0) as decimal(20,0)), 0L)"
    )


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whole part of (p - q)² / (p + q). Shares are at most 2·10^9, squares fit 63 bits."""
    gap = p - q
    return gap * gap // (p + q)


def _cell(table: pa.Table) -> pa.Table:
    """Partial divergences of one cell: rows are groups (term NULL) and their terms."""
    block = np.asarray(table.column("block"))
    group, share_ = np.asarray(table.column("group")), np.asarray(table.column("p"))
    is_group = np.asarray(table.column("term").is_null())
    names = table.column("source").filter(pa.array(is_group)).to_pylist()
    order = np.argsort(group[is_group], kind="stable")
    ids, zero, side = (x[is_group][order] for x in (group, share_, block))
    n_terms = int(table.column("terms").filter(pa.array(is_group))[0].as_py()) if len(ids) else 0
    coded = pa.chunked_array(table.column("term")).combine_chunks().filter(pa.array(~is_group))
    coded = coded.dictionary_encode()
    terms = len(coded.dictionary)
    dense = np.repeat(zero[:, None], terms, axis=1)
    dense[np.searchsorted(ids, group[~is_group]), np.asarray(coded.indices)] = share_[~is_group]
    lang = table.column("lang")[0]
    i, j = int(table.column("i")[0].as_py()), int(table.column("j")[0].as_py())
    left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
    source, item, value = [], [], []
    for a in left.tolist():
        others = right[right > a] if i == j else right
        sums = distance(dense[a], dense[others]).sum(axis=1)
        sums += distance(zero[a], zero[others]) * (n_terms - terms)
        own = names[order[a]]
        for b, total in zip(others.tolist(), sums.tolist()):
            other = names[order[b]]
            source += [own, other]
            item += [other, own]
            value += [total, total]
    return pa.table(
        {
            "lang": pa.repeat(lang, len(value)),
            "source": pa.array(source, pa.string()),
            "item": pa.array(item, pa.string()),
            "partial": pa.array(value, pa.int64()),
        }
    )


def pair_divergences(
    groups: DataFrame,
    shares: DataFrame,
    term_blocks: DataFrame,
    groups_a_block: int = GROUPS_A_BLOCK,
) -> DataFrame:
    """lang, source, item (another source of the language), value: the distances of
    both groups' shares summed over all kept terms.

    ``groups``: lang, source, group (0, 1, … in the language), zero (share of a term
    that the group lacks). ``shares``: lang, source, group, term, k (its term
    block), p. ``term_blocks``: lang, k, terms (kept terms in the block); every
    language has at least one.
    """
    block = F.expr(f"group div {groups_a_block}")
    rows = groups.join(term_blocks, "lang").select(
        "lang", "k", "source", "group", F.lit(None).cast("string").alias("term"),
        F.col("zero").alias("p"), "terms",
    )
    rows = rows.unionByName(
        shares.select(
            "lang", "k", F.lit(None).cast("string").alias("source"), "group", "term", "p",
            F.lit(None).cast("long").alias("terms"),
        )
    )
    blocks = groups.groupBy("lang").agg((F.max(block)).alias("last"))
    other = F.explode(F.sequence(F.lit(0), F.col("last").cast("int")))
    cells = (
        rows.join(blocks, "lang")
        .withColumn("block", block.cast("int"))
        .withColumn("other", other)
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("other", "last")
    )
    partial = cells.groupBy("lang", "i", "j", "k").applyInArrow(
        _cell, "lang string, source string, item string, partial long"
    )
    return partial.groupBy("lang", "source", "item").agg(F.sum("partial").alias("value"))


def source_divergence(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top: int = 10,
    groups_a_block: int = GROUPS_A_BLOCK,
    terms_a_block: int = TERMS_A_BLOCK,
) -> DataFrame:
    """lang, source, part, item, value, rank, for all (lang, source) groups of ``docs``.

    Part ``pair``: every other source of the language by its divergence from the
    group, largest first. Part ``term``: the ``top`` terms that the group uses more
    than its language does, by their distance. Ties follow the item's bytes.

    A language keeps the terms that at least ``min_docs`` of its documents hold. A
    group without terms is compared all the same; in a language without kept terms
    all divergences are 0. NULL lang, source and text count as ''. Rows that are alike
    count each time. An empty table gives an empty result. A cell holds at most 2 ×
    ``groups_a_block`` groups and about ``terms_a_block`` terms, whatever the input;
    two numberings go through one task per language: its groups, and its term blocks.
    """
    per_term = Window.partitionBy("lang", "term")
    found = stored(
        term_counts(docs)
        .withColumn("lang_n", F.sum("n").over(per_term))
        .withColumn("held_by", F.sum("docs").over(per_term))
        .filter(F.col("held_by") >= min_docs)
        .select("lang", "source", "term", "n", "lang_n"),
        "group-terms",
    )
    kept = found.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    listed = docs.select(text("lang"), text("source")).distinct()
    vocabulary = kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total")
    )
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    in_lang = Window.partitionBy("lang").orderBy("source")
    groups = stored(
        listed.join(totals, ["lang", "source"], "left")
        .join(vocabulary, "lang", "left")
        .na.fill(0, ["total", "v", "lang_total"])
        .withColumn("none", zero)
        .withColumn("group", F.row_number().over(in_lang).cast("long") - 1)
        .withColumn("zero", share("none", "total", "v"))
        .withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("v") / terms_a_block)))
        .drop("none"),
        "groups",
    )
    k = F.pmod(F.xxhash64("term"), F.col("n_blocks"))
    shares = found.join(groups, ["lang", "source"]).select(
        "lang", "source", "group", "term", k.alias("k"),
        share("n", "total", "v").alias("p"), share("lang_n", "lang_total", "v").alias("q"),
    )
    per_lang = groups.select("lang", "n_blocks").distinct()
    sizes = (
        kept.join(per_lang, "lang")
        .groupBy("lang", k.alias("k"))
        .agg(F.count(F.lit(1)).alias("terms"))
    )
    every = per_lang.select("lang", F.explode(F.sequence(zero, F.col("n_blocks") - 1)).alias("k"))
    term_blocks = every.join(sizes, ["lang", "k"], "left").na.fill(0, ["terms"])
    pairs = pair_divergences(
        groups.select("lang", "source", "group", "zero"),
        shares.select("lang", "source", "group", "term", "k", "p"),
        term_blocks,
        groups_a_block,
    ).withColumn("part", F.lit("pair"))
    gap = F.col("p") - F.col("q")
    terms = shares.filter(F.col("p") > F.col("q")).select(
        "lang", "source", F.col("term").alias("item"),
        (gap * gap).alias("square"), (F.col("p") + F.col("q")).alias("sum"),
    ).withColumn("value", F.expr("square div sum")).withColumn("part", F.lit("term"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(order).alias("rank")
    columns = ["lang", "source", "part", "item", "value"]
    return (
        pairs.select(*columns, rank)
        .unionByName(terms.select(*columns, rank).filter(F.col("rank") <= top))
    )
