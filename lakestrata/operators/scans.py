"""Row counts over a whole table or the rows of one region, and counts of its keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS_A_TASK = 1 << 19


def count_rows(table: DataFrame, region: str | None = None) -> DataFrame:
    """One row ``n_rows``; a region filter reaches the scan, or prunes folders."""
    rows = table if region is None else table.filter(F.col("region") == region)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"))


def count_keys(table: DataFrame, *columns: str) -> DataFrame:
    """One row ``n_keys``: the different values of ``columns``, without those that hold
    a NULL.

    A distinct count holds the keys of a task in memory, before and after its shuffle,
    and adaptive execution merges partitions by their packed size. Here rows are dealt
    by key to a fixed number of tasks, one per ``KEYS_A_TASK`` rows. The rows of a key
    that comes often meet in one task, which holds it once.
    """
    keys = table.select(*columns)
    for column in columns:
        keys = keys.filter(F.col(column).isNotNull())
    tasks = 1 + table.count() // KEYS_A_TASK
    return keys.repartition(tasks, *columns).distinct().agg(F.count(F.lit(1)).alias("n_keys"))
