"""Plain Parquet / ORC tables."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files, folders or glob patterns as one table."""
    return spark.read.parquet(*paths)


def raw_tables(
    spark: SparkSession, folder: str, dimensions: Sequence[str] = ("users", "products")
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Raw events from all ``events_*.parquet`` files of a folder, and its
    dimension tables, one file each."""
    events = scan(spark, f"{folder}/events_*.parquet")
    return events, {name: scan(spark, f"{folder}/{name}.parquet") for name in dimensions}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table stored in the given format."""
    return spark.read.format(fmt).load(path)


def spread_for_write(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather rows by partition value before a partitioned write.

    The rebalance hint cuts large partition values into many tasks and so into
    evenly sized files; a plain repartition would send each value to one task.
    It needs adaptive execution; without it each task writes what it holds, with
    a warning.
    """
    if not partition_by:
        return df
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true")
    if adaptive.lower() != "true":
        warnings.warn(
            "adaptive execution is off: each task writes a file per partition value",
            stacklevel=3,
        )
        return df
    return df.hint("rebalance", *partition_by)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write a table, as folders by value if ``partition_by`` is given."""
    writer = spread_for_write(df, partition_by).write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


SAMPLED_KEYS = 256


def _bounds(low: int, high: int) -> list[int]:
    """Places between two keys: evenly spread, and closer and closer to each end."""
    width = high - low
    even = {low + width * i // 32 for i in range(1, 33)}
    near = {width >> shift for shift in range(4, 64, 4)}
    places = even | {low + d for d in near} | {high - d for d in near}
    return sorted(p for p in places if low < p <= high)


def _narrowed(df: DataFrame, n: int, key: str, low: int, high: int) -> int:
    """The bound between ``low`` (too few rows) and ``high`` (enough), by passes that
    count keys up to some bounds and go on within the interval that was found. It
    is 32 times narrower at least, and much narrower where keys crowd at one end."""
    value, found = F.col(key), None
    while found is None or (found > 4 * n and high - low > 1):
        bounds = _bounds(low, high)
        counts = df.agg(*(F.count_if(value <= F.lit(b)) for b in bounds)).first()
        at = next((i for i, count in enumerate(counts) if count >= n), len(bounds) - 1)
        high, found = bounds[at], counts[at]
        low = bounds[at - 1] if at else low
    return high


def key_bound(df: DataFrame, n: int, key: str) -> int | None:
    """A key that at least n and at most 4n rows do not exceed; more only where
    one key alone has so many rows, fewer than n where the table has no more.

    Two passes over the key column. The first takes rows at such a rate that the
    ``SAMPLED_KEYS`` smallest of them reach to about the 2n-th row of the table: tasks
    send on their smallest sampled keys, never more, and those of several tasks merge
    into those of all. The second counts exactly how many rows some of these keys do
    not exceed. Only if none of them will do, which takes luck of eight deviations or
    crowded keys, further passes narrow the interval down.
    """
    value = F.col(key)
    share = min(1.0, SAMPLED_KEYS / (2 * n))
    wanted = SAMPLED_KEYS if share < 1 else 2 * n
    keys = df.select(value.alias("key")).filter(value.isNotNull())
    sample = keys if share == 1 else keys.filter(F.rand(17) < share)
    smallest = [r.key for r in sample.orderBy("key").limit(wanted).collect()]
    places = {len(smallest) * i // 8 for i in range(1, 9)}
    bounds = sorted({smallest[p - 1] for p in places if p})
    counts = df.agg(
        F.max(value),
        F.min(value),
        *(F.count_if(value <= F.lit(b)) for b in bounds),
        *(F.count_if(value < F.lit(b)) for b in bounds),
    ).first()
    high, low = counts[0], counts[1]
    if high is None:
        return None
    up_to, below = counts[2 : 2 + len(bounds)], counts[2 + len(bounds) :]
    at = next((i for i, count in enumerate(up_to) if count >= n), None)
    if at is None:
        # The sample ended before the n-th row; a short one has seen the whole table.
        start = bounds[-1] if bounds else low - 1
        return high if len(smallest) < wanted else _narrowed(df, n, key, start, high)
    if up_to[at] <= 4 * n or below[at] < n:
        return bounds[at]
    return _narrowed(df, n, key, bounds[at - 1] if at else low - 1, bounds[at])


def first_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The n rows with the smallest keys: a sample that is the same every time.

    ``key`` is a whole number; rows without one are left out. An ordered limit
    alone would read every column of the table and send up to n rows of each
    task to a single one. Two passes over the key alone first find a bound that few
    more than n rows do not exceed, and which reaches the scan.
    """
    bound = key_bound(df, n, key)
    value = F.col(key)
    kept = df.filter(value <= F.lit(bound)) if bound is not None else df.filter(value.isNotNull())
    return kept.orderBy(key).limit(n)
