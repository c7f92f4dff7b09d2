"""Summaries of price paths given as log returns in steps.

The price after a step is ``base * exp(sum of the returns so far)``. One key may
hold most of the rows, so its running sum must not need one task. All rows are
range-partitioned by key and step: Spark samples the splitters, so a range has about
the same number of rows whatever the steps are (1, 2, 3 or time stamps) and a crowded
key spans several ranges. The rows of a key in a range are a run. Each run is summed
from zero on its own; the totals of the earlier runs are then added to the few
figures that describe a run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_RUN = 1_000_000


def path_runs(moves: DataFrame, rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """Figures of the runs of ``moves`` (key, step, move): key, run (ascending with the
    steps of a key), n, last (sum of the moves), high and low (largest and smallest
    running sum), and mean and variance of the prices relative to the highest.

    There are as many ranges as there are shuffle partitions, and more if a range
    would hold over ``rows_per_run`` rows; so there are at most as many runs as keys
    and ranges together.
    """
    width = int(moves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(width, -(-moves.count() // rows_per_run))
    placed = moves.repartitionByRange(ranges, "key", "step").withColumn(
        "run", F.spark_partition_id()
    )
    in_run = Window.partitionBy("key", "run")
    so_far = in_run.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Prices within a run are taken relative to its peak, so that exp() stays
    # in range however far the path has moved before the run.
    return (
        placed.withColumn("level", F.sum("move").over(so_far))
        .withColumn("peak", F.max("level").over(in_run))
        .withColumn("share", F.exp(F.col("level") - F.col("peak")))
        .groupBy("key", "run")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max_by("level", "step").alias("last"),
            F.max("level").alias("high"),
            F.min("level").alias("low"),
            F.avg("share").alias("mean_share"),
            F.var_pop("share").alias("var_share"),
        )
    )


def path_summary(
    returns: DataFrame,
    bases: DataFrame,
    key: str = "product_id",
    step: str = "step",
    log_return: str = "log_return",
    base_price: str = "base_price",
    rows_per_run: int = ROWS_PER_RUN,
) -> DataFrame:
    """Final, highest and lowest price and population deviation per key.

    ``step`` gives the order within a key and occurs once per key; any type that
    Spark can order will do. A key without a base price has no result row.
    """
    moves = returns.select(
        F.col(key).alias("key"), F.col(step).alias("step"), F.col(log_return).alias("move")
    )
    runs = path_runs(moves, rows_per_run)

    by_key = Window.partitionBy("key")
    before = by_key.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.withColumn("start", F.coalesce(F.sum("last").over(before), F.lit(0.0)))
    scale = F.exp(F.col("start") + F.col("high"))
    placed = (
        placed.withColumn("mean", F.col("mean_share") * scale)
        .withColumn("var", F.col("var_share") * scale * scale)
        .withColumn("weight", F.col("n") / F.sum("n").over(by_key))
        .withColumn("overall", F.sum(F.col("weight") * F.col("mean")).over(by_key))
    )
    spread = F.col("var") + F.pow(F.col("mean") - F.col("overall"), 2)
    relative = placed.groupBy("key").agg(
        F.exp(F.max_by(F.col("start") + F.col("last"), "run")).alias("final"),
        F.exp(F.max(F.col("start") + F.col("high"))).alias("max"),
        F.exp(F.min(F.col("start") + F.col("low"))).alias("min"),
        F.sqrt(F.sum(F.col("weight") * spread)).alias("std"),
    )
    base = F.col("base_price")
    return (
        relative.join(
            bases.select(F.col(key).alias("key"), F.col(base_price).alias("base_price")), "key"
        )
        .select(
            F.col("key").alias(key),
            base,
            (base * F.col("final")).alias("final_price"),
            (base * F.col("max")).alias("max_price"),
            (base * F.col("min")).alias("min_price"),
            (base * F.col("std")).alias("volatility"),
        )
    )


def mean_final_price(summary: DataFrame) -> DataFrame:
    """Mean of the final prices over all keys."""
    return summary.agg(F.avg("final_price").alias("avg_final"))
