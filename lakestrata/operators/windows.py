"""Window measures over daily revenue.

The windows run over one row per region and day, so a window partition holds as
many rows as there are days, or regions, however many events there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import add_totals, exact_sum, exact_total, is_total, largest_first, revenue


def daily_revenue(events: DataFrame) -> DataFrame:
    """Revenue per region and calendar day, as a total that loses no digit.

    The windows below keep such totals, and ``as_doubles`` turns all into doubles
    at the end; given plain numbers, they return doubles.
    """
    return events.groupBy("region", F.to_date("event_timestamp").alias("date")).agg(
        exact_total(revenue()).alias("daily_revenue")
    )


def rolling_revenue(
    daily: DataFrame,
    days: int = 7,
    frame: str = "rows",
) -> DataFrame:
    """Add the revenue of the current and the preceding days of the region.

    ``frame="rows"`` takes the ``days - 1`` rows before, whatever their dates;
    ``frame="days"`` takes the calendar days, which differs if a day is missing.
    """
    by_region = Window.partitionBy("region")
    if frame == "rows":
        window = by_region.orderBy("date").rowsBetween(1 - days, Window.currentRow)
    elif frame == "days":
        window = by_region.orderBy(F.unix_date("date")).rangeBetween(1 - days, Window.currentRow)
    else:
        raise ValueError(f"frame must be 'rows' or 'days', not {frame!r}")
    if is_total(daily, "daily_revenue"):
        rolled = add_totals("daily_revenue", window)
    else:
        rolled = exact_sum(F.col("daily_revenue"), window)
    return daily.withColumn(f"rolling_{days}d_revenue", rolled)


def rank_in_day(daily: DataFrame) -> DataFrame:
    """Add the rank of each region within its day, highest revenue first.

    Equal revenues share a rank and the next rank is skipped.
    """
    order = [F.desc("daily_revenue")]
    if is_total(daily, "daily_revenue"):
        order = largest_first("daily_revenue")
    window = Window.partitionBy("date").orderBy(*order)
    return daily.withColumn("rank_in_day", F.rank().over(window))
