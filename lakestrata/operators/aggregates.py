"""Grouped aggregates. Each one combines on the map side before it shuffles, so a
key that holds a large share of the rows reaches its reducer as a few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    as_doubles,
    exact_avg,
    exact_stddev_samp,
    exact_sum,
    exact_total,
    largest_first,
    nan_to_null,
    revenue,
)


def revenue_by_region_type(
    events: DataFrame, key: str = "event_id"
) -> DataFrame:
    """Revenue and number of events with a key, by region and event type."""
    return (
        events.groupBy("region", "event_type")
        .agg(
            exact_sum(revenue()).alias("total_revenue"),
            F.count(key).alias("event_count"),
        )
        .orderBy("region", "event_type")
    )


def region_type_stats(events: DataFrame) -> DataFrame:
    """Row count, revenue, average and highest price by region and event type."""
    return events.groupBy("region", "event_type").agg(
        F.count(F.lit(1)).alias("n"),
        exact_sum(revenue()).alias("total_revenue"),
        exact_avg(F.col("price")).alias("avg_price"),
        F.max("price").alias("max_price"),
    )


def daily_event_counts(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Events with a key per calendar day and region."""
    return (
        events.groupBy(F.to_date("event_timestamp").alias("date"), "region")
        .agg(F.count(key).alias("event_count"))
        .orderBy("date", "region")
    )


def top_products(
    events: DataFrame,
    products: DataFrame,
    event_type: str = "purchase",
    k: int = 10,
) -> DataFrame:
    """The k products with the highest revenue, with their product columns."""
    totals = (
        events.filter(F.col("event_type") == event_type)
        .groupBy("product_id")
        .agg(exact_total(revenue()).alias("total_revenue"))
    )
    return best_products(totals, products, k)


def best_products(totals: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """The k rows of ``totals`` (product_id, total_revenue) with the highest totals,
    with their product columns.

    Equal revenues are ordered by product. The list is cut to k before the
    product table is looked up: every row of the final list belongs to one of
    the k best products, and then only k keys meet the product table.
    """
    best = totals.orderBy(*largest_first("total_revenue"), "product_id").limit(k)
    # k rows at most, so the broadcast does not grow with the data.
    wanted = F.broadcast(best.select("product_id"))
    described = products.join(wanted, "product_id", "left_semi")
    found = (
        best.join(described, "product_id", "left")
        .orderBy(*largest_first("total_revenue"), "product_id")
        .limit(k)
    )
    return as_doubles(found)


def user_region_totals(events: DataFrame) -> DataFrame:
    """Revenue by user and region, in no order."""
    return events.groupBy("user_id", "region").agg(
        exact_total(revenue()).alias("user_revenue")
    )


def sorted_revenue(totals: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Totals by user and region, highest first.

    ``num_partitions`` fixes the width of the final sort for this query alone;
    the rows do not depend on it. It acts on the aggregated rows, never on the
    raw ones, so a busy user is not gathered in one task.
    """
    order = [*largest_first("user_revenue"), F.asc("user_id"), F.asc("region")]
    if num_partitions is None:
        return as_doubles(totals.orderBy(*order))
    spread = totals.repartitionByRange(num_partitions, *order).sortWithinPartitions(*order)
    return as_doubles(spread)


def user_region_revenue(
    events: DataFrame, num_partitions: int | None = None
) -> DataFrame:
    """Revenue by user and region, highest first; see ``sorted_revenue``."""
    return sorted_revenue(user_region_totals(events), num_partitions)


def grand_totals(events: DataFrame) -> DataFrame:
    """Total revenue and number of revenues over rows with both group keys.

    NaN counts as missing here, in the sum and in the number.
    """
    usable = nan_to_null(
        events.dropna(subset=["region", "event_type"]).select(revenue().alias("revenue")),
        "revenue",
    )
    return usable.agg(
        F.coalesce(exact_sum(F.col("revenue")), F.lit(0.0)).alias("total_revenue"),
        F.count("revenue").alias("n"),
    )


def region_features(
    events: DataFrame, regions: DataFrame
) -> DataFrame:
    """One row of features per listed region, in a single pass over the events.

    A region without events gets zeros for count, mean price and revenue and
    NULL for the deviation and mean quantity. The deviation is the sample one,
    NULL for a single row. NaN prices count as rows but not as values.
    """
    stats = (
        nan_to_null(events, "price", "quantity")
        .groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            exact_avg(F.col("price")).alias("mean_price"),
            exact_stddev_samp(F.col("price")).alias("price_std"),
            exact_sum(revenue()).alias("total_revenue"),
            exact_avg(F.col("quantity")).alias("avg_quantity"),
        )
    )
    # An empty region is given zeros; a region that has rows keeps its values.
    empty = F.col("event_count").isNull()
    return (
        regions.select("region")
        .join(stats, "region", "left")
        .select(
            "region",
            F.coalesce("event_count", F.lit(0)).alias("event_count"),
            F.when(empty, 0.0).otherwise(F.col("mean_price")).alias("mean_price"),
            "price_std",
            F.when(empty, 0.0)
            .otherwise(F.coalesce("total_revenue", F.lit(0.0)))
            .alias("total_revenue"),
            "avg_quantity",
        )
    )
