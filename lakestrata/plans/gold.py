"""Curated tables that are kept up to date by deltas.

Two tables of totals stand between the cleaned events and the curated results:
``days`` by region, event type and calendar day, ``products`` by product for
purchases. A curated result is made of them alone. When late rows come, only what
they change is computed: the rows that they replace count minus, their own rows plus,
and the sums are added to the stored totals of the groups concerned. Totals are exact
decimals, so taking a value away leaves what a full run would give, to the last digit.
Values that cannot be added exactly (more than four decimals, NaN, infinities) cannot
be taken away either; groups that hold one are summed anew from their own events.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import add_totals, as_doubles, exact_total, revenue, total_as_double
from ..operators import best_products, rolling_revenue
from ..sources import VersionedTable

_KEYS = {
    "days": ("region", "event_type", "date"),
    "products": ("product_id",),
}
_SIGN = "_sign"


def _group_id(keys: tuple[str, ...]) -> Column:
    """A text that tells groups apart, also where a key is NULL."""
    return F.to_json(F.struct(*keys))


def _grouped(events: DataFrame, name: str, purchase: str) -> DataFrame:
    """Rows of ``events`` that a table of totals counts, with its keys."""
    if name == "products":
        return events.filter(F.col("event_type") == purchase)
    return events.withColumn("date", F.to_date("event_timestamp"))


def event_totals(events: DataFrame, name: str, purchase: str = "purchase") -> DataFrame:
    """Totals ``name`` of ``events``: group_id, the keys, n (rows), n_events (rows with
    an event_id) and total (exact revenue). Rows with a column ``_sign`` of -1 are
    taken away."""
    rows = _grouped(events, name, purchase)
    sign = F.col(_SIGN) if _SIGN in events.columns else F.lit(1)
    keys = _KEYS[name]
    known = F.when(F.col("event_id").isNotNull(), sign).otherwise(F.lit(0))
    return (
        rows.groupBy(*keys)
        .agg(
            F.sum(sign).cast("bigint").alias("n"),
            F.sum(known).cast("bigint").alias("n_events"),
            exact_total(revenue() * sign).alias("total"),
        )
        .select(_group_id(keys).alias("group_id"), *keys, "n", "n_events", "total")
    )


def write_totals(
    events: DataFrame, tables: Mapping[str, VersionedTable], purchase: str = "purchase"
) -> None:
    """Totals of all events as a new version of each table of totals."""
    for name, table in tables.items():
        table.overwrite(event_totals(events, name, purchase))


def replaced_rows(current: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The rows of ``current`` that a merge of ``batch`` by ``key`` replaces. The
    smallest and the largest key of the batch reach the scan."""
    low, high = batch.agg(F.min(key), F.max(key)).first()
    if low is None:
        return current.limit(0)
    near = current.filter(F.col(key).between(F.lit(low), F.lit(high)))
    return near.join(batch.select(key).dropna(), key, "left_semi").select(*current.columns)


def update_totals(
    changes: DataFrame,
    current: DataFrame,
    tables: Mapping[str, VersionedTable],
    purchase: str = "purchase",
) -> None:
    """Add ``changes`` (events with ``_sign``, stored) to the tables of totals.

    ``current``: all events after the change. It is read only for groups with values
    that cannot be taken away exactly. Groups without rows stay as such and are left
    out of curated results.
    """
    for name, table in tables.items():
        keys = _KEYS[name]
        delta = event_totals(changes, name, purchase)
        concerned = table.current().join(delta.select("group_id"), "group_id", "left_semi")
        updated = (
            concerned.unionByName(delta)
            .groupBy("group_id", *keys)
            .agg(
                F.sum("n").alias("n"),
                F.sum("n_events").alias("n_events"),
                add_totals("total").alias("total"),
                F.bool_or(F.col("total.rest").isNotNull()).alias("inexact"),
            )
        )
        inexact = updated.filter("inexact").select("group_id")
        rows = updated.filter("not inexact").drop("inexact")
        if not inexact.isEmpty():
            grouped = _grouped(current, name, purchase).withColumn("group_id", _group_id(keys))
            again = grouped.join(inexact, "group_id", "left_semi").drop("group_id")
            anew = event_totals(again, name, purchase)
            gone = updated.filter("inexact").join(anew.select("group_id"), "group_id", "left_anti")
            none = gone.drop("inexact").withColumns(
                {"n": F.lit(0).cast("bigint"), "n_events": F.lit(0).cast("bigint")}
            )
            rows = rows.unionByName(anew).unionByName(none)
        table.merge(rows, "group_id")


def curated(totals: Mapping[str, DataFrame], products: DataFrame) -> dict[str, DataFrame]:
    """The four curated results, from the tables of totals."""
    days = totals["days"].filter(F.col("n") > 0)
    by_type = days.groupBy("region", "event_type").agg(
        total_as_double(add_totals("total")).alias("total_revenue"),
        F.sum("n_events").alias("event_count"),
    )
    by_day = days.groupBy("date", "region").agg(F.sum("n_events").alias("event_count"))
    daily = days.groupBy("region", "date").agg(add_totals("total").alias("daily_revenue"))
    sold = totals["products"].filter(F.col("n") > 0)
    return {
        "revenue_by_region_type": by_type.orderBy("region", "event_type"),
        "daily_event_counts": by_day.orderBy("date", "region"),
        "top_products": best_products(
            sold.select("product_id", F.col("total").alias("total_revenue")), products
        ),
        "rolling_revenue": as_doubles(rolling_revenue(daily)),
    }
