"""The layered pipeline and the four job outputs, as functions of their inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_doubles
from ..operators import (
    category_revenue,
    clean,
    daily_revenue,
    rank_in_day,
    region_type_stats,
    rolling_revenue,
    sorted_revenue,
    user_region_totals,
)
from ..operators.upsert import as_target_rows
from ..sources import VersionedTable, scan, write_table
from .gold import curated, replaced_rows, update_totals, write_totals

TOTALS = ("days", "products")
GOLD = ("revenue_by_region_type", "daily_event_counts", "top_products", "rolling_revenue")


@dataclass(frozen=True)
class PipelineTables:
    """What a pipeline run has written."""

    bronze_events: str
    bronze_dimensions: Mapping[str, str]
    silver: VersionedTable
    totals: Mapping[str, VersionedTable]
    gold: Mapping[str, VersionedTable]


# -- bronze ----------------------------------------------------------------


def store_events(events: DataFrame, path: str) -> None:
    """Store raw events in one folder per region."""
    write_table(events, path, partition_by=["region"])


def store_dimensions(dimensions: Mapping[str, DataFrame], path: str) -> dict[str, str]:
    """Store each dimension table as it is; returns the folder of each."""
    folders = {name: f"{path}/{name}" for name in dimensions}
    for name, rows in dimensions.items():
        write_table(rows, folders[name])
    return folders


# -- silver ----------------------------------------------------------------


def evolve_with_discount(table: VersionedTable) -> int:
    """Commit the current rows with a nullable discount column."""
    return table.add_column("discount", "double")


# -- gold ------------------------------------------------------------------


def _write_gold(tables: PipelineTables) -> None:
    products = scan(tables.silver.spark, tables.bronze_dimensions["products"])
    totals = {name: table.current() for name, table in tables.totals.items()}
    for name, result in curated(totals, products).items():
        tables.gold[name].overwrite(result)


# -- whole runs ------------------------------------------------------------


def run_pipeline(
    spark: SparkSession,
    events: DataFrame,
    dimensions: Mapping[str, DataFrame],
    root: str,
    timestamp_type: str = "timestamp",
    late: DataFrame | None = None,
) -> PipelineTables:
    """Bronze, silver (clean, new column, late rows) and gold below ``root``.

    ``dimensions`` must hold ``products``. ``late`` are corrected or new events,
    with the columns of the events and ``discount``; they are cleaned like the
    others and merged in by ``event_id``. Without them no value is changed. Each
    layer reads what the layer before it has stored; the gold tables read two tables
    of totals, which ``refresh_pipeline`` keeps up to date.
    """
    bronze_events = f"{root}/bronze/events"
    store_events(events, bronze_events)
    folders = store_dimensions(dimensions, f"{root}/bronze")

    silver = VersionedTable(spark, f"{root}/silver/events")
    # Bronze lies by region already, so cleaned rows are written as they come.
    silver.overwrite(
        clean(scan(spark, bronze_events), timestamp_type=timestamp_type),
        partition_by=["region"],
        rebalance=False,
    )
    evolve_with_discount(silver)
    if late is not None:
        rows = clean(late, timestamp_type=timestamp_type)
        silver.merge(rows, "event_id", partition_by=["region"])

    tables = PipelineTables(
        bronze_events,
        folders,
        silver,
        {name: VersionedTable(spark, f"{root}/totals/{name}") for name in TOTALS},
        {name: VersionedTable(spark, f"{root}/gold/{name}") for name in GOLD},
    )
    write_totals(silver.current(), tables.totals)
    _write_gold(tables)
    return tables


def refresh_pipeline(
    tables: PipelineTables, late: DataFrame, root: str, timestamp_type: str = "timestamp"
) -> None:
    """Merge late rows into the silver table of a finished run and bring its gold
    tables up to date; the result is that of a full run with the same rows.

    ``root``: a fresh folder for the change set. Of the silver events only those that
    the late rows replace are read in full, and those of groups whose sums cannot be
    changed exactly (see ``gold``); of the tables of totals only the groups concerned
    are written.
    """
    spark, silver = tables.silver.spark, tables.silver
    columns = silver.current().schema
    write_table(as_target_rows(clean(late, timestamp_type=timestamp_type), columns), f"{root}/late")
    batch = scan(spark, f"{root}/late")
    replaced = replaced_rows(silver.current(), batch, "event_id")
    changes = batch.withColumn("_sign", F.lit(1)).unionByName(
        replaced.withColumn("_sign", F.lit(-1))
    )
    write_table(changes, f"{root}/changes")
    silver.merge(batch, "event_id", partition_by=["region"])
    update_totals(scan(spark, f"{root}/changes"), silver.current(), tables.totals)
    _write_gold(tables)


def run_jobs(
    events: DataFrame,
    products: DataFrame,
    root: str,
    partition_counts: Sequence[int] = (2, 4, 8),
) -> dict[str, str]:
    """Write the results of the aggregation, join, window and width jobs.

    The revenue by user is summed once and stored; only its sort is done for
    every width.
    """
    write_table(user_region_totals(events), f"{root}/user_totals")
    totals = scan(events.sparkSession, f"{root}/user_totals")
    results = {
        "region_types": region_type_stats(events),
        "categories_by_broadcast": category_revenue(events, products, "broadcast"),
        "categories_by_shuffle": category_revenue(events, products, "shuffle"),
        "ranked_days": as_doubles(rank_in_day(rolling_revenue(daily_revenue(events)))),
    }
    for n in partition_counts:
        results[f"users_in_{n}_ranges"] = sorted_revenue(totals, n)
    folders = {name: f"{root}/{name}" for name in results}
    for name, result in results.items():
        write_table(result, folders[name])
    return folders
