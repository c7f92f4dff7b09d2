"""Every query by name: (session, folder of input tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_doubles, exact_sum, revenue
from ..operators import (
    category_revenue,
    clean,
    count_keys,
    count_rows,
    daily_event_counts,
    daily_revenue,
    grand_totals,
    mean_final_price,
    path_summary,
    rank_in_day,
    region_features,
    region_type_stats,
    revenue_by_region_type,
    rolling_revenue,
    score,
    score_summary,
    top_products,
    user_region_revenue,
)
from ..sources import (
    VersionedTable,
    first_rows,
    raw_tables,
    read_table,
    run_folder,
    scan,
    write_table,
)
from . import views
from .pipeline import (
    PipelineTables,
    evolve_with_discount,
    refresh_pipeline,
    run_jobs,
    run_pipeline,
    store_dimensions,
    store_events,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FORMATS = ("parquet", "orc")
FILTER_REGION = "ASIA"
SAMPLE_ROWS = 2_000
RAW_FILES = 3
LATE_ROWS = 1_000
LATE_PRICE_FACTOR = 0.9
LATE_DISCOUNT = 0.10
NEW_ID_OFFSET = 1_000_000_000_000
SALES_REQUIRED = ("order_id", "user_id", "event_timestamp", "event_type")

# Price weight, quantity weight and bias per region.
REGION_WEIGHTS = {
    "AFRICA": (0.3, 1.5, 2.0),
    "AMERICA": (0.4, 1.2, 1.0),
    "ASIA": (0.5, 0.9, 0.0),
    "EUROPE": (0.6, 0.6, -1.0),
    "MIDDLE EAST": (0.7, 0.3, -2.0),
}


def query(build: Query) -> Query:
    QUERIES[build.__name__.removesuffix("_query")] = build
    return build


def _stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# -- ingestion and formats -------------------------------------------------


@query
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales stored by region, then read back by partition discovery."""
    path = run_folder(spark, "bronze") + "/events"
    store_events(views.sales(spark, sf_dir), path)
    return _region_totals(scan(spark, path))


def _region_totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_rows"),
        exact_sum(revenue()).alias("total_revenue"),
    )


def _dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"users": views.users(spark, sf_dir), "products": views.products(spark, sf_dir)}


@query
def raw_glob_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales that arrive as several raw files, found by name and stored by region."""
    root = run_folder(spark, "raw")
    sales = views.sales(spark, sf_dir)
    for i in range(RAW_FILES):
        part = sales.filter(F.col("order_id") % RAW_FILES == i)
        write_table(part, f"{root}/in/events_{i}.parquet")
    for name, rows in _dimensions(spark, sf_dir).items():
        write_table(rows, f"{root}/in/{name}.parquet")
    events, _ = raw_tables(spark, f"{root}/in")
    store_events(events, f"{root}/events")
    return _region_totals(scan(spark, f"{root}/events"))


@query
def bronze_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, keys and the first and last text of the dimension tables as stored."""
    folders = store_dimensions(_dimensions(spark, sf_dir), run_folder(spark, "dims"))
    columns = {"users": ("user_id", "region"), "products": ("product_id", "category")}
    return _stacked(
        [
            scan(spark, path).select(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("n_rows"),
                F.countDistinct(columns[name][0]).alias("n_keys"),
                F.sum(columns[name][0]).alias("key_sum"),
                F.min(columns[name][1]).alias("first_text"),
                F.max(columns[name][1]).alias("last_text"),
            )
            for name, path in folders.items()
        ]
    )


def _stored_copies(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    root = run_folder(spark, "formats")
    rows = views.sales(spark, sf_dir)
    copies = {}
    for fmt in FORMATS:
        write_table(rows, f"{root}/{fmt}", fmt)
        copies[fmt] = read_table(spark, f"{root}/{fmt}", fmt)
        # Further formats copy the stored rows instead of joining them again.
        rows = copies[fmt]
    return copies


STORED_VALUES = (
    "n_rows",
    "total_revenue",
    "total_price",
    "first_time",
    "last_time",
    "n_keys",
    "n_groups",
)


def _stored_values(copies: dict[str, DataFrame]) -> DataFrame:
    """Figures that change if a format spoils a value."""
    return _stacked(
        [
            rows.agg(
                F.count(F.lit(1)).alias("n_rows"),
                exact_sum(revenue()).alias("total_revenue"),
                exact_sum(F.col("price")).alias("total_price"),
                F.min("event_timestamp").alias("first_time"),
                F.max("event_timestamp").alias("last_time"),
                F.countDistinct("region", "event_type").alias("n_groups"),
            )
            .crossJoin(count_keys(rows, "order_id", "product_id", "user_id"))
            .select(*STORED_VALUES, F.lit(name).alias("format"))
            for name, rows in copies.items()
        ]
    )


@query
def format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of the sales as stored in each format."""
    return _stored_values(_stored_copies(spark, sf_dir))


@query
def filtered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of one region: row filter per format, and by folder."""
    copies = _stored_copies(spark, sf_dir)
    by_region = run_folder(spark, "formats") + "/by_region"
    write_table(copies["parquet"], by_region, partition_by=["region"])
    copies["parquet by region"] = scan(spark, by_region)
    return _stored_values(
        {name: c.filter(F.col("region") == FILTER_REGION) for name, c in copies.items()}
    )


@query
def versioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of a versioned table, whole and of one region."""
    versioned = VersionedTable(spark, run_folder(spark, "scan"))
    versioned.overwrite(views.sales(spark, sf_dir), partition_by=["region"])
    current = versioned.current()
    return _stacked(
        [
            count_rows(current).select(F.lit("all").alias("region"), "n_rows"),
            count_rows(current, FILTER_REGION).select(F.lit(FILTER_REGION).alias("region"), "n_rows"),
        ]
    )


@query
def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pass the cleaning rules; zone-less times are kept as they are."""
    return clean(views.dirty_sales(spark, sf_dir), SALES_REQUIRED, "timestamp_ntz")


# -- aggregates, joins and windows over sales --------------------------------


@query
def revenue_by_region_type_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_by_region_type(views.sales(spark, sf_dir), "order_id")


@query
def agg_region_type_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_type_stats(views.sales(spark, sf_dir))


@query
def daily_event_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_event_counts(views.sales(spark, sf_dir), "order_id")


@query
def top_products_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(views.sales(spark, sf_dir), views.products(spark, sf_dir), "R")


@query
def user_region_revenue_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_region_revenue(views.sales(spark, sf_dir))


@query
def grand_totals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grand_totals(views.dirty_sales(spark, sf_dir))


@query
def category_revenue_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = views.products(spark, sf_dir)
    return category_revenue(views.sales(spark, sf_dir), products, "broadcast")


@query
def category_revenue_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = views.products(spark, sf_dir)
    return category_revenue(views.sales(spark, sf_dir), products, "shuffle")


@query
def rolling_revenue_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(rolling_revenue(daily_revenue(views.sales(spark, sf_dir))))


@query
def rolling_revenue_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(rolling_revenue(daily_revenue(views.sales(spark, sf_dir)), frame="days"))


@query
def rank_in_day_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(rank_in_day(daily_revenue(views.sales(spark, sf_dir))))


# -- features, scores and price paths ----------------------------------------


@query
def region_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of all regions and of one more that has no events."""
    listed = views.regions(spark, sf_dir).unionByName(
        spark.range(1).select(F.lit("UNSERVED").alias("region"))
    )
    return region_features(views.sales(spark, sf_dir), listed)


@query
def score_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(views.events(spark, sf_dir), REGION_WEIGHTS)
    return scored.select("event_id", "region", F.round("score", 6).alias("score"))


@query
def score_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a sample of fixed size, the events with the smallest keys."""
    sample = first_rows(views.raw_events(spark, sf_dir), SAMPLE_ROWS, "event_id")
    scored = score(views.with_region(sample, views.users(spark, sf_dir)), REGION_WEIGHTS)
    return scored.select("event_id", "region", F.round("score", 6).alias("score"))


@query
def score_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(views.events(spark, sf_dir), REGION_WEIGHTS)
    return score_summary(scored)


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    returns = views.raw_events(spark, sf_dir).select(
        "product_id",
        F.col("event_id").alias("step"),
        ((F.col("price") - 50) / 10000).alias("log_return"),
    )
    return path_summary(returns, views.products(spark, sf_dir))


@query
def path_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price path per product, one step per event of the product."""
    figures = ("final_price", "max_price", "min_price", "volatility")
    return _paths(spark, sf_dir).withColumns({c: F.round(c, 6) for c in figures})


@query
def path_mean_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = mean_final_price(_paths(spark, sf_dir))
    return summary.select(F.round("avg_final", 6).alias("avg_final"))


# -- versioned tables --------------------------------------------------------


def _first_version(spark: SparkSession, sf_dir: str, name: str) -> VersionedTable:
    versioned = VersionedTable(spark, run_folder(spark, name))
    versioned.overwrite(views.events(spark, sf_dir), partition_by=["region"])
    return versioned


@query
def snapshot_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest of two versions: all events, then the sound ones."""
    versioned = _first_version(spark, sf_dir, "current")
    versioned.overwrite(
        clean(versioned.current(), timestamp_type="timestamp_ntz"),
        partition_by=["region"],
        rebalance=False,
    )
    return versioned.current()


@query
def as_of_v0(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 0 after a later version has got one more column."""
    versioned = _first_version(spark, sf_dir, "as_of")
    evolve_with_discount(versioned)
    return versioned.as_of(0)


@query
def append_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and price total per event type after the purchases came once more."""
    versioned = _first_version(spark, sf_dir, "append")
    again = versioned.current().filter(F.col("event_type") == "purchase")
    versioned.append(again.withColumn("discount", F.lit(0.0)), partition_by=["region"])
    return (
        versioned.current()
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("discount").alias("n_discounts"),
            exact_sum(F.col("price")).alias("total_price"),
        )
    )


@query
def evolve_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new column is NULL in every row of the new version."""
    versioned = _first_version(spark, sf_dir, "evolve")
    evolve_with_discount(versioned)
    return versioned.current().select("event_id", "price", "discount")


def corrected(rows: DataFrame) -> DataFrame:
    """Late rows: reduced price and a discount."""
    return rows.withColumns(
        {
            "price": F.col("price") * F.lit(LATE_PRICE_FACTOR),
            "discount": F.lit(LATE_DISCOUNT),
        }
    )


@query
def late_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A late batch of 1,000 corrected rows merged into the whole table."""
    root = run_folder(spark, "late")
    versioned = VersionedTable(spark, f"{root}/events")
    versioned.overwrite(views.events(spark, sf_dir), partition_by=["region"])
    evolve_with_discount(versioned)
    first = first_rows(versioned.current(), LATE_ROWS, "event_id")
    versioned.merge(corrected(first), "event_id", partition_by=["region"])
    return versioned.current().select("event_id", "price", "discount")


def _after_large_batch(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Versions 0, 1, 2; the batch corrects all purchases and repeats all
    sign-ups under new keys, so it grows with the table."""
    root = run_folder(spark, "late-insert")
    versioned = VersionedTable(spark, f"{root}/events")
    versioned.overwrite(views.events(spark, sf_dir), partition_by=["region"])
    evolve_with_discount(versioned)
    is_new = F.col("event_type") == "signup"
    batch = corrected(
        versioned.current()
        .filter(F.col("event_type").isin("purchase", "signup"))
        .withColumn(
            "event_id",
            F.when(is_new, F.col("event_id") + NEW_ID_OFFSET).otherwise(F.col("event_id")),
        )
    )
    versioned.merge(batch, "event_id", partition_by=["region"])
    return versioned


@query
def late_upsert_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large late batch with known and new keys merged into the table."""
    current = _after_large_batch(spark, sf_dir).current()
    return current.select("event_id", "event_type", "price", "discount", "region")


@query
def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and columns of the first and the latest version."""
    versioned = _after_large_batch(spark, sf_dir)
    return versioned.diff(0, versioned.latest_version())


@query
def version_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operation and row count of every version."""
    return _after_large_batch(spark, sf_dir).history().drop("committed_at")


# -- whole runs ----------------------------------------------------------------


def _run(spark: SparkSession, sf_dir: str) -> PipelineTables:
    """All layers over the events; the late rows correct every sign-up."""
    events = views.events(spark, sf_dir)
    return run_pipeline(
        spark,
        events,
        _dimensions(spark, sf_dir),
        run_folder(spark, "pipeline"),
        timestamp_type="timestamp_ntz",
        late=corrected(events.filter(F.col("event_type") == "signup")),
    )


@query
def pipeline_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events to curated revenue through all layers."""
    return _run(spark, sf_dir).gold["revenue_by_region_type"].current()


@query
def gold_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).gold["daily_event_counts"].current()


@query
def gold_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).gold["top_products"].current()


@query
def gold_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).gold["rolling_revenue"].current()


def _refreshed(spark: SparkSession, sf_dir: str) -> PipelineTables:
    """A run without late rows, refreshed twice: sign-ups are corrected, then all
    purchases come once more, corrected, under new keys."""
    events = views.events(spark, sf_dir)
    root = run_folder(spark, "refreshed")
    tables = run_pipeline(
        spark, events, _dimensions(spark, sf_dir), root, timestamp_type="timestamp_ntz"
    )
    again = events.filter(F.col("event_type") == "purchase").withColumn(
        "event_id", F.col("event_id") + NEW_ID_OFFSET
    )
    batches = (corrected(events.filter(F.col("event_type") == "signup")), corrected(again))
    for i, late in enumerate(batches):
        refresh_pipeline(tables, late, f"{root}/refresh-{i}", timestamp_type="timestamp_ntz")
    return tables


@query
def refreshed_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated revenue after two batches of late rows, kept up to date by deltas."""
    return _refreshed(spark, sf_dir).gold["revenue_by_region_type"].current()


@query
def refreshed_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir).gold["top_products"].current()


@query
def job_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored values of the aggregation, join, window and width jobs over sales
    that were stored first: the name of the job, its keys as text, its figures."""
    root = run_folder(spark, "jobs")
    store_events(views.sales(spark, sf_dir), f"{root}/events")
    folders = run_jobs(
        scan(spark, f"{root}/events"), views.products(spark, sf_dir), f"{root}/results"
    )
    rolled = "rolling_7d_revenue"

    def values(name: str) -> tuple[list[str], list[str]]:
        if name == "region_types":
            return ["region", "event_type"], ["total_revenue", "avg_price"]
        if name == "ranked_days":
            return ["region", "CAST(date AS STRING)"], [rolled, "CAST(rank_in_day AS DOUBLE)"]
        if name.startswith("users_in_"):
            return ["CAST(user_id AS STRING)", "region"], ["user_revenue", "CAST(NULL AS DOUBLE)"]
        return ["category", "CAST(NULL AS STRING)"], ["revenue", "CAST(NULL AS DOUBLE)"]

    parts = []
    for name, path in folders.items():
        (first_key, second_key), (figure, second) = values(name)
        parts.append(
            scan(spark, path).selectExpr(
                f"'{name}' AS job",
                f"{first_key} AS first_key",
                f"{second_key} AS second_key",
                f"{figure} AS figure",
                f"{second} AS second_figure",
            )
        )
    return _stacked(parts)
