"""Views that give the input tables the columns the operators work on.

Order lines and events meet one ready-made table, so the largest table is
shuffled once. That join, and the one of orders with users, are hinted as
sort-merge: Spark takes the product of the sizes for the size of a chain of joins,
so without the hint it would take the larger table for the small side and
broadcast it. Adaptive execution splits
crowded keys in such a join. Nation and region are broadcast by their file size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import scan

_PRODUCT_COLUMNS = ("p_partkey AS product_id", "p_type AS category", "p_retailprice AS base_price")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table, with the columns that its files have now."""
    return scan(spark, f"{sf_dir}/{name}.parquet")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr("r_name AS region")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, region."""
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
        .selectExpr("c_custkey AS user_id", "r_name AS region")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_id, category, base_price of every product."""
    return table(spark, sf_dir, "part").selectExpr(*_PRODUCT_COLUMNS)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line; order_id is not unique."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id", "o_custkey AS user_id"
    )
    placed = orders.join(users(spark, sf_dir).hint("merge"), "user_id")
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_shipdate AS event_timestamp",
        "l_returnflag AS event_type",
        "l_partkey AS product_id",
        "l_extendedprice AS price",
        "l_quantity AS quantity",
    )
    return lines.join(placed.hint("merge"), "order_id").select(
        "order_id",
        "user_id",
        "event_timestamp",
        "event_type",
        "product_id",
        "price",
        "quantity",
        "region",
    )


def dirty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales, with damage by rule: the input itself has no bad rows."""
    return sales(spark, sf_dir).selectExpr(
        "order_id",
        "CASE WHEN order_id % 79 <> 0 THEN user_id END AS user_id",
        "event_timestamp",
        "CASE WHEN order_id % 97 <> 0 THEN event_type END AS event_type",
        "product_id",
        "CASE WHEN order_id % 89 = 0 THEN 0D ELSE price END AS price",
        "CASE WHEN order_id % 83 = 0 THEN -1D ELSE quantity END AS quantity",
        "region",
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with the unique key event_id, without its region."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "ts AS event_timestamp",
        "event_type",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS product_id",
        "value AS price",
        "CAST(1 + event_id % 9 AS INT) AS quantity",
    )


def with_region(rows: DataFrame, located_users: DataFrame) -> DataFrame:
    """Add the region of the user as the last column."""
    return rows.join(located_users, "user_id").select(*rows.columns, "region")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events with the region of their user."""
    return with_region(raw_events(spark, sf_dir), users(spark, sf_dir).hint("merge"))
