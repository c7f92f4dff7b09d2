"""Hand-written event rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "event_id bigint, user_id int, event_timestamp timestamp_ntz, event_type string, "
    "product_id int, price double, quantity int, region string"
)
COLUMNS = [part.split()[0] for part in SCHEMA.split(", ")]


def event(event_id, **values):
    row = {
        "event_id": event_id,
        "user_id": 1,
        "event_timestamp": datetime(2024, 1, 1, 12),
        "event_type": "purchase",
        "product_id": 1,
        "price": 10.0,
        "quantity": 1,
        "region": "north",
    }
    row.update(values)
    return tuple(row[c] for c in COLUMNS)


def events(spark: SparkSession, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), SCHEMA)


def tuples(df: DataFrame, *columns: str) -> list[tuple]:
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
