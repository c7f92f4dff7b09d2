"""Cleaning rules of the silver layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REQUIRED_COLUMNS = ("event_id", "user_id", "event_timestamp", "event_type")


def clean(
    events: DataFrame,
    required: tuple[str, ...] = REQUIRED_COLUMNS,
    timestamp_type: str = "timestamp",
) -> DataFrame:
    """Keep rows with all required values, a positive price and quantity.

    A NULL price or quantity fails the comparison; a NaN price passes it, since
    Spark orders NaN above every number. ``timestamp_type="timestamp_ntz"``
    keeps wall-clock times as they are; the default reads them in the session
    time zone.
    """
    return (
        events.dropna(how="any", subset=list(required))
        .filter((F.col("price") > 0) & (F.col("quantity") > 0))
        .withColumns(
            {
                "event_timestamp": F.col("event_timestamp").cast(timestamp_type),
                "price": F.col("price").cast("double"),
                "quantity": F.col("quantity").cast("int"),
            }
        )
    )
