"""Linear scores with one set of weights per region."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_avg

_WEIGHTS = "region string, w_price double, w_quantity double, bias double"


def score(
    events: DataFrame, weights: Mapping[str, tuple[float, float, float]]
) -> DataFrame:
    """Add ``score`` = price weight * price + quantity weight * quantity + bias.

    Events of a region without weights are left out. The weights come from the
    caller's own dictionary, so their broadcast does not grow with the data.
    """
    spark = events.sparkSession
    rows = [(region, *map(float, values)) for region, values in weights.items()]
    table = F.broadcast(spark.createDataFrame(rows, _WEIGHTS))
    value = (
        F.col("w_price") * F.col("price").cast("double")
        + F.col("w_quantity") * F.col("quantity").cast("double")
        + F.col("bias")
    )
    return (
        events.join(table, "region")
        .withColumn("score", value)
        .select(*events.columns, "score")
    )


def score_summary(scored: DataFrame) -> DataFrame:
    """Number of scored rows and mean score per region, the same whatever the order
    of the rows (scores with up to four decimals are added exactly)."""
    return scored.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), exact_avg(F.col("score")).alias("mean_score")
    )
