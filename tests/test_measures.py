from __future__ import annotations

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestrata.functions import (
    as_doubles,
    exact_avg,
    exact_stddev_samp,
    exact_sum,
    fits_broadcast,
    measured_bytes,
    nan_to_null,
)
from lakestrata.operators import category_revenue, daily_revenue, rank_in_day, rolling_revenue


def total(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.agg(exact_sum(F.col("v")).alias("s")).first()["s"]


def test_exact_sum_does_not_depend_on_order(spark):
    rng = random.Random(7)
    values = [rng.randrange(-(10**9), 10**9) / 100 for _ in range(2000)] + [1e9 + 0.01, -0.01]
    wanted = float(sum(Decimal(str(v)) for v in values))
    for _ in range(3):
        rng.shuffle(values)
        assert total(spark, values) == wanted


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(-(10**12), 10**12), min_size=1, max_size=30))
def test_exact_sum_equals_decimal_sum(spark, units):
    values = [u / 100 for u in units]
    assert total(spark, values) == float(sum(Decimal(u) for u in units) / 100)


def test_values_beyond_exact_units_are_not_lost(spark):
    assert total(spark, [1e15, 0.25]) == 1e15 + 0.25
    assert total(spark, [math.inf, 1.0]) == math.inf
    assert math.isnan(total(spark, [math.nan, 1.0]))


def test_sum_and_average_skip_null(spark):
    assert total(spark, [None, 1.5, None, 2.0]) == 3.5
    assert total(spark, [None]) is None
    df = spark.createDataFrame([(None,), (1.0,), (2.0,)], "v double")
    assert df.agg(exact_avg(F.col("v"))).first()[0] == 1.5


def test_more_decimals_are_not_cut_off(spark):
    assert total(spark, [0.123456789, 1.0]) == 0.123456789 + 1.0
    assert total(spark, [1.2e-7] * 3) == pytest.approx(3.6e-7, rel=1e-12)


def test_products_of_prices_and_factors_are_exact(spark):
    rng = random.Random(11)
    prices = [rng.randrange(1, 50000) for _ in range(3000)]
    wanted = float(sum(Decimal(p) * 9 for p in prices) / 1000)
    values = [p / 100 * 0.9 for p in prices]
    assert total(spark, values) == wanted
    assert total(spark, values[::-1]) == wanted


def test_sum_over_a_window(spark):
    df = spark.createDataFrame([(i, i / 10) for i in range(1, 6)], "i int, v double")
    window = Window.orderBy("i").rowsBetween(-1, 0)
    rows = df.select("i", exact_sum(F.col("v"), window).alias("s")).orderBy("i").collect()
    assert [r.s for r in rows] == [0.1, 0.3, 0.5, 0.7, 0.9]


def test_nan_to_null_only_touches_floats(spark):
    df = spark.createDataFrame([(math.nan, 1), (2.0, 2)], "a double, b int")
    assert [tuple(r) for r in nan_to_null(df, "a", "b").collect()] == [(None, 1), (2.0, 2)]


def test_broadcast_only_within_the_measured_size(spark):
    df = spark.range(100).select("id", F.lit("x" * 50).alias("name"))
    size = measured_bytes(df)
    assert size >= 100 * 58
    assert fits_broadcast(df, size)
    assert not fits_broadcast(df, size - 1)
    assert not fits_broadcast(df.select(F.array("id").alias("nested")), 10**12)


@pytest.mark.parametrize("empty", [True])
def test_empty_table_fits(spark, empty):
    assert fits_broadcast(spark.range(0), 0) is empty


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_large_totals_are_exact_for_any_partitioning(spark, strategy):
    rows = spark.range(60_000).select(
        (F.col("id") % 7).cast("int").alias("product_id"),
        (F.lit(6e11) + F.col("id") * 0.25).alias("price"),
        F.lit(1).alias("quantity"),
        F.lit("r").alias("region"),
        F.expr("timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 3 as int))").alias(
            "event_timestamp"
        ),
    )
    wanted = sum(Decimal(6 * 10**11) + Decimal(i) / 4 for i in range(60_000))
    products = spark.createDataFrame(
        [(i, "all", 1.0) for i in range(7)], "product_id int, category string, base_price double"
    )
    for n in (3, 7, 11):
        spread = rows.repartition(n)
        assert category_revenue(spread, products, strategy).first().revenue == float(wanted)
        days = rolling_revenue(daily_revenue(spread))
        assert max(r.rolling_7d_revenue.exact for r in days.collect()) == wanted
        last = as_doubles(rank_in_day(days)).orderBy(F.desc("date")).first()
        assert (last.rolling_7d_revenue, last.rank_in_day) == (float(wanted), 1)


def test_rank_tells_totals_apart_that_are_equal_as_doubles(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES ('a', date'2024-01-01', named_struct('exact', "
        "CAST('10000000000000000.0001' AS DECIMAL(38,4)), 'rest', CAST(NULL AS DOUBLE))), "
        "('b', date'2024-01-01', named_struct('exact', CAST('10000000000000000.0002' AS "
        "DECIMAL(38,4)), 'rest', CAST(NULL AS DOUBLE))) AS t(region, date, daily_revenue)"
    )
    assert {r.region: r.rank_in_day for r in rank_in_day(rows).collect()} == {"a": 2, "b": 1}


def deviations(spark, groups, partitions):
    rows = [(name, v) for name, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "name string, v double").repartition(partitions)
    found = df.groupBy("name").agg(exact_stddev_samp(F.col("v")).alias("std")).collect()
    return {r.name: r.std for r in found}


def test_deviation_has_the_same_bits_however_rows_are_dealt(spark):
    rng = random.Random(9)
    groups = {
        "prices": [round(rng.uniform(1, 1e5), 2) for _ in range(3000)],
        "close": [1e8 + rng.choice([0.0001, 0.0002, 0.0003]) for _ in range(999)],
        "signed": [round(rng.gauss(0, 50), 4) for _ in range(500)],
        "equal": [7.25] * 100,
        "one": [3.0],
        "none": [None],
    }
    found = [deviations(spark, groups, n) for n in (1, 3, 7)]
    assert found[0] == found[1] == found[2]
    assert found[0]["one"] is None and found[0]["none"] is None and found[0]["equal"] == 0.0
    for name in ("prices", "close", "signed"):
        exact = [Fraction(round(v * 10**4), 10**4) for v in groups[name]]
        mean = sum(exact) / len(exact)
        variance = sum((x - mean) ** 2 for x in exact) / (len(exact) - 1)
        assert found[0][name] == pytest.approx(math.sqrt(variance), rel=1e-14)


def test_deviation_of_other_values_is_that_of_doubles(spark):
    found = deviations(spark, {"thirds": [1 / 3, 2 / 3, 1.0], "nan": [1.0, math.nan], "large": [1e12, 3e12]}, 2)
    assert found["thirds"] == pytest.approx(1 / 3)
    assert math.isnan(found["nan"])
    assert found["large"] == pytest.approx(math.sqrt(2) * 1e12)
