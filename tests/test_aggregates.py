from __future__ import annotations

import math
from datetime import date, datetime

import pytest

from lakestrata.operators import (
    category_revenue,
    count_rows,
    daily_event_counts,
    grand_totals,
    region_features,
    region_type_stats,
    revenue_by_region_type,
    score,
    score_summary,
    top_products,
    user_region_revenue,
)

from rows import event, events, tuples

PRODUCTS = "product_id int, category string, base_price double"


def test_revenue_counts_only_rows_with_a_key(spark):
    df = events(spark, event(0, price=1.1, quantity=3), event(None, price=2.0))
    assert tuples(revenue_by_region_type(df)) == [("north", "purchase", 5.3, 1)]


def test_stats(spark):
    df = events(spark, event(0, price=1.0), event(1, price=4.0, quantity=2), event(2, price=None))
    assert tuples(region_type_stats(df)) == [("north", "purchase", 3, 9.0, 2.5, 4.0)]


def test_daily_counts_by_calendar_day(spark):
    df = events(
        spark,
        event(0, event_timestamp=datetime(2024, 1, 1, 23, 59, 59)),
        event(1, event_timestamp=datetime(2024, 1, 2, 0, 0, 0)),
        event(2, event_timestamp=datetime(2024, 1, 2, 5, 0, 0)),
    )
    assert tuples(daily_event_counts(df)) == [
        (date(2024, 1, 1), "north", 1),
        (date(2024, 1, 2), "north", 2),
    ]


def test_top_products_ties_unlisted_and_repeated_products(spark):
    df = events(
        spark,
        event(0, product_id=3, price=5.0),
        event(1, product_id=2, price=5.0),
        event(2, product_id=1, price=9.0),
        event(3, product_id=4, price=1.0),
        event(4, product_id=5, price=99.0, event_type="view"),
    )
    listed = spark.createDataFrame([(2, "toys", 1.0), (1, "food", 2.0), (5, "x", 3.0)], PRODUCTS)
    rows = [tuple(r) for r in top_products(df, listed, k=3).collect()]
    assert rows == [(1, 9.0, "food", 2.0), (2, 5.0, "toys", 1.0), (3, 5.0, None, None)]
    twice = listed.unionByName(listed)
    assert top_products(df, twice, k=3).count() == 3


@pytest.mark.parametrize("n", [2, 4, 8])
def test_sort_width_does_not_change_the_result(spark, n):
    df = events(
        spark,
        *(event(i, user_id=i % 13, region="ns"[i % 2], price=float(i % 7 + 1)) for i in range(60)),
    )
    plain = [tuple(r) for r in user_region_revenue(df).collect()]
    wide = user_region_revenue(df, n)
    assert [tuple(r) for r in wide.collect()] == plain
    assert wide.rdd.getNumPartitions() == n
    revenues = [r[2] for r in plain]
    assert revenues == sorted(revenues, reverse=True)


def test_grand_totals_leave_out_missing_groups_and_nan(spark):
    df = events(
        spark,
        event(0, price=2.5, quantity=2),
        event(1, region=None),
        event(2, event_type=None),
        event(3, price=None),
        event(4, price=math.nan),
    )
    assert tuples(grand_totals(df)) == [(5.0, 1)]
    assert tuples(grand_totals(df.limit(0))) == [(0.0, 0)]


def test_features_of_empty_and_single_row_regions(spark):
    df = events(
        spark,
        event(0, region="north", price=1.0, quantity=2),
        event(1, region="north", price=3.0, quantity=4),
        event(2, region="south", price=5.0, quantity=1),
        event(3, region="gone", price=5.0),
        event(4, region="odd", price=math.nan),
    )
    listed = spark.createDataFrame([("north",), ("south",), ("empty",), ("odd",)], "region string")
    found = {r.region: tuple(r)[1:] for r in region_features(df, listed).collect()}
    assert found == {
        "north": (2, 2.0, pytest.approx(math.sqrt(2)), 14.0, 3.0),
        "south": (1, 5.0, None, 5.0, 1.0),
        "empty": (0, 0.0, None, 0.0, None),
        "odd": (1, None, None, 0.0, 1.0),
    }


def test_scores_use_the_weights_of_the_region(spark):
    df = events(
        spark,
        event(0, region="north", price=10.0, quantity=2),
        event(1, region="south", price=10.0, quantity=2),
        event(2, region="north", price=20.0, quantity=2),
        event(3, region="unknown"),
        event(4, region=None),
    )
    scored = score(df, {"north": (0.5, 1.5, 2.0), "south": (1.0, 0.0, -1.0)})
    assert scored.columns == [*df.columns, "score"]
    assert tuples(scored, "event_id", "score") == [(0, 10.0), (1, 9.0), (2, 15.0)]
    assert tuples(score_summary(scored)) == [("north", 2, 12.5), ("south", 1, 9.0)]


def test_both_join_strategies_and_the_size_limit_agree(spark):
    df = events(
        spark, *(event(i, product_id=0 if i % 3 else i % 7, price=i + 0.25) for i in range(200))
    )
    listed = spark.createDataFrame(
        [(i, f"c{i % 2}", 1.0) for i in range(5)], PRODUCTS
    )
    small = category_revenue(df, listed, "broadcast")
    large = category_revenue(df, listed, "broadcast", max_broadcast_bytes=1)
    merged = category_revenue(df, listed, "shuffle")
    assert tuples(small) == tuples(merged) == tuples(large)
    assert None in [r.category for r in small.collect()]
    with pytest.raises(ValueError):
        category_revenue(df, listed, "guess")


def test_filtered_count_is_a_part_of_the_full_count(spark):
    df = events(spark, event(0), event(1, region="south"), event(2, region=None))
    assert tuples(count_rows(df)) == [(3,)]
    assert tuples(count_rows(df, "north")) == [(1,)]
