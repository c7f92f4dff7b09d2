from __future__ import annotations

from datetime import date

import pytest

from lakestrata.operators import rank_in_day, rolling_revenue

DAILY = "region string, date date, daily_revenue double"


@pytest.fixture
def gaps(spark):
    days = [1, 2, 3, 9, 10]
    return spark.createDataFrame(
        [("north", date(2024, 1, d), float(d)) for d in reversed(days)]
        + [("south", date(2024, 1, 3), 100.0)],
        DAILY,
    )


def rolled(df):
    return {
        r.date.day: r.rolling_7d_revenue for r in df.collect() if r.region == "north"
    }


def test_rows_frame_counts_rows(gaps):
    assert rolled(rolling_revenue(gaps)) == {1: 1.0, 2: 3.0, 3: 6.0, 9: 15.0, 10: 25.0}


def test_days_frame_counts_days(gaps):
    found = rolled(rolling_revenue(gaps, frame="days"))
    assert found == {1: 1.0, 2: 3.0, 3: 6.0, 9: 12.0, 10: 19.0}


def test_other_widths_and_frames(gaps):
    two = rolling_revenue(gaps, days=2)
    assert "rolling_2d_revenue" in two.columns
    assert {r.date.day: r.rolling_2d_revenue for r in two.collect() if r.region == "north"} == {
        1: 1.0, 2: 3.0, 3: 5.0, 9: 12.0, 10: 19.0,
    }
    with pytest.raises(ValueError):
        rolling_revenue(gaps, frame="weeks")


def test_equal_revenues_share_a_rank(spark):
    day = date(2024, 1, 1)
    df = spark.createDataFrame(
        [("a", day, 5.0), ("b", day, 5.0), ("c", day, 1.0), ("a", date(2024, 1, 2), 0.5)], DAILY
    )
    ranks = {(r.region, r.date.day): r.rank_in_day for r in rank_in_day(df).collect()}
    assert ranks == {("a", 1): 1, ("b", 1): 1, ("c", 1): 3, ("a", 2): 1}
