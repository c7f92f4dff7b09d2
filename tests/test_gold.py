"""Gold tables kept up to date by deltas, against full runs with the same rows."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakestrata.plans import refresh_pipeline, run_pipeline
from lakestrata.plans.gold import event_totals

from rows import event, events

TYPES = ["purchase", "view", "add_to_cart"]


def some_events(n, seed, prices=(0.1, 19.99, 3.05, 1e11 + 0.25)):
    rng = random.Random(seed)
    return [
        event(
            i,
            event_type=rng.choice(TYPES),
            product_id=rng.choice([1, 2, 3, 4, None]),
            price=rng.choice(prices),
            quantity=rng.randint(1, 9),
            region=rng.choice(["north", "south", None]),
            event_timestamp=datetime(2024, rng.randint(1, 3), rng.randint(10, 14), 10),
        )
        for i in range(n)
    ]


@pytest.fixture
def products(spark):
    return spark.createDataFrame([(1, "a", 5.0), (2, "b", 6.0)], "product_id int, category string, base_price double")


def late_rows(spark, rows):
    return events(spark, *rows).withColumn("discount", F.lit(0.2))


def gold_rows(tables):
    found = {}
    for name, table in tables.gold.items():
        current = table.current()
        found[name] = sorted(map(repr, current.select(sorted(current.columns)).collect()))
    return found


def both(spark, products, tmp_path, base, batches):
    """Gold tables of a run that was refreshed, and of one over the final rows."""
    raw = events(spark, *base)
    tables = run_pipeline(spark, raw, {"products": products}, str(tmp_path / "a"))
    final = {r[0]: r for r in base}
    for i, batch in enumerate(batches):
        refresh_pipeline(tables, late_rows(spark, batch), str(tmp_path / f"refresh-{i}"))
        final.update({r[0]: r for r in batch})
    whole = run_pipeline(
        spark, events(spark, *final.values()), {"products": products}, str(tmp_path / "b")
    )
    return tables, whole


def test_deltas_equal_a_full_run_to_the_last_digit(spark, products, tmp_path):
    base = some_events(300, 1)
    moved = [(*r[:2], datetime(2025, 6, 1), *r[3:]) for r in some_events(40, 2)]
    new = [(10_000 + r[0], *r[1:]) for r in some_events(30, 3)]
    tables, whole = both(spark, products, tmp_path, base, [moved, new + some_events(25, 4)])
    assert gold_rows(tables) == gold_rows(whole)
    assert tables.silver.current().count() == whole.silver.current().count() == 330


def test_values_that_cannot_be_taken_away(spark, products, tmp_path):
    """NaN, infinity and many decimals come and go; the other groups stay exact."""
    odd = (float("nan"), float("inf"), 1 / 3, 2.5)
    base = some_events(200, 5)
    tables, whole = both(
        spark, products, tmp_path, base, [some_events(9, 6, odd), some_events(9, 7)]
    )
    assert gold_rows(tables) == gold_rows(whole)


def test_groups_that_lose_all_rows_are_gone(spark, products, tmp_path):
    base = [event(1, region="north", event_type="view"), event(2, region="south", event_type="purchase")]
    moved = [event(1, region="south", event_type="purchase")]
    tables, whole = both(spark, products, tmp_path, base, [moved, []])
    assert gold_rows(tables) == gold_rows(whole)
    assert tables.gold["revenue_by_region_type"].current().count() == 1


def test_only_groups_concerned_are_written(spark, products, tmp_path):
    tables = run_pipeline(spark, events(spark, *some_events(300, 8)), {"products": products}, str(tmp_path / "a"))
    before = {name: t.current().count() for name, t in tables.totals.items()}
    late = [event(5000, region="north", event_type="purchase", product_id=2, event_timestamp=datetime(2024, 1, 10, 1))]
    refresh_pipeline(tables, late_rows(spark, late), str(tmp_path / "late"))
    for name, table in tables.totals.items():
        assert before[name] > 1
        folders = table._record()["folders"]
        assert spark.read.parquet(f"{table.root}/{folders[-1]['path']}").count() == 1


def test_totals_tell_null_keys_apart(spark):
    rows = events(spark, event(1, region=None), event(2, region="null"), event(3, region=None))
    found = event_totals(rows, "days").collect()
    assert sorted((r.region or "", r.n) for r in found) == [("", 2), ("null", 1)]
    assert len({r.group_id for r in found}) == 2
