from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest

from lakestrata.operators import mean_final_price, path_summary
from lakestrata.operators.paths import path_runs

RETURNS = "product_id int, step bigint, log_return double"


def brute_force(rows, bases):
    found = {}
    for key, base in bases.items():
        level, prices = 0.0, []
        for _, _, move in sorted(r for r in rows if r[0] == key):
            level += move
            prices.append(base * math.exp(level))
        if prices:
            mean = math.fsum(prices) / len(prices)
            std = math.sqrt(math.fsum((p - mean) ** 2 for p in prices) / len(prices))
            found[key] = (base, prices[-1], max(prices), min(prices), std)
    return found


def summary(spark, rows, bases, **options):
    returns = spark.createDataFrame(rows, RETURNS)
    table = spark.createDataFrame(list(bases.items()), "product_id int, base_price double")
    return path_summary(returns, table, **options)


@pytest.mark.parametrize("rows_per_run", [1_000_000, 50, 7, 1])
def test_long_keys_in_runs_give_the_same_figures(spark, rows_per_run):
    rng = random.Random(3)
    # One key has a third of the steps; steps of all keys are interleaved.
    rows = [
        (0 if step % 3 == 0 else rng.randrange(1, 9), step, rng.gauss(0.0, 0.05))
        for step in range(-20, 580)
    ]
    bases = {key: 10.0 * (key + 1) for key in range(9)}
    shuffled = rows[:]
    rng.shuffle(shuffled)
    found = {
        r.product_id: tuple(r)[1:]
        for r in summary(spark, shuffled, bases, rows_per_run=rows_per_run).collect()
    }
    wanted = brute_force(rows, bases)
    assert found.keys() == wanted.keys()
    for key, figures in wanted.items():
        assert found[key] == pytest.approx(figures, rel=1e-9)


@pytest.mark.parametrize("apart", [1, 10**6])
def test_runs_are_bounded_by_rows_however_far_steps_lie_apart(spark, apart):
    rng = random.Random(5)
    rows = [
        (0 if i % 3 == 0 else rng.randrange(1, 40), apart * i, rng.gauss(0.0, 0.02))
        for i in range(6000)
    ]
    rng.shuffle(rows)
    moves = spark.createDataFrame(rows, "key int, step bigint, move double")
    runs = path_runs(moves, rows_per_run=500).collect()
    assert sum(r.n for r in runs) == 6000
    assert len(runs) <= 40 + 12
    # The key with a third of the rows lies in several runs, none much too large.
    assert sum(r.key == 0 for r in runs) >= 4
    assert max(r.n for r in runs) <= 1000
    bases = {key: 5.0 + key for key in range(40)}
    found = {r.product_id: tuple(r)[1:] for r in summary(spark, rows, bases, rows_per_run=500).collect()}
    wanted = brute_force(rows, bases)
    assert found.keys() == wanted.keys()
    for key, figures in wanted.items():
        assert found[key] == pytest.approx(figures, rel=1e-9)


def test_time_stamps_as_steps(spark):
    start = datetime(2024, 1, 1)
    rows = [(i % 2, start + timedelta(hours=7 * i), 0.01 * (i % 5 - 2)) for i in range(200)]
    returns = spark.createDataFrame(rows, "product_id int, step timestamp_ntz, log_return double")
    bases = spark.createDataFrame([(0, 1.0), (1, 2.0)], "product_id int, base_price double")
    found = path_summary(returns, bases, rows_per_run=30).collect()
    wanted = brute_force(rows, {0: 1.0, 1: 2.0})
    assert {r.product_id: tuple(r)[1:] for r in found} == {
        k: pytest.approx(v, rel=1e-9) for k, v in wanted.items()
    }


def test_extreme_moves_stay_in_range(spark):
    # Up by e**900 and down again: no price at a run's end is out of range.
    rows = [(1, i, -90.0) for i in range(10)] + [(1, 10 + i, 90.0) for i in range(10)]
    found = summary(spark, rows, {1: 2.0}, rows_per_run=4).first()
    assert found.final_price == pytest.approx(2.0)
    assert found.max_price == pytest.approx(2.0)
    assert found.min_price == 0.0
    assert math.isfinite(found.volatility)


def test_single_step_and_mean(spark):
    result = summary(spark, [(1, 0, 0.0), (2, 0, math.log(2))], {1: 4.0, 2: 10.0})
    rows = {r.product_id: (r.final_price, r.volatility) for r in result.collect()}
    assert rows == {1: (4.0, 0.0), 2: (pytest.approx(20.0), 0.0)}
    assert mean_final_price(result).first()[0] == pytest.approx(12.0)


def test_no_returns(spark):
    assert summary(spark, [], {1: 4.0}).count() == 0
