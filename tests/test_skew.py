"""Queries over inputs in which single keys hold a third of all rows."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract

from comparison import connect, differences

FILES = 6
SOURCE = "/root/testdata/sf0.001"

# One order, product and day hold a third of the order lines; one user and one
# product a third of the events; one user a third of the orders.
SKEWED = {
    "lineitem": """SELECT * REPLACE (
        CASE WHEN rn % 3 = 0 THEN (SELECT MIN(o_orderkey) FROM orders) ELSE l_orderkey END
          AS l_orderkey,
        CASE WHEN rn % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey,
        CASE WHEN rn % 3 = 2 THEN TIMESTAMP '1996-05-05' ELSE l_shipdate END AS l_shipdate)
        FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey) AS rn
              FROM lineitem)""",
    "orders": """SELECT * REPLACE (
        CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey) FROM orders""",
    "events": """SELECT * REPLACE (
        CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id,
        CASE WHEN event_id % 3 = 1 THEN '{"k": 7}' ELSE props END AS props) FROM events""",
}

NAMES = [
    "agg_region_type_stats",
    "append_version",
    "category_revenue_broadcast",
    "category_revenue_shuffle",
    "daily_event_counts",
    "grand_totals",
    "late_upsert_insert",
    "path_summary",
    "rank_in_day",
    "rolling_revenue",
    "score_by_region",
    "top_products",
    "user_region_revenue",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "part", "orders", "lineitem", "events"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SOURCE}/{name}.parquet'")
        rows = SKEWED.get(name, f"SELECT * FROM {name}")
        columns = ", ".join(
            c[0] for c in connection.execute(f"SELECT * FROM {name} LIMIT 0").description
        )
        (folder / f"{name}.parquet").mkdir()
        for part in range(FILES if name in SKEWED else 1):
            # Several files, hence several map tasks: a partition is split by them.
            chosen = f"hash({columns}) % {FILES} = {part}" if name in SKEWED else "true"
            connection.execute(
                f"COPY (SELECT {columns} FROM ({rows}) WHERE {chosen}) "
                f"TO '{folder}/{name}.parquet/part{part}.parquet' (FORMAT parquet)"
            )
    return str(folder)


@pytest.fixture(scope="module")
def splitting(spark):
    """A session in which adaptive execution splits even small crowded partitions."""
    session = spark.newSession()
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "4000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }.items():
        session.conf.set(name, value)
    return session


@pytest.mark.parametrize("name", NAMES)
def test_crowded_keys_change_no_result(splitting, skewed, name):
    result = contract.queries()[name](splitting, skewed)
    assert differences(result, connect(skewed), contract.oracle_sql()[name]) is None


def test_the_inputs_are_crowded(skewed):
    database = connect(skewed)
    for table, key in (("lineitem", "l_orderkey"), ("lineitem", "l_partkey"), ("events", "user_id")):
        largest, rows = database.execute(
            f"SELECT MAX(n), SUM(n) FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {key})"
        ).fetchall()[0]
        assert largest >= rows // 3


@pytest.mark.parametrize("name", ["score_by_region", "agg_region_type_stats"])
def test_crowded_join_keys_are_split(splitting, skewed, name):
    result = contract.queries()[name](splitting, skewed)
    result.collect()
    final = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final
