"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import category_revenue, count_keys, merge_upsert, scans, top_products
from lakestrata.plans import QUERIES, views
from lakestrata.sources import scan, write_table

from rows import event, events

SF_DIR = "/root/testdata/sf0.001"
PRODUCTS = "product_id int, category string, base_price double"


@pytest.fixture
def cautious(spark):
    """A session that broadcasts by itself only what has a few kilobytes."""
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")
    session.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "4000")
    return session


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


READ_ONLY = [
    "clean_sales",
    "revenue_by_region_type",
    "agg_region_type_stats",
    "daily_event_counts",
    "top_products",
    "user_region_revenue",
    "grand_totals",
    "category_revenue_broadcast",
    "category_revenue_shuffle",
    "rolling_revenue",
    "rank_in_day",
    "region_features",
    "score_by_region",
    "path_summary",
]


@pytest.mark.parametrize("name", READ_ONLY)
def test_no_product_of_tables_and_no_python(cautious, name):
    text = plan(QUERIES[name](cautious, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in text


def test_fact_table_is_never_the_broadcast_side(spark):
    text = plan(views.sales(spark, SF_DIR))
    assert "SortMergeJoin [order_id" in text
    assert "SortMergeJoin [user_id" in text
    assert "BuildLeft" not in text
    assert "BuildLeft" not in plan(views.events(spark, SF_DIR))


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["daily_event_counts"](spark, SF_DIR))
    assert "struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in text
    assert "EqualTo(l_returnflag,R)" in plan(QUERIES["top_products"](spark, SF_DIR))


def test_join_strategy_follows_the_request(cautious):
    df = events(cautious, event(0), event(1, product_id=2))
    products = cautious.createDataFrame([(1, "a", 1.0)], PRODUCTS)
    assert "BroadcastHashJoin" in plan(category_revenue(df, products, "broadcast"))
    for other in (
        category_revenue(df, products, "shuffle"),
        category_revenue(df, products, "broadcast", max_broadcast_bytes=1),
    ):
        assert "SortMergeJoin" in plan(other)
        assert "BroadcastHashJoin" not in plan(other)


def test_top_products_aggregates_once(cautious):
    df = events(cautious, *(event(i, product_id=i % 20) for i in range(40)))
    products = cautious.createDataFrame([(i, "a", 1.0) for i in range(30)], PRODUCTS)
    result = top_products(df, products)
    result.collect()
    final = plan(result).split("Initial Plan")[0]
    assert "ReusedExchange" in final
    assert "TakeOrderedAndProject" in final


def test_small_stored_batch_does_not_shuffle_the_target(spark, tmp_path):
    path = str(tmp_path)
    write_table(events(spark, *(event(i) for i in range(100))), f"{path}/target")
    write_table(events(spark, event(5, price=1.0), event(500)), f"{path}/batch")
    merged = merge_upsert(scan(spark, f"{path}/target"), scan(spark, f"{path}/batch"), "event_id")
    text = plan(merged)
    assert "SortMergeJoin" not in text
    # The one shuffle is that of the matched keys, which are no more than the batch.
    assert text.count("Exchange hashpartitioning") == 1


def test_keys_are_counted_in_tasks_of_a_fixed_size(spark, monkeypatch):
    monkeypatch.setattr(scans, "KEYS_A_TASK", 100)
    rows = spark.range(1000).selectExpr("id % 700 AS a", "nullif(id % 7, 3) AS b")
    counted = count_keys(rows, "a", "b")
    assert "REPARTITION_BY_NUM" in plan(counted) and ", 11)" in plan(counted)
    assert counted.first().n_keys == 600
    assert count_keys(rows.filter("a < 0"), "a", "b").first().n_keys == 0
    # Two distinct counts in one pass would copy every row and hold all keys of a scan.
    assert "Expand" not in plan(QUERIES["format_roundtrip"](spark, SF_DIR))


def test_crowded_key_is_split_in_the_merge(spark, tmp_path):
    session = spark.newSession()
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }.items():
        session.conf.set(name, value)
    rows = session.range(0, 60000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    write_table(rows, str(tmp_path / "target"))
    batch = session.range(0, 70000, 7).select("id", F.lit("new").alias("note"))
    write_table(batch, str(tmp_path / "batch"))
    merged = merge_upsert(
        scan(session, str(tmp_path / "target")), scan(session, str(tmp_path / "batch")), "id"
    )
    assert len(merged.collect()) == 60000 + batch.join(rows, "id", "left_anti").count()
    assert "SortMergeJoin(skew=true)" in plan(merged).split("Initial Plan")[0]
