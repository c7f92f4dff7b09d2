from __future__ import annotations

import glob
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakestrata.functions import exact_sum, revenue
from lakestrata.plans import run_jobs, run_pipeline
from lakestrata.plans.queries import corrected
from lakestrata.sources import (
    first_rows,
    key_bound,
    raw_tables,
    read_table,
    run_folder,
    scan,
    write_table,
)

from rows import event, events, tuples

PRODUCTS = "product_id int, category string, base_price double"


def many_events(spark, n=60):
    return events(
        spark,
        *(
            event(
                i,
                region=["north", "south", "east"][i % 3],
                event_type=["purchase", "view"][i % 2],
                product_id=i % 5,
                price=i + 0.5,
                quantity=i % 4 + 1,
            )
            for i in range(n)
        ),
    )


def test_files_by_glob_pattern(spark, tmp_path):
    df = many_events(spark)
    for part in range(3):
        chunk = df.filter(f"event_id % 3 = {part}").coalesce(1)
        write_table(chunk, str(tmp_path / f"events_{part}.parquet"))
    write_table(df, str(tmp_path / "other.parquet"))
    assert tuples(scan(spark, str(tmp_path / "events_*.parquet"))) == tuples(df)


def test_raw_folder_through_the_pipeline(spark, tmp_path):
    raw = tmp_path / "raw"
    df = many_events(spark).withColumn("quantity", F.col("quantity").cast("tinyint"))
    for part in range(2):
        write_table(df.filter(f"event_id % 2 = {part}"), str(raw / f"events_{part}.parquet"))
    users = spark.createDataFrame([(1, 30, "north")], "user_id int, age tinyint, region string")
    products = spark.createDataFrame([(i, "abc"[i % 3], float(i)) for i in range(4)], PRODUCTS)
    write_table(users, str(raw / "users.parquet"))
    write_table(products, str(raw / "products.parquet"))

    events_read, dimensions = raw_tables(spark, str(raw))
    tables = run_pipeline(spark, events_read, dimensions, str(tmp_path / "out"))
    assert {n: scan(spark, p).count() for n, p in tables.bronze_dimensions.items()} == {
        "users": 1, "products": 4,
    }
    current = tables.silver.current()
    assert dict(current.dtypes)["quantity"] == "int"
    assert dict(current.dtypes)["event_timestamp"] == "timestamp"
    assert current.count() == 60
    rows = [tuple(r) for r in tables.silver.history().drop("committed_at").collect()]
    assert rows == [(0, "WRITE", 60), (1, "EVOLVE", 60)]


def test_region_folders_and_partition_discovery(spark, tmp_path):
    path = str(tmp_path / "bronze")
    df = many_events(spark)
    write_table(df, path, partition_by=["region"])
    folders = {Path(p).name for p in glob.glob(f"{path}/region=*")}
    assert folders == {"region=north", "region=south", "region=east"}
    back = scan(spark, path)
    assert set(back.columns) == set(df.columns)
    assert tuples(back, *df.columns) == tuples(df)


def test_partitioned_write_without_adaptive_execution(spark, tmp_path):
    path = str(tmp_path / "bronze")
    plain = spark.newSession()
    plain.conf.set("spark.sql.adaptive.enabled", "false")
    df = many_events(plain)
    write_table(df, path, partition_by=["region"])
    assert scan(plain, path).count() == 60


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_formats_keep_every_row(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    df = many_events(spark)
    write_table(df, path, fmt)
    write_table(df, path, fmt)  # overwrites, does not add
    back = read_table(spark, path, fmt)
    assert tuples(back, *df.columns) == tuples(df)
    plan = back.filter("region = 'north'")._jdf.queryExecution().toString()
    assert "EqualTo(region,north)" in plan


@pytest.mark.parametrize("n", [1, 3, 17, 60, 100])
def test_first_rows_are_the_smallest_keys(spark, n):
    # Clustered keys, far apart, also below zero, and a row without a key.
    keys = [-(10**15), *range(0, 40), *range(10**6, 10**6 + 10), *range(10**15, 10**15 + 9)]
    df = events(spark, event(None), *(event(k) for k in keys)).repartition(5, "event_id")
    found = sorted(r.event_id for r in first_rows(df, n, "event_id").collect())
    assert found == sorted(keys)[:n]


def test_first_rows_bound_reaches_the_scan(spark, tmp_path):
    write_table(many_events(spark), str(tmp_path / "t"))
    stored = scan(spark, str(tmp_path / "t"))
    bound = key_bound(stored, 5, "event_id")
    sample = first_rows(stored, 5, "event_id")
    assert f"LessThanOrEqual(event_id,{bound})" in sample._jdf.queryExecution().toString()


@pytest.mark.parametrize("far", [0, 10**18])
def test_few_rows_pass_the_bound_beside_an_outlier(spark, far):
    crowd = spark.range(10**15, 10**15 + 200_000).select(F.col("id").alias("k"))
    keys = crowd.unionByName(spark.range(far, far + 1).select(F.col("id").alias("k")))
    bound = key_bound(keys, 50, "k")
    assert 50 <= keys.filter(F.col("k") <= bound).count() <= 200
    assert first_rows(keys, 50, "k").count() == 50
    assert key_bound(keys.limit(0), 50, "k") is None


@pytest.mark.parametrize("n", [50, 1000])
@pytest.mark.parametrize("kind", ["even", "outliers", "crowded"])
def test_bound_takes_two_passes(spark, monkeypatch, n, kind):
    ids = spark.range(0, 300_000)
    key = {
        "even": F.col("id") * 7,
        "outliers": F.when(F.col("id") < 5, -(10**18) + F.col("id")).otherwise(10**17 + F.col("id")),
        "crowded": F.when(F.col("id") % 3 == 0, 10).otherwise(F.col("id") + 11),
    }[kind]
    keys = ids.select(key.cast("bigint").alias("k"))
    DataFrame = type(keys)
    passes, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: passes.append(1) or collect(df))
    bound = key_bound(keys, n, "k")
    assert len(passes) == 2
    monkeypatch.undo()
    count = keys.filter(F.col("k") <= bound).count()
    if kind == "crowded":
        assert bound == 10 and count == 100_000
    else:
        assert n <= count <= 4 * n


def test_run_folder_is_fresh_and_in_the_shared_folder(spark):
    first, second = run_folder(spark, "x"), run_folder(spark, "x")
    assert first != second
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert first.startswith((shared or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/"))


@pytest.mark.parametrize(
    "master, warehouse, fine",
    [
        ("local[4]", "/tmp/w", True), ("local", "file:/tmp/w", True), ("yarn", "hdfs://a/w", True),
        ("yarn", "file:/tmp/w", False), ("spark://a:7077", "/tmp/w", False),
    ],
)
def test_run_folder_on_a_cluster_is_not_a_machines_own(master, warehouse, fine):
    class Session:
        sparkContext = type("Context", (), {"master": master})
        conf = type(
            "Conf",
            (),
            {"get": staticmethod(lambda k, d=None: d if k == "spark.checkpoint.dir" else warehouse)},
        )

    if fine:
        assert run_folder(Session, "x").startswith(f"{warehouse}/lakestrata/x-")
    else:
        with pytest.raises(ValueError, match="checkpoint"):
            run_folder(Session, "x")


def test_pipeline_layers(spark, tmp_path):
    raw = many_events(spark).unionByName(events(spark, event(900, price=0.0), event(901, user_id=None)))
    products = spark.createDataFrame([(i, "abc"[i % 3], float(i)) for i in range(4)], PRODUCTS)
    late = corrected(many_events(spark)).unionByName(corrected(events(spark, event(950, price=0.0))))
    tables = run_pipeline(spark, raw, {"products": products}, str(tmp_path), late=late)
    assert scan(spark, tables.bronze_events).count() == 62
    assert tables.silver.as_of(0).count() == 60
    current = tables.silver.current()
    assert current.count() == current.filter("discount = 0.1").count() == 60
    assert set(tables.gold) == {
        "revenue_by_region_type", "daily_event_counts", "top_products", "rolling_revenue",
    }
    wanted = sum(round((i + 0.5) * 0.9 * (i % 4 + 1), 4) for i in range(60))
    revenue_table = tables.gold["revenue_by_region_type"].current()
    assert revenue_table.selectExpr("sum(total_revenue)").first()[0] == pytest.approx(wanted)
    assert revenue_table.selectExpr("sum(event_count)").first()[0] == 60
    assert tables.gold["top_products"].current().count() == 5


def test_pipeline_without_late_rows_changes_no_price(spark, tmp_path):
    raw = many_events(spark)
    products = spark.createDataFrame([(i, "abc"[i % 3], float(i)) for i in range(4)], PRODUCTS)
    silver = run_pipeline(spark, raw, {"products": products}, str(tmp_path)).silver.current()
    assert tuples(silver, "event_id", "price") == tuples(raw, "event_id", "price")
    assert silver.filter("discount IS NOT NULL").count() == 0


def test_job_outputs_and_untouched_session(spark, tmp_path):
    names = ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(n) for n in names]
    df = many_events(spark)
    products = spark.createDataFrame([(i, "abc"[i % 3], float(i)) for i in range(4)], PRODUCTS)
    folders = run_jobs(df, products, str(tmp_path))
    assert [spark.conf.get(n) for n in names] == before
    stored = {name: scan(spark, path) for name, path in folders.items()}
    assert tuples(stored["categories_by_broadcast"]) == tuples(
        stored["categories_by_shuffle"]
    )
    assert stored["region_types"].count() == 6
    assert stored["ranked_days"].columns == [
        "region", "date", "daily_revenue", "rolling_7d_revenue", "rank_in_day",
    ]
    widths = [tuples(stored[f"users_in_{n}_ranges"]) for n in (2, 4, 8)]
    assert widths[0] == widths[1] == widths[2]
    total = df.agg(exact_sum(revenue())).first()[0]
    assert stored["region_types"].selectExpr("sum(total_revenue)").first()[0] == total
