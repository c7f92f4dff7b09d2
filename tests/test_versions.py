from __future__ import annotations

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import merge_upsert
from lakestrata.plans.pipeline import evolve_with_discount
from lakestrata.sources import VersionedTable

from rows import event, events, tuples


@pytest.fixture
def versioned(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "events"))


def some_events(spark, n=20):
    return events(spark, *(event(i, region=["north", "south"][i % 2]) for i in range(n)))


def test_first_version_keeps_columns_and_rows(spark, versioned):
    df = some_events(spark)
    assert versioned.overwrite(df, partition_by=["region"]) == 0
    assert versioned.current().columns == df.columns
    assert versioned.current().dtypes == df.dtypes
    assert tuples(versioned.current()) == tuples(df)


def test_each_version_keeps_its_own_schema(spark, versioned):
    df = some_events(spark)
    versioned.overwrite(df, partition_by=["region"])
    evolve_with_discount(versioned)
    batch = versioned.current().limit(3).withColumn("discount", F.lit(0.1))
    versioned.overwrite(merge_upsert(versioned.current(), batch, "event_id"), "MERGE")
    assert "discount" not in versioned.as_of(0).columns
    assert versioned.as_of(1).filter("discount is not null").count() == 0
    assert versioned.as_of(2).filter("discount is not null").count() == 3
    assert versioned.current().count() == 20
    assert tuples(versioned.as_of(0)) == tuples(df)


def test_append_adds_rows_and_keeps_the_past(spark, versioned):
    df = some_events(spark, 50)
    versioned.overwrite(df, partition_by=["region"])
    extra = versioned.current().limit(25).withColumn("discount", F.lit(0.5))
    assert versioned.append(extra, partition_by=["region"]) == 1
    assert versioned.as_of(0).count() == 50
    current = versioned.current()
    assert current.count() == 75
    assert current.filter("discount is null").count() == 50
    assert current.filter("region = 'north'").count() + current.filter(
        "region = 'south'"
    ).count() == 75


def test_added_column_copies_no_rows(spark, versioned):
    versioned.overwrite(some_events(spark), partition_by=["region"])
    written = set(Path(versioned.root).glob("data/**/*.parquet"))
    versioned.add_column("discount", "double")
    assert set(Path(versioned.root).glob("data/**/*.parquet")) == written
    assert dict(versioned.current().dtypes)["discount"] == "double"
    with pytest.raises(ValueError, match="already"):
        versioned.add_column("discount", "double")


def test_append_after_added_column(spark, versioned):
    versioned.overwrite(some_events(spark, 4))
    versioned.add_column("discount", "double")
    versioned.append(some_events(spark, 3).withColumn("note", F.lit("x")))
    current = versioned.current()
    assert current.columns[-2:] == ["discount", "note"]
    assert current.filter("discount is null").count() == 7
    assert current.filter("note = 'x'").count() == 3


def test_append_to_nothing_is_version_zero(spark, versioned):
    assert versioned.append(some_events(spark)) == 0


def test_merge_after_merge(spark, versioned):
    df = events(spark, *(event(i, region=f"region {i % 5}") for i in range(100)))
    versioned.overwrite(df, partition_by=["region"])
    versioned.add_column("discount", "double")
    batch = (
        versioned.current()
        .filter("event_id in (3, 8)")
        .withColumns({"price": F.lit(1.0), "discount": F.lit(0.1)})
        .unionByName(
            versioned.current().filter("event_id = 4").withColumn("event_id", F.lit(1000).cast("bigint"))
        )
    )
    before = set(Path(versioned.root).glob("data/**/*.parquet"))
    versioned.merge(batch, "event_id", partition_by=["region"])
    new = set(Path(versioned.root).glob("data/**/*.parquet")) - before
    assert spark.read.parquet(*map(str, new)).count() == 3
    current = versioned.current()
    assert current.count() == current.select("event_id").distinct().count() == 101
    assert tuples(current.filter("discount = 0.1"), "event_id", "price") == [(3, 1.0), (8, 1.0)]
    assert tuples(versioned.as_of(0)) == tuples(df)
    assert versioned.as_of(1).count() == 100

    # A second merge into rows of both folders, then a key that is nowhere.
    batch = versioned.current().filter("event_id in (3, 50)").withColumn("price", F.lit(2.0))
    versioned.merge(batch, "event_id", partition_by=["region"])
    versioned.merge(batch.withColumn("event_id", F.col("event_id") + 2000), "event_id")
    versioned.append(some_events(spark, 2).withColumn("event_id", F.col("event_id") + 5000))
    current = versioned.current()
    assert current.count() == current.select("event_id").distinct().count() == 105
    assert tuples(current.filter("price = 2.0"), "event_id") == [(2003,), (2050,), (3,), (50,)]
    assert [r.n_rows for r in versioned.history().collect()] == [100, 100, 101, 101, 103, 105]
    versioned.overwrite(versioned.current())
    assert len(versioned._record()["folders"]) == 1
    assert tuples(versioned.current()) == tuples(versioned.as_of(5))


def test_merge_by_null_and_several_keys(spark, versioned):
    df = events(spark, event(1), event(None), event(2, user_id=None))
    versioned.overwrite(df)
    batch = events(spark, event(None, price=9.0), event(1, price=9.0), event(2, user_id=None, price=9.0))
    versioned.merge(batch, ["event_id", "user_id"])
    found = sorted((str(r.event_id), r.price == 9.0) for r in versioned.current().collect())
    assert found == [
        ("1", True), ("2", False), ("2", True), ("None", False), ("None", True),
    ]
    assert versioned.history().orderBy(F.desc("version")).first().n_rows == 5


def test_record_does_not_grow_with_files_and_no_path_is_shuffled(spark, versioned):
    df = events(spark, *(event(i, region=f"r{i % 5}") for i in range(100)))
    versioned.overwrite(df.repartition(10), partition_by=["region"])
    versioned.merge(versioned.current().withColumn("price", F.lit(1.0)), "event_id")
    record = versioned._record()
    assert [sorted(f.asDict()) for f in record["folders"]] == [["columns", "keys", "path"]] * 2
    assert record["n_rows"] == 100
    plan = versioned.current()._jdf.queryExecution().toString()
    assert "file_path" not in plan and "_metadata" not in plan


@pytest.mark.parametrize(
    "change",
    [
        lambda df: df.withColumn("price", F.current_date()),
        lambda df: df.withColumn("price", F.lit("abc")),
        lambda df: df.withColumn("quantity", F.col("quantity").cast("bigint")),
        lambda df: df.withColumn("event_id", F.col("event_id").cast("double")),
    ],
)
def test_append_refuses_what_it_cannot_keep(spark, versioned, change):
    versioned.overwrite(some_events(spark))
    written = set(Path(versioned.root).glob("data/*"))
    with pytest.raises(ValueError, match="in the table"):
        versioned.append(change(some_events(spark)))
    assert versioned.latest_version() == 0
    assert set(Path(versioned.root).glob("data/*")) == written
    assert versioned.current().count() == 20


def test_append_casts_and_names_as_the_session_does(spark, versioned):
    versioned.overwrite(some_events(spark))
    narrow = some_events(spark, 3).withColumn("price", F.lit(5).cast("int"))
    versioned.append(narrow.withColumnRenamed("price", "Price").withColumn("note", F.lit("x")))
    current = versioned.current()
    assert current.columns == [*some_events(spark).columns, "note"]
    assert dict(current.dtypes)["price"] == "double"
    assert current.filter("price = 5").count() == 3
    with pytest.raises(ValueError, match="already"):
        versioned.add_column("Price", "double")
    assert versioned.latest_version() == 1


def test_two_batch_rows_for_one_key_raise(spark, versioned):
    versioned.overwrite(some_events(spark))
    batch = versioned.current().filter("event_id = 3")
    with pytest.raises(ValueError, match="several"):
        versioned.merge(batch.unionByName(batch), "event_id")
    assert versioned.latest_version() == 0


def test_history_and_diff(spark, versioned):
    versioned.overwrite(some_events(spark, 10))
    evolve_with_discount(versioned)
    versioned.append(some_events(spark, 4))
    rows = [tuple(r) for r in versioned.history().drop("committed_at").collect()]
    assert rows == [(0, "WRITE", 10), (1, "EVOLVE", 10), (2, "APPEND", 14)]
    diff = {r.version: (r.n_rows, r.n_cols) for r in versioned.diff(0, 2).collect()}
    assert diff == {0: (10, 8), 2: (14, 9)}


def test_folder_without_a_record_is_invisible(spark, versioned):
    versioned.overwrite(some_events(spark, 5))
    some_events(spark, 7).write.parquet(f"{versioned.root}/data/v000001-lost")
    assert versioned.latest_version() == 0
    assert versioned.current().count() == 5
    assert versioned.overwrite(some_events(spark, 6)) == 1
    assert versioned.current().count() == 6


def test_unknown_versions_raise(spark, versioned):
    assert versioned.latest_version() is None
    with pytest.raises(ValueError):
        versioned.current()
    with pytest.raises(ValueError):
        versioned.history()
    versioned.overwrite(some_events(spark, 5))
    with pytest.raises(ValueError):
        versioned.as_of(1)


def test_partition_values_keep_their_type(spark, versioned):
    df = events(spark, event(0, region="07"), event(1, region=None), event(2, region="2024-01-01"))
    versioned.overwrite(df, partition_by=["region"])
    assert tuples(versioned.current(), "event_id", "region") == [
        (0, "07"), (1, None), (2, "2024-01-01"),
    ]


def joins_and_scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    return len(re.findall(r"HashJoin|SortMergeJoin|NestedLoopJoin", plan)), plan.count("FileScan")


def test_ten_merges_are_read_by_one_join(spark, versioned):
    """Random merges, appends and new columns against rows kept in Python."""
    rng = random.Random(7)
    rows = [(i, float(i), f"k{i % 9}") for i in range(60)] + [(None, -1.0, None)]
    schema = "id bigint, price double, code string"
    versioned.overwrite(spark.createDataFrame(rows, schema))
    wanted = [sorted(rows, key=repr)]
    for step in range(10):
        batch = {rng.randrange(80): float(100 * step + i) for i in range(rng.randint(1, 12))}
        new = [(k, v, None if step % 3 else f"k{k}") for k, v in batch.items()]
        new += [(None, float(step), "no key")] * (step % 2)
        versioned.merge(spark.createDataFrame(new, schema), "ID" if step % 2 else "id")
        rows = [r for r in rows if r[0] not in batch or r[0] is None] + new
        wanted.append(sorted(rows, key=repr))
        if step % 4 == 1:
            more = [(rng.randrange(80), -float(step), "again") for _ in range(3)]
            versioned.append(spark.createDataFrame(more, schema))
            rows = rows + more
            wanted.append(sorted(rows, key=repr))
    for version, expected in enumerate(wanted):
        found = [tuple(r) for r in versioned.as_of(version).collect()]
        assert sorted(found, key=repr) == expected
    assert [r.n_rows for r in versioned.history().collect()] == [len(r) for r in wanted]
    n_joins, n_scans = joins_and_scans(versioned.current())
    assert n_joins == 1
    assert n_scans <= len(wanted) + 10
    assert joins_and_scans(versioned.current().filter("price > 3").select("id"))[0] == 1


def test_merges_by_different_keys(spark, versioned):
    schema = "a int, b int, v int"
    versioned.overwrite(spark.createDataFrame([(1, 1, 0), (1, 2, 0), (2, 2, 0), (3, None, 0)], schema))
    versioned.merge(spark.createDataFrame([(1, 9, 1)], schema), "a")
    versioned.merge(spark.createDataFrame([(2, 2, 2), (3, None, 2)], schema), ["b", "a"])
    versioned.merge(spark.createDataFrame([(5, 9, 3), (6, 2, 3)], schema), "b")
    versioned.merge(spark.createDataFrame([(3, 3, 4)], schema), "a")
    assert tuples(versioned.current()) == [(3, 3, 4), (5, 9, 3), (6, 2, 3)]
    assert tuples(versioned.as_of(2)) == [(1, 9, 1), (2, 2, 2), (3, None, 0), (3, None, 2)]
    assert joins_and_scans(versioned.current())[0] == 3


def test_columns_named_like_the_folder_number(spark, versioned):
    df = spark.createDataFrame([(1, 10), (2, 20)], "id int, _folder_last int")
    versioned.overwrite(df)
    versioned.merge(spark.createDataFrame([(2, 21)], df.schema), "id")
    assert versioned.current().columns == df.columns
    assert tuples(versioned.current()) == [(1, 10), (2, 21)]


def test_merge_refuses_what_it_cannot_keep(spark, versioned):
    versioned.overwrite(spark.createDataFrame([(1, 5)], "id int, q int"))
    written = set(Path(versioned.root).glob("data/*"))
    for batch in (
        spark.createDataFrame([(1, 7.9)], "id int, q double"),
        spark.createDataFrame([(1, 7)], "id int, q bigint"),
        spark.createDataFrame([(1, "7")], "id int, q string"),
    ):
        with pytest.raises(ValueError, match="in the target"):
            versioned.merge(batch, "id")
        with pytest.raises(ValueError, match="in the target"):
            merge_upsert(versioned.current(), batch, "id")
    assert versioned.latest_version() == 0
    assert set(Path(versioned.root).glob("data/*")) == written
    versioned.merge(spark.createDataFrame([(1, 7)], "ID smallint, Q smallint"), "Id")
    assert versioned.current().dtypes == [("id", "int"), ("q", "int")]
    assert tuples(versioned.current()) == [(1, 7)]


def test_region_filter_prunes_folders(spark, versioned):
    versioned.overwrite(some_events(spark), partition_by=["region"])
    plan = versioned.current().filter("region = 'north'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(region" in plan


def test_region_filter_prunes_folders_of_merges(spark, versioned):
    versioned.overwrite(some_events(spark), partition_by=["region"])
    versioned.merge(some_events(spark, 4), "event_id", partition_by=["region"])
    plan = versioned.current().filter("region = 'north'")._jdf.queryExecution().toString()
    assert plan.split("Physical Plan")[1].count("PartitionFilters: [isnotnull(region") == 2


def test_empty_table(spark, versioned):
    versioned.overwrite(some_events(spark).limit(0), partition_by=["region"])
    assert versioned.current().count() == 0
    assert len(versioned.current().columns) == 8
