from __future__ import annotations

import pytest

from lakestrata.operators import merge_upsert

from rows import tuples

SCHEMA = "id bigint, price double, note string"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_match_insert_and_null_values(spark):
    target = table(spark, (1, 1.0, "old"), (2, 2.0, "old"), (3, 3.0, "old"))
    source = table(spark, (2, None, "new"), (9, 9.0, None))
    assert tuples(merge_upsert(target, source, "id")) == [
        (1, 1.0, "old"), (2, None, "new"), (3, 3.0, "old"), (9, 9.0, None),
    ]


def test_a_source_row_of_nulls_still_replaces(spark):
    target = table(spark, (1, 1.0, "old"))
    assert tuples(merge_upsert(target, table(spark, (1, None, None)), "id")) == [(1, None, None)]


def test_null_keys_match_nothing(spark):
    target = table(spark, (None, 1.0, "old"), (1, 1.0, "old"))
    source = table(spark, (None, 5.0, "new"), (None, 6.0, "new"))
    assert tuples(merge_upsert(target, source, "id")) == [
        (1, 1.0, "old"), (None, 1.0, "old"), (None, 5.0, "new"), (None, 6.0, "new"),
    ]


def test_every_target_row_with_the_key_is_replaced(spark):
    target = table(spark, (1, 1.0, "a"), (1, 2.0, "b"), (2, 2.0, "c"))
    source = table(spark, (1, 7.0, "new"))
    assert tuples(merge_upsert(target, source, "id")) == [
        (1, 7.0, "new"), (1, 7.0, "new"), (2, 2.0, "c"),
    ]


def test_two_source_rows_for_one_target_row_raise(spark):
    target = table(spark, (1, 1.0, "old"))
    with pytest.raises(ValueError, match="several source rows"):
        merge_upsert(target, table(spark, (1, 2.0, "a"), (1, 3.0, "b")), "id")


def test_repeated_new_keys_are_all_added(spark):
    target = table(spark, (1, 1.0, "old"))
    source = table(spark, (5, 2.0, "a"), (5, 3.0, "b"))
    assert merge_upsert(target, source, "id").count() == 3


def test_source_must_have_the_target_columns(spark):
    target = table(spark, (1, 1.0, "old"))
    with pytest.raises(ValueError, match="note"):
        merge_upsert(target, target.drop("note"), "id")


def test_source_taken_from_the_target_itself(spark):
    target = table(spark, *((i, float(i), "old") for i in range(50)))
    late = target.orderBy("id").limit(5).selectExpr("price * 0.5 price", "id", "note", "1 extra")
    merged = merge_upsert(target, late, "id")
    assert merged.columns == target.columns
    assert merged.count() == 50
    assert merged.selectExpr("sum(price)").first()[0] == sum(range(50)) - sum(range(5)) / 2


def test_key_of_two_columns(spark):
    target = table(spark, (1, 1.0, "a"), (1, 1.0, "b"))
    source = table(spark, (1, 5.0, "b"), (1, 6.0, "c"))
    assert tuples(merge_upsert(target, source, ["id", "note"])) == [
        (1, 1.0, "a"), (1, 5.0, "b"), (1, 6.0, "c"),
    ]


def test_crowded_key_against_brute_force(spark):
    rows = [(7 if i % 3 == 0 else i, float(i), "old") for i in range(300)]
    batch = [(i, -1.0, "new") for i in range(0, 400, 7)]
    fresh = {key: row for key, *_ in batch for row in [(key, -1.0, "new")]}
    known = {r[0] for r in rows}
    wanted = [fresh.get(r[0], r) for r in rows] + [r for r in batch if r[0] not in known]
    merged = merge_upsert(table(spark, *rows), table(spark, *batch), "id")
    assert tuples(merged) == sorted(wanted, key=repr)
