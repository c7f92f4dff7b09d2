from __future__ import annotations

import math
from datetime import datetime

from lakestrata.operators import clean

from rows import event, events, tuples


def test_rows_without_a_required_value_are_dropped(spark):
    df = events(
        spark,
        event(0),
        event(None),
        event(2, user_id=None),
        event(3, event_timestamp=None),
        event(4, event_type=None),
        event(5, region=None),
        event(6, product_id=None),
    )
    assert [r.event_id for r in clean(df).orderBy("event_id").collect()] == [0, 5, 6]


def test_price_and_quantity_must_be_positive(spark):
    df = events(
        spark,
        event(0, price=0.01),
        event(1, price=0.0),
        event(2, price=-1.0),
        event(3, price=None),
        event(4, quantity=0),
        event(5, quantity=-1),
        event(6, quantity=None),
        event(7, price=math.nan),
    )
    assert [r.event_id for r in clean(df).orderBy("event_id").collect()] == [0, 7]


def test_canonical_types(spark):
    raw = events(spark, event(0)).selectExpr(
        "event_id", "user_id", "event_timestamp", "event_type", "product_id",
        "cast(price as float) price", "cast(quantity as tinyint) quantity", "region",
    )
    types = dict(clean(raw).dtypes)
    assert (types["event_timestamp"], types["price"], types["quantity"]) == (
        "timestamp", "double", "int",
    )
    kept = clean(raw, timestamp_type="timestamp_ntz")
    assert tuples(kept, "event_timestamp") == [(datetime(2024, 1, 1, 12),)]
    assert dict(kept.dtypes)["event_timestamp"] == "timestamp_ntz"
