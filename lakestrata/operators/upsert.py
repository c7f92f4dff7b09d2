"""Keyed merge of a batch into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions import keeps_all, name_rule


def merge_upsert(target: DataFrame, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``target`` after ``source`` is merged in by ``key``.

    A target row whose key is in the source is replaced by the source row, NULLs
    included; a source row whose key is not in the target is added; a NULL key
    matches nothing. Two source rows for one target row raise ValueError, as does a
    source column of another type than the target's unless the cast loses nothing.
    Columns that the target lacks are left out.

    The target takes part in left joins only, so it is never shuffled for a
    small batch (which Spark broadcasts by its size) and a crowded target key
    can be split by adaptive execution for a large one. Give a batch that is
    stored, not one that is costly to compute: it is read several times.
    """
    same = name_rule(target.sparkSession)
    names = {same(c): c for c in target.columns}
    keys = [names.get(same(k), k) for k in ([key] if isinstance(key, str) else key)]
    incoming = as_target_rows(source, target.schema)
    reject_ambiguous(target, incoming, keys)

    # The row travels as one struct: it is NULL exactly where no key matched,
    # even if the key or every value of the source row is NULL.
    rows = incoming.select(
        *(F.col(k).alias(f"_key_{k}") for k in keys),
        F.struct(*target.columns).alias("_incoming"),
    )
    same_key = [F.col(k) == F.col(f"_key_{k}") for k in keys]
    replaced = target.join(rows, same_key, "left").select(
        *(
            F.when(F.col("_incoming").isNotNull(), F.col(f"_incoming.{c}"))
            .otherwise(F.col(c))
            .alias(c)
            for c in target.columns
        )
    )
    known = target.select(*keys).join(incoming.select(*keys), keys, "left_semi").distinct()
    added = incoming.join(known, keys, "left_anti")
    return replaced.unionByName(added)


def as_target_rows(source: DataFrame, columns: StructType) -> DataFrame:
    """The source with the columns and types of the target, names compared as the
    session does. ValueError if one is absent or there twice, or if a cast could
    change a value."""
    same = name_rule(source.sparkSession)
    given: dict[str, StructField] = {}
    known = {same(name) for name in columns.names}
    for field in source.schema.fields:
        if same(field.name) in given and same(field.name) in known:
            raise ValueError(f"source has column {field.name} twice")
        given[same(field.name)] = field
    absent = [c for c in columns.names if same(c) not in given]
    if absent:
        raise ValueError(f"source lacks target columns: {', '.join(absent)}")
    picked = []
    for into in columns.fields:
        field = given[same(into.name)]
        if not keeps_all(field.dataType, into.dataType):
            raise ValueError(
                f"column {field.name} is {field.dataType.simpleString()}, in the target "
                f"{into.dataType.simpleString()}"
            )
        picked.append(F.col(f"`{field.name}`").cast(into.dataType).alias(into.name))
    return source.select(*picked)


def reject_ambiguous(target: DataFrame, source: DataFrame, keys: list[str]) -> None:
    """ValueError if several source rows match one target row."""
    repeated = (
        source.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .filter(F.col("_copies") > 1)
        .select(*keys)
    )
    if repeated.isEmpty():
        return
    if not target.select(*keys).join(repeated, keys, "left_semi").isEmpty():
        raise ValueError("several source rows match one target row")
