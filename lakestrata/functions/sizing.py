"""Size check that decides whether a table may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, DecimalType, StringType

DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024
_ROW_OVERHEAD = 32


def measured_bytes(df: DataFrame) -> int | None:
    """In-memory size of ``df``: fixed widths times rows plus string lengths.

    One aggregation that returns a single row. None if a column is nested, so
    that the size is not known.
    """
    fixed = _ROW_OVERHEAD
    lengths = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            lengths.append(F.coalesce(F.octet_length(field.name), F.lit(0)).cast("bigint"))
            fixed += 8
        elif isinstance(field.dataType, DecimalType):
            fixed += 16
        elif isinstance(field.dataType, AtomicType):
            fixed += 8
        else:
            return None
    text = sum(lengths[1:], lengths[0]) if lengths else F.lit(0).cast("bigint")
    rows, chars = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(text), F.lit(0))).first()
    return rows * fixed + chars


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether the measured size of ``df`` is at most ``max_bytes``."""
    size = measured_bytes(df)
    return size is not None and size <= max_bytes
