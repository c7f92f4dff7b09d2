"""Names and types of columns that are put into another table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
)

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19)))


def name_rule(spark: SparkSession) -> Callable[[str], str]:
    """Gives what two names have in common if the session takes them for one."""
    sensitive = spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    return (lambda name: name) if sensitive else str.lower


def keeps_all(given: DataType, known: DataType) -> bool:
    """Whether every value of type ``given`` is one of type ``known``."""
    if given.simpleString() == known.simpleString() or isinstance(given, NullType):
        return True
    if isinstance(known, _WHOLE):
        return isinstance(given, _WHOLE[: _WHOLE.index(type(known))])
    if isinstance(known, DoubleType):
        return isinstance(given, (FloatType, ByteType, ShortType, IntegerType))
    if isinstance(known, FloatType):
        return isinstance(given, (ByteType, ShortType))
    if isinstance(known, DecimalType):
        places = known.precision - known.scale
        if isinstance(given, DecimalType):
            return given.scale <= known.scale and given.precision - given.scale <= places
        return isinstance(given, _WHOLE) and _DIGITS[type(given)] <= places
    return False
