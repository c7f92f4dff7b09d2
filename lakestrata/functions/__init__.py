"""Column expressions and checks shared by the operators."""

from .columns import keeps_all, name_rule
from .measures import (
    add_totals,
    as_doubles,
    exact_avg,
    exact_stddev_samp,
    exact_sum,
    exact_total,
    is_total,
    largest_first,
    nan_to_null,
    revenue,
    total_as_double,
)
from .sizing import fits_broadcast, measured_bytes

__all__ = [
    "add_totals",
    "as_doubles",
    "exact_avg",
    "exact_stddev_samp",
    "exact_sum",
    "exact_total",
    "fits_broadcast",
    "is_total",
    "keeps_all",
    "largest_first",
    "measured_bytes",
    "name_rule",
    "nan_to_null",
    "revenue",
    "total_as_double",
]
