"""Operators: DataFrames in, DataFrame out, no session settings touched."""

from .aggregates import (
    best_products,
    daily_event_counts,
    grand_totals,
    region_features,
    region_type_stats,
    revenue_by_region_type,
    sorted_revenue,
    top_products,
    user_region_revenue,
    user_region_totals,
)
from .joins import category_revenue
from .paths import mean_final_price, path_summary
from .quality import clean
from .scans import count_keys, count_rows
from .scoring import score, score_summary
from .upsert import merge_upsert
from .windows import daily_revenue, rank_in_day, rolling_revenue

__all__ = [
    "best_products",
    "category_revenue",
    "clean",
    "count_keys",
    "count_rows",
    "daily_event_counts",
    "daily_revenue",
    "grand_totals",
    "mean_final_price",
    "merge_upsert",
    "path_summary",
    "rank_in_day",
    "region_features",
    "region_type_stats",
    "revenue_by_region_type",
    "rolling_revenue",
    "score",
    "score_summary",
    "sorted_revenue",
    "top_products",
    "user_region_revenue",
    "user_region_totals",
]
