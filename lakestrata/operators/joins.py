"""Revenue by product category, with the join strategy chosen per query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import add_totals, as_doubles, exact_total, fits_broadcast, revenue
from ..functions.sizing import DEFAULT_BROADCAST_BYTES


def category_revenue(
    events: DataFrame,
    products: DataFrame,
    strategy: str = "broadcast",
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Revenue per category; unknown products fall in the NULL category.

    ``broadcast`` copies the product table to every task if its measured size
    allows, and otherwise goes on like ``shuffle``. ``shuffle`` first sums per
    product and then joins by sort-merge: a product with a third of the events
    is one row by then, and the sums already lie by product.
    """
    if strategy not in ("broadcast", "shuffle"):
        raise ValueError(f"strategy must be 'broadcast' or 'shuffle', not {strategy!r}")
    categories = products.select("product_id", "category")
    if strategy == "broadcast" and fits_broadcast(categories, max_broadcast_bytes):
        joined = events.join(F.broadcast(categories), "product_id", "left")
        amount = exact_total(revenue())
    else:
        sums = events.groupBy("product_id").agg(exact_total(revenue()).alias("revenue"))
        joined = sums.join(categories.hint("merge"), "product_id", "left")
        amount = add_totals("revenue")
    return as_doubles(joined.groupBy("category").agg(amount.alias("revenue")))
