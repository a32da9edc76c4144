"""Column expressions of the retail rules. All follow SQL logic: NULL is not a pass."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the order status that takes an order out of the active set.
CANCELLED = "CANCELLED"


def positive(*columns: str) -> Column:
    return reduce(and_, (F.col(c) > 0 for c in columns))


def is_active_order() -> Column:
    return (F.col("order_status") != CANCELLED) & positive("total_amount")


def line_total() -> Column:
    """Quantity times the item's own price, as an unrounded double."""
    return F.col("quantity") * F.col("unit_price")


def day_folder(day: Column) -> Column:
    """The ``yyyymmdd`` folder name of a date column."""
    return F.date_format(day, "yyyyMMdd")


def run_day(text: Column) -> Column:
    """A ``YYYY-MM-DD`` text as a date; other text gives NULL."""
    return F.try_to_date(text, "yyyy-MM-dd")
