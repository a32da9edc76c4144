"""Gold tables: referentially valid orders and items, the sales fact, the active set.

Every join is an inner equi-join that keeps duplicates: a customer id that occurs k times
multiplies its orders k-fold, and their lines k*k-fold. No side is forced to broadcast;
Spark decides from the sizes, and adaptive execution splits hot keys (see session.tune).

``keys_unique=True`` is a promise that customer ids and order ids are unique. The rows are
then the same, but the reference checks become semi-joins and each item is joined once.

``within`` names columns that all tables have, such as the day of many days' rows: rows only
meet where these agree, and the columns stay in front.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.functions.rules import is_active_order, line_total, positive
from smeltery.schemas import gold_schema

ORDER_COLUMNS = tuple(gold_schema("orders").names)
ITEM_COLUMNS = ("order_id", "product_id", "quantity", "unit_price")
FACT_COLUMNS = tuple(gold_schema("fact_sales").names)
_LEAST_KEY = -(1 << 63)


def _selective(key: str) -> Column:
    """True for every key that an equi-join can match. Spark makes a Bloom filter of a side's keys only where the side has a
    comparison, which a written table has not; whether one is worth it, session.key_filter says by their number."""
    return F.col(key) >= F.lit(_LEAST_KEY)


def valid_orders(
    orders: DataFrame, customers: DataFrame, *, keys_unique: bool = False, within: Sequence[str] = (),
) -> DataFrame:
    """Orders whose customer is known."""
    known = customers.select(*within, "customer_id")
    how = "left_semi" if keys_unique else "inner"
    return orders.join(known, [*within, "customer_id"], how).select(*within, *ORDER_COLUMNS)


def valid_order_items(
    items: DataFrame, valid: DataFrame, *, keys_unique: bool = False, within: Sequence[str] = (),
) -> DataFrame:
    """Items whose order is valid."""
    known = valid.filter(_selective("order_id")).select(*within, "order_id")
    how = "left_semi" if keys_unique else "inner"
    return items.select(*within, *ITEM_COLUMNS).join(known, [*within, "order_id"], how)


def order_lines(
    items: DataFrame, valid: DataFrame, *, keys_unique: bool = False, within: Sequence[str] = (),
) -> DataFrame:
    """Valid items next to the columns of their order.

    Both joins use order_id, so items are shuffled once. The fact and the active items
    are narrow steps (plus the product join) on top of this one table. Under session.key_filter, items without a
    valid order are left out before the shuffle, but for a few.
    """
    # Under unique order ids the join itself is the reference check.
    lines = items.select(*within, *ITEM_COLUMNS) if keys_unique else valid_order_items(items, valid, within=within)
    return lines.join(valid.filter(_selective("order_id")), [*within, "order_id"])


def fact_sales(lines: DataFrame, products: DataFrame, *, within: Sequence[str] = ()) -> DataFrame:
    """One row per order line with a known product, priced at the item's own price."""
    named = lines.join(products.select(*within, "product_id", "product_name"), [*within, "product_id"])
    return named.withColumn("line_total", line_total()).select(*within, *FACT_COLUMNS)


def active_orders(valid: DataFrame) -> DataFrame:
    return valid.filter(is_active_order())


def active_order_items(lines: DataFrame) -> DataFrame:
    return lines.filter(positive("quantity", "unit_price") & is_active_order())


def inactive_sales(fact: DataFrame, active: DataFrame) -> DataFrame:
    """Fact rows whose order is not active: the fact is built on all valid orders."""
    return fact.join(active.select("order_id"), "order_id", "left_anti").select(*fact.columns)
