"""The layers as pure functions over DataFrames; nothing here reads, writes or caches."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame

from smeltery.operators import sales
from smeltery.operators.audit import with_audit
from smeltery.operators.quality import REJECTED_BY, drop_columns, keep_valid, rejected_by, require_columns
from smeltery.schemas import AUDIT_TIME, SOURCE_SYSTEM, SOURCE_SYSTEMS

Tables = Mapping[str, DataFrame]
Stage = Callable[[str, DataFrame], DataFrame]
Check = Callable[[DataFrame], bool]


def to_bronze(raw: Tables, ingested_at: Column | None = None) -> dict[str, DataFrame]:
    return {name: with_audit(df, SOURCE_SYSTEMS[name], ingested_at) for name, df in raw.items()}


def to_silver(bronze: Tables) -> dict[str, DataFrame]:
    require_columns(bronze)
    return {name: drop_columns(keep_valid(name, df), SOURCE_SYSTEM) for name, df in bronze.items()}


def to_routed_silver(bronze: Tables) -> dict[str, DataFrame]:
    """All bronze rows in silver columns, with the rules that they fail: NULL for those that to_silver() keeps."""
    require_columns(bronze)
    return {
        name: drop_columns(df, SOURCE_SYSTEM).withColumn(REJECTED_BY, rejected_by(name)) for name, df in bronze.items()
    }


def _in_place(name: str, df: DataFrame) -> DataFrame:
    return df


def _unknown(valid_orders: DataFrame) -> bool:
    return False


def to_gold(
    silver: Mapping[str, DataFrame | None], *, keys_unique: bool = False,
    stage: Stage = _in_place, check: Check = _unknown, within: Sequence[str] = (),
) -> dict[str, DataFrame | None]:
    """The five gold outputs; any silver table may be missing (None).

    Without customers every silver order counts as valid. Orders and items are checked
    against each other only if both are there; alone, either passes on unfiltered.
    The fact needs orders, items and products.

    ``stage`` is called on the two tables that several outputs share and may return a
    written copy, so that their joins run once. ``check`` is asked whether the valid orders
    are unique; if so, each item is joined once, as under ``keys_unique``. ``within`` names columns
    in which rows must agree to be joined, such as the day when many are done at once.
    """
    customers, products, orders, items = (
        silver.get(name) for name in ("customers", "products", "orders", "order_items")
    )
    valid = orders
    if orders is not None and customers is not None:
        valid = stage("valid_orders", sales.valid_orders(orders, customers, keys_unique=keys_unique, within=within))

    fact, gold_orders, gold_items = None, valid, items
    if valid is not None and items is not None:
        once = keys_unique or check(valid)
        lines = stage("order_lines", sales.order_lines(items, valid, keys_unique=once, within=within))
        gold_orders, gold_items = sales.active_orders(valid), sales.active_order_items(lines)
        if products is not None:
            fact = sales.fact_sales(lines, products, within=within)

    outputs = {
        "fact_sales": fact, "customers": customers, "orders": gold_orders,
        "order_items": gold_items, "products": products,
    }
    return {name: drop_columns(df, SOURCE_SYSTEM, AUDIT_TIME) for name, df in outputs.items()}
