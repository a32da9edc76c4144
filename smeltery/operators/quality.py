"""Gates, column contracts and column removal."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.functions.rules import positive

# Columns that must be positive for a row to reach silver.
POSITIVE_COLUMNS = {
    "customers": (),
    "products": ("price",),
    "orders": ("total_amount",),
    "order_items": ("quantity", "unit_price"),
}

# The tables that must carry each key, and the error raised otherwise.
REQUIRED_COLUMNS = {
    "customer_id": (("orders", "customers"), "Required column 'customer_id' missing in orders or customers table."),
    "order_id": (("order_items", "orders"), "Required column 'order_id' missing in order_items or orders table."),
}


def keep_valid(table: str, df: DataFrame) -> DataFrame:
    """Rows of ``table`` whose gated amounts are positive; customers pass unchanged."""
    gated = POSITIVE_COLUMNS[table]
    return df.filter(positive(*gated)) if gated else df


REJECTED_BY = "rejected_by"


def rejected_by(table: str) -> Column:
    """The rules of ``table`` that a row fails, by name and joined by ``+``; NULL for a row that keep_valid() keeps.

    A gated amount is either ``<column>_missing`` (NULL, also where a value did not parse) or ``<column>_not_positive``.
    """
    failed = [
        F.when(F.col(c).isNull(), F.lit(f"{c}_missing")).when(~positive(c), F.lit(f"{c}_not_positive"))
        for c in POSITIVE_COLUMNS[table]
    ]
    return F.nullif(F.concat_ws("+", *failed), F.lit("")) if failed else F.lit(None).cast("string")


def verdicts(table: str) -> list[str]:
    """Every text that rejected_by() can give."""
    states = ([None, f"{c}_missing", f"{c}_not_positive"] for c in POSITIVE_COLUMNS[table])
    return [text for rules in product(*states) if (text := "+".join(filter(None, rules)))]


def has_column(df: DataFrame | None, name: str) -> bool:
    return df is not None and name in df.columns


def require_columns(tables: Mapping[str, DataFrame]) -> None:
    for column, (holders, message) in REQUIRED_COLUMNS.items():
        if not all(has_column(tables[table], column) for table in holders):
            raise ValueError(message)


def required_columns_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per required (table, column): is it there, and how many rows the table has."""
    def line(table: str, column: str) -> DataFrame:
        df = tables[table]
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(has_column(df, column)).alias("present"),
            "row_count",
        )

    lines = (line(table, column) for column, (holders, _) in REQUIRED_COLUMNS.items() for table in holders)
    return reduce(DataFrame.unionAll, lines)


def drop_columns(df: DataFrame | None, *names: str) -> DataFrame | None:
    """Without the named columns; names that do not occur, and a missing table, are fine."""
    return None if df is None else df.drop(*names)


def is_unique(df: DataFrame, *columns: str) -> bool:
    """Whether no values of ``columns`` occur twice. Runs a job; counts are combined before the shuffle."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
