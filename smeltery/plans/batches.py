"""Synthetic daily batches with dense ascending ids, drawn row by row from the id."""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.functions.draws import money, pick, whole
from smeltery.schemas import TABLES, raw_schema
from smeltery.sources.commits import Files
from smeltery.sources.files import append, scan_optional
from smeltery.sources.folders import Zones, as_run_date

# Domains of the generated columns and defaults of a run.
STREETS = ("Main St", "Oak Ave", "Pine Rd", "Maple Lane", "1st Ave")
CITIES = (
    "New York", "Los Angeles", "Houston", "Chicago", "Miami",
    "Seattle", "Boston", "Cleveland", "Atlanta", "Charlotte",
)
STATES = ("NY", "CA", "TX", "IL", "FL", "WA", "MA", "OH", "GA", "NC")
CATEGORIES = ("Electronics", "Wearables", "Home Decor", "Kitchen", "Sports")
STATUSES = ("SHIPPED", "PENDING", "CANCELLED", "DELIVERED")
FIRST_DAY, LAST_DAY = dt.date(2024, 1, 1), dt.date(2025, 1, 1)
ROWS_PER_TABLE = 5000
LAST_ID = 10000

_LOOKS = 100  # at a reservation that is being written
MARKS_SCHEMA = "table_name STRING, last_id BIGINT"


def _shaped(df: DataFrame, table: str) -> DataFrame:
    """Exactly the raw columns and types of ``table``."""
    return df.select(*(F.col(f.name).cast(f.dataType) for f in raw_schema(table)))


def customers(ids: DataFrame, seed: int = 0) -> DataFrame:
    """One customer per row of ``ids`` (a single column ``id``)."""
    return _shaped(ids.select(
        F.col("id").alias("customer_id"),
        F.format_string("Customer %d", "id").alias("full_name"),
        F.format_string("customer%d@example.com", "id").alias("email"),
        F.concat_ws(" ", whole(1, 9999, "id", seed, "house"), pick(STREETS, "id", seed, "street")).alias("address"),
        pick(CITIES, "id", seed, "city").alias("city"),
        pick(STATES, "id", seed, "state").alias("state"),
    ), "customers")


def products(ids: DataFrame, seed: int = 0) -> DataFrame:
    return _shaped(ids.select(
        F.col("id").alias("product_id"),
        F.format_string("Product %d", "id").alias("product_name"),
        pick(CATEGORIES, "id", seed, "category").alias("category"),
        money(5, 1000, "id", seed, "price").alias("price"),
    ), "products")


def orders(ids: DataFrame, max_customer_id: int, order_date: dt.date | None = None, seed: int = 0) -> DataFrame:
    """Orders of any customer up to ``max_customer_id``, all on ``order_date`` if given."""
    if order_date is None:
        offset = whole(0, (LAST_DAY - FIRST_DAY).days, "id", seed, "order_date").cast("int")
        placed = F.date_add(F.lit(FIRST_DAY), offset)
    else:
        placed = F.lit(order_date)
    return _shaped(ids.select(
        F.col("id").alias("order_id"),
        placed.alias("order_date"),
        whole(1, max_customer_id, "id", seed, "customer_id").alias("customer_id"),
        money(0, 5000, "id", seed, "total_amount").alias("total_amount"),
        pick(STATUSES, "id", seed, "order_status").alias("order_status"),
    ), "orders")


def order_items(ids: DataFrame, max_order_id: int, max_product_id: int, seed: int = 0) -> DataFrame:
    return _shaped(ids.select(
        F.col("id").alias("order_item_id"),
        whole(1, max_order_id, "id", seed, "order_id").alias("order_id"),
        whole(1, max_product_id, "id", seed, "product_id").alias("product_id"),
        whole(1, 10, "id", seed, "quantity").alias("quantity"),
        money(5, 500, "id", seed, "unit_price").alias("unit_price"),
    ), "order_items")


@dataclass(frozen=True)
class Allocation:
    """Id ranges of one batch: per table, the first and the last new id."""

    first: Mapping[str, int]
    last: Mapping[str, int]

    def ids(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.range(self.first[table], self.last[table] + 1)


def allocate(marks: DataFrame | None, rows: int | Mapping[str, int] = ROWS_PER_TABLE) -> Allocation:
    """Dense ids above the high-water marks (at most one row per table is read)."""
    known = {} if marks is None else dict(high_water(marks).filter(F.col("table_name").isin(*TABLES)).collect())
    wanted = rows if isinstance(rows, Mapping) else dict.fromkeys(TABLES, rows)
    first = {table: known.get(table, LAST_ID) + 1 for table in TABLES}
    return Allocation(first, {table: first[table] + wanted[table] - 1 for table in TABLES})


def reserve(
    spark: SparkSession, marks_folder: str, rows: int | Mapping[str, int] = ROWS_PER_TABLE,
) -> Allocation:
    """Dense ids above the marks and above what other runs have reserved.

    A range is reserved by creating the file that is named for its first id, which only one of several runs can do; the
    others look again and take the ids after it.
    """
    marks = scan_optional(spark, marks_folder, MARKS_SCHEMA, "json")
    wanted, known = allocate(marks, rows), Files(spark, marks_folder)
    first, last = {}, {}
    for table in TABLES:
        count = wanted.last[table] - wanted.first[table]
        first[table] = max(wanted.first[table], _reserved(known, marks_folder, table) + 1)
        while not known.create(_claim(marks_folder, table, first[table]), str(first[table] + count)):
            first[table] = max(first[table], _reserved(known, marks_folder, table) + 1)
        last[table] = first[table] + count
    return Allocation(first, last)


def _claim(marks_folder: str, table: str, first: int) -> str:
    return f"{marks_folder}/_reserved/{table}/{first:020d}"


def _reserved(known: Files, marks_folder: str, table: str) -> int:
    """The last id reserved of a table, 0 if none is."""
    for _ in range(_LOOKS):
        claims = known.names(f"{marks_folder}/_reserved/{table}")
        text = known.read(f"{marks_folder}/_reserved/{table}/{claims[-1]}") if claims else "0"
        if text:
            return int(text)
        time.sleep(0.05)  # its writer is between creating and filling it
    raise OSError(f"the reservation {claims[-1]} of {table} in {marks_folder} was never filled: remove it")


def batch(
    spark: SparkSession, allocation: Allocation, order_date: dt.date | None = None, seed: int = 0,
    tables: Sequence[str] = TABLES,
) -> dict[str, DataFrame]:
    """The raw tables. Orders and items may refer to any id up to the new marks."""
    last = allocation.last
    build = {
        "customers": lambda ids: customers(ids, seed),
        "products": lambda ids: products(ids, seed),
        "orders": lambda ids: orders(ids, last["customers"], order_date, seed),
        "order_items": lambda ids: order_items(ids, last["orders"], last["products"], seed),
    }
    return {table: build[table](allocation.ids(spark, table)) for table in tables}


def high_water(marks: DataFrame) -> DataFrame:
    """The highest id ever recorded per table."""
    return marks.groupBy("table_name").agg(F.max("last_id").alias("last_id"))


def marks_from_json(spark: SparkSession, path: str) -> DataFrame:
    """Marks kept as one JSON object, table name to last id."""
    found = spark.read.schema(", ".join(f"{table} BIGINT" for table in TABLES)).option("multiLine", True).json(path)
    return found.unpivot([], list(TABLES), "table_name", "last_id").filter(F.col("last_id").isNotNull())


def run_batch(
    spark: SparkSession, zones: Zones, run_date: dt.date | str, marks_folder: str,
    rows: int | Mapping[str, int] = ROWS_PER_TABLE, seed: int = 0,
) -> Allocation:
    """Append one generated batch to the raw day folders.

    Its ids are reserved first, so that runs at the same time have ranges of their own. A table's mark is appended once the
    table is written, and the highest mark counts. A run that fails gives back what it has not written: it leaves no
    gap, unless another run has reserved ids after it, and a repeated one does not hand out written ids again.
    """
    run_date = as_run_date(run_date)
    allocation = reserve(spark, marks_folder, rows)
    known, left = Files(spark, marks_folder), set(TABLES)
    try:
        for table, df in batch(spark, allocation, run_date, seed).items():
            append(df, zones.raw_day(table, run_date))
            left.discard(table)
            # A file of its own: two jobs that append to one folder would share its temporary files.
            mark = json.dumps({"table_name": table, "last_id": allocation.last[table]})
            known.create(f"{marks_folder}/mark-{uuid.uuid4().hex}.json", mark)
    finally:
        for table in left:
            known.delete(_claim(marks_folder, table, allocation.first[table]))
    return allocation
