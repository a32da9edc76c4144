"""The layer jobs over many days at once, for a backlog of small ones.

Each layer is one plan: the days' rows lie in one table with their day as a column, and rows meet only within a day, so the
result is that of a run for each day. Each day's folders are replaced together, as by those runs; no other day is touched.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from contextlib import ExitStack
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.operators.quality import is_unique
from smeltery.plans.jobs import read_raw, standing, together
from smeltery.plans.layers import to_bronze, to_gold, to_silver
from smeltery.schemas import MARTS, TABLES, bronze_schema, silver_schema
from smeltery.session import new_folder, tuned
from smeltery.sources import commits
from smeltery.sources.files import PACKED_CSV, release, scan, staged, write_parts
from smeltery.sources.folders import Zones, day

DAY = "__day"

Read = Callable[[str], Mapping[str, DataFrame]]


def of_days(days: Iterable[str], read: Read) -> dict[str, DataFrame]:
    """The tables of all days, with the day as a text column."""
    each = [{name: df.withColumn(DAY, F.lit(one)) for name, df in read(one).items()} for one in days]
    return {name: reduce(DataFrame.unionByName, (tables[name] for tables in each)) for name in TABLES}


def _replace(
    spark: SparkSession, zones: Zones, layer: str, days: Iterable[str], tables: Mapping[str, DataFrame],
    place: Callable[[str, dt.date], str], fmt: str, work: str,
) -> None:
    """Write each table once, and let the folders of every day take the places of its old ones."""
    dates = {one: dt.datetime.strptime(one, "%Y%m%d").date() for one in days}
    with ExitStack() as stack:
        runs = {
            one: stack.enter_context(
                commits.replacing(spark, zones.log(layer, date), {name: place(name, date) for name in tables})
            )
            for one, date in dates.items()
        }
        together(
            spark,
            lambda name: write_parts(
                tables[name], DAY, {one: run.folders[name] for one, run in runs.items()}, f"{work}/{layer}/{name}", fmt
            ),
            tables,
        )


def run_days(
    spark: SparkSession, zones: Zones, run_dates: Iterable[dt.date | str], *,
    ingested_at: Column | None = None, layer_format: str = "parquet", gold_format: str = "csv",
) -> None:
    """Bronze, silver and gold of these days. Every day must have all four raw tables.

    Joins are on the day and the key, and valid orders and order lines are written once for all days. Gold is rebalanced by
    day before it is written, so that a day has few files and a large day is split. A layer that fails leaves all days as
    they were.
    """
    days = sorted({day(one) for one in run_dates})
    as_date = {one: f"{one[:4]}-{one[4:6]}-{one[6:]}" for one in days}
    work = new_folder(spark, "days")
    layer_files = PACKED_CSV if layer_format == "csv" else layer_format

    def stored(layer: str, schema: Callable[[str], object]) -> Read:
        def read(one: str) -> dict[str, DataFrame]:
            folders = standing(spark, zones, layer, as_date[one])
            return {name: scan(spark, folders[name], schema(name), layer_format) for name in TABLES}

        return read

    with tuned(spark, *(zones.raw_day(name, as_date[one]) for name in TABLES for one in days)):
        try:
            raw = of_days(days, lambda one: read_raw(spark, zones, as_date[one]))
            _replace(spark, zones, "bronze", days, to_bronze(raw, ingested_at), zones.bronze_table, layer_files, work)
            silver = to_silver(of_days(days, stored("bronze", bronze_schema)))
            _replace(spark, zones, "silver", days, silver, zones.silver_table, layer_files, work)
            gold = to_gold(
                of_days(days, stored("silver", silver_schema)), within=[DAY],
                stage=lambda name, df: staged(df, f"{work}/{name}"), check=lambda valid: is_unique(valid, DAY, "order_id"),
            )
            gold = {name: df.hint("rebalance", DAY) for name, df in gold.items()}
            _replace(spark, zones, "gold", days, {name: gold[name] for name in MARTS}, zones.gold_table, gold_format, work)
        finally:
            release(spark, work)
