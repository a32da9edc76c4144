"""Layer jobs: read a day's folders, apply the layer, write the day's folders.

Bronze and silver in CSV are packed: each of their rows carries a load time and bronze a label too, all alike. Gold is plain.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from smeltery.operators.quality import REJECTED_BY, is_unique, verdicts
from smeltery.plans.layers import to_bronze, to_gold, to_routed_silver, to_silver
from smeltery.schemas import MARTS, SOURCE_SYSTEMS, TABLES, bronze_schema, customers_without_city, raw_schema, silver_schema
from smeltery.session import key_filter, layer_scans, new_folder, settings, tuned
from smeltery.sources import commits
from smeltery.sources.files import (
    release, scan, scan_csv_variants, scan_optional, staged, write, write_counted, write_optional, write_routed,
)
from smeltery.sources.folders import Zones, day


class Landed(NamedTuple):
    """Rows written to a bronze table, and values of its files that are there but did not parse."""

    rows: int
    unparsed: int


def read_raw(
    spark: SparkSession, zones: Zones, run_date: dt.date | str, unparsed: Mapping[str, Observation] | None = None,
) -> dict[str, DataFrame]:
    """The day's raw CSVs; customer files with and without ``city`` may be mixed. ``unparsed`` has an observation a table."""
    unparsed = unparsed or {}
    raw = {
        name: scan(spark, zones.raw_day(name, run_date), raw_schema(name), unparsed=unparsed.get(name))
        for name in TABLES if name != "customers"
    }
    raw["customers"] = scan_csv_variants(
        spark, zones.raw_day("customers", run_date), raw_schema("customers"), [customers_without_city()],
        unparsed.get("customers"),
    )
    return raw


def together(spark: SparkSession, write_one: Callable[[str], object], names: Iterable[str]) -> dict[str, object]:
    """Write independent tables at the same time, so that small ones fill idle slots."""
    names = list(names)
    with ThreadPoolExecutor(max(len(names), 1)) as pool:
        return dict(zip(names, pool.map(inheritable_thread_target(spark)(write_one), names), strict=True))


def standing(spark: SparkSession, zones: Zones, layer: str, run_date: dt.date | str) -> dict[str, str]:
    """Folders of a layer's tables of the day as its last run left them, without those that this run did not have."""
    table = {"bronze": zones.bronze_table, "silver": zones.silver_table, "gold": zones.gold_table}[layer]
    names = MARTS if layer == "gold" else TABLES
    found = commits.current(spark, zones.log(layer, run_date), {name: table(name, run_date) for name in names})
    return {name: folder for name, folder in found.items() if folder is not None}


def land_bronze(
    spark: SparkSession, zones: Zones, run_date: dt.date | str,
    ingested_at: Column | None = None, layer_format: str = "parquet",
) -> dict[str, Landed]:
    """Returns rows and unparsed values per source label, both counted while writing."""
    with tuned(spark, *(zones.raw_day(name, run_date) for name in TABLES)):
        unparsed = {name: Observation() for name in TABLES}
        bronze = to_bronze(read_raw(spark, zones, run_date, unparsed), ingested_at)
        finals = {name: zones.bronze_table(name, run_date) for name in TABLES}
        with commits.replacing(spark, zones.log("bronze", run_date), finals) as run:
            written = together(spark, lambda name: write_counted(bronze[name], run.folders[name], layer_format, packed=True), bronze)
        return {
            SOURCE_SYSTEMS[name]: Landed(rows, unparsed[name].get["unparsed"] or 0) for name, rows in written.items()
        }


def run_bronze(
    spark: SparkSession, zones: Zones, run_date: dt.date | str,
    ingested_at: Column | None = None, layer_format: str = "parquet",
) -> dict[str, int]:
    """Returns the rows written per source label, counted while writing."""
    landed = land_bronze(spark, zones, run_date, ingested_at, layer_format)
    return {label: table.rows for label, table in landed.items()}


def run_silver(spark: SparkSession, zones: Zones, run_date: dt.date | str, layer_format: str = "parquet") -> None:
    """All four bronze tables must be there; the four silver tables are replaced together."""
    folders = standing(spark, zones, "bronze", run_date)
    with tuned(spark, *folders.values()), settings(spark, layer_scans(spark, layer_format)):
        silver = to_silver(
            {name: scan(spark, folder, bronze_schema(name), layer_format) for name, folder in folders.items()}
        )
        finals = {name: zones.silver_table(name, run_date) for name in TABLES}
        with commits.replacing(spark, zones.log("silver", run_date), finals) as run:
            together(spark, lambda name: write(silver[name], run.folders[name], layer_format, packed=True), silver)


def run_routed_silver(
    spark: SparkSession, zones: Zones, run_date: dt.date | str, layer_format: str = "parquet",
) -> dict[str, dict[str | None, int]]:
    """Silver as run_silver() writes it, and beside it the rows that the gates reject, partitioned by the rules they fail.

    Every bronze row is in one of the two, which one pass writes. Returns per table the rows of each verdict; NULL is for the
    accepted ones. A day's tables of both kinds are replaced together.
    """
    folders = standing(spark, zones, "bronze", run_date)
    with tuned(spark, *folders.values()), settings(spark, layer_scans(spark, layer_format)):
        routed = to_routed_silver(
            {name: scan(spark, folder, bronze_schema(name), layer_format) for name, folder in folders.items()}
        )
        finals = {name: zones.silver_table(name, run_date) for name in TABLES}
        finals |= {f"rejected_{name}": zones.rejected_table(name, run_date) for name in TABLES}

        def write_one(name: str) -> dict[str | None, int]:
            where = run.folders[name], run.folders[f"rejected_{name}"]
            return write_routed(routed[name], REJECTED_BY, verdicts(name), *where, layer_format, packed=True)

        with commits.replacing(spark, zones.log("silver", run_date), finals) as run:
            found = together(spark, write_one, routed)
            run.leave_out(*(f"rejected_{name}" for name, rows in found.items() if set(rows) <= {None}))
        return found


def run_gold(
    spark: SparkSession, zones: Zones, run_date: dt.date | str, *,
    layer_format: str = "parquet", gold_format: str = "csv",
) -> dict[str, bool]:
    """Returns which of the five outputs were written; a missing silver table is no error.

    The outputs of one run replace those of the last together: what this one does not have is missing afterwards, and a
    run that fails changes nothing.

    Valid orders and order lines are written once to the shared folder and read back by
    all outputs, so no join runs twice and a lost executor costs no recomputed joins. Once
    valid orders are there, their number sizes the Bloom filter that thins items before their shuffle, and a look at their ids
    tells whether one join per item is enough. Each run
    has a folder of its own, so that overlapping runs of a day do not meet; it is removed also if a write fails.
    """
    folders = standing(spark, zones, "silver", run_date)
    silver = {
        name: scan_optional(spark, folders[name], silver_schema(name), layer_format) if name in folders else None
        for name in TABLES
    }
    work = new_folder(spark, f"gold-{day(run_date)}")

    def stage(name: str, df: DataFrame) -> DataFrame:
        return staged(df, f"{work}/{name}")

    with tuned(spark, *(folders[name] for name, df in silver.items() if df is not None)), ExitStack() as filters:
        filters.enter_context(settings(spark, layer_scans(spark, layer_format)))

        def check(valid: DataFrame) -> bool:
            filters.enter_context(settings(spark, key_filter(valid.count())))
            return is_unique(valid, "order_id")

        try:
            gold = to_gold(silver, stage=stage, check=check)
            finals = {name: zones.gold_table(name, run_date) for name in gold}
            with commits.replacing(spark, zones.log("gold", run_date), finals) as run:
                written = together(spark, lambda name: write_optional(gold[name], run.folders[name], gold_format), gold)
                run.leave_out(*(name for name, was in written.items() if not was))
            return written
        finally:
            release(spark, work)


def run_day(
    spark: SparkSession, zones: Zones, run_date: dt.date | str, *,
    ingested_at: Column | None = None, layer_format: str = "parquet", gold_format: str = "csv",
) -> dict[str, bool]:
    """Bronze, silver and gold for one day, all under the same run date."""
    run_bronze(spark, zones, run_date, ingested_at, layer_format)
    run_silver(spark, zones, run_date, layer_format)
    return run_gold(spark, zones, run_date, layer_format=layer_format, gold_format=gold_format)
