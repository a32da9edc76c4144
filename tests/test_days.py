"""Many days in one run give what a run for each day gives, and touch no other day."""

import pytest
from pyspark.sql import functions as F

from smeltery.plans import batches, days, jobs
from smeltery.schemas import MARTS, TABLES, gold_schema, silver_schema
from smeltery.sources import files
from smeltery.sources.folders import Zones
from tests.conftest import rows_of

DAYS = ["2025-02-18", "2025-02-20", "2025-03-01"]
LOADED = "2025-03-01 00:00:00"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Ids start anew each day, so that rows of different days would match if they could."""
    zones = Zones.under(str(tmp_path_factory.mktemp("days")))
    for k, one in enumerate(DAYS):
        ids = batches.Allocation(dict.fromkeys(TABLES, 1), dict.fromkeys(TABLES, 40 + 10 * k))
        for name, df in batches.batch(spark, ids, None, seed=k).items():
            files.append(df.drop("city") if name == "customers" and k == 1 else df, zones.raw_day(name, one))
    return zones


def apart(landed, tmp_path, name):
    own = Zones.under(str(tmp_path / name))
    return Zones(landed.raw, own.bronze, own.silver, own.gold)


@pytest.mark.parametrize("layer_format,gold_format", [("parquet", "csv"), ("csv", "parquet")])
def test_days_at_once_equal_days_one_by_one(spark, landed, tmp_path, layer_format, gold_format):
    one, many = apart(landed, tmp_path, "one"), apart(landed, tmp_path, "many")
    formats = {"layer_format": layer_format, "gold_format": gold_format, "ingested_at": F.lit(LOADED).cast("timestamp")}
    files.write(spark.range(3), many.gold_table("fact_sales", "2025-02-19"), "parquet")
    for date in DAYS:
        jobs.run_day(spark, one, date, **formats)
    days.run_days(spark, many, DAYS, **formats)
    for date in DAYS:
        for name in TABLES:
            read = lambda z: files.scan(spark, z.silver_table(name, date), silver_schema(name), layer_format)  # noqa: B023, E731
            assert rows_of(read(many)) == rows_of(read(one)) and read(many).columns == read(one).columns
        for name in MARTS:
            read = lambda z: files.scan(spark, z.gold_table(name, date), gold_schema(name), gold_format)  # noqa: B023, E731
            assert rows_of(read(many)) == rows_of(read(one)) and read(many).columns == read(one).columns, (date, name)
    assert files.scan(spark, many.gold_table("fact_sales", "2025-02-19"), "id BIGINT", "parquet").count() == 3
    days.run_days(spark, many, DAYS[1:2], **formats)
    again = files.scan(spark, many.gold_table("fact_sales", DAYS[0]), gold_schema("fact_sales"), gold_format)
    assert rows_of(again) == rows_of(files.scan(spark, one.gold_table("fact_sales", DAYS[0]), gold_schema("fact_sales"), gold_format))


def test_a_day_without_a_table_stops_the_run(spark, landed, tmp_path):
    zones = apart(landed, tmp_path, "none")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        days.run_days(spark, zones, [*DAYS, "2025-03-02"])
    assert not (tmp_path / "none" / "bronze_landing_zone").exists()


def test_a_failed_layer_leaves_every_day(spark, landed, tmp_path, monkeypatch):
    zones = apart(landed, tmp_path, "failed")
    days.run_days(spark, zones, DAYS)
    before = {d: rows_of(files.scan(spark, zones.gold_table("orders", d), gold_schema("orders"))) for d in DAYS}
    real = days.write_parts

    def write_parts(df, by, folders, staged, fmt):
        if "/gold/products" in staged:
            raise OSError("disk full")
        real(df, by, folders, staged, fmt)

    monkeypatch.setattr(days, "write_parts", write_parts)
    with pytest.raises(OSError, match="disk full"):
        days.run_days(spark, zones, DAYS)
    assert before == {d: rows_of(files.scan(spark, zones.gold_table("orders", d), gold_schema("orders"))) for d in DAYS}


def test_joins_are_within_days(spark, landed):
    raw = days.of_days([d.replace("-", "") for d in DAYS], lambda one: jobs.read_raw(spark, landed, f"{one[:4]}-{one[4:6]}-{one[6:]}"))
    gold = days.to_gold(days.to_silver(days.to_bronze(raw)), within=[days.DAY])
    plan = gold["fact_sales"]._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) >= 4 and all(days.DAY in line for line in joins)
