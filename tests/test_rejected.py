"""Rows that the gates reject are kept beside silver, under the rules they fail."""

import pytest
from pyspark.sql import functions as F

from smeltery.operators.quality import POSITIVE_COLUMNS, REJECTED_BY, verdicts
from smeltery.plans import jobs
from smeltery.plans.layers import to_routed_silver, to_silver
from smeltery.schemas import TABLES, bronze_schema, silver_schema
from smeltery.sources import files
from smeltery.sources.folders import Zones
from tests.conftest import rows_of

DAY = "2025-02-20"


@pytest.fixture
def zones(spark, fixture_tables, tmp_path):
    found = Zones.under(str(tmp_path))
    for name, df in fixture_tables.items():
        files.append(df.drop("timestamp"), found.raw_day(name, DAY))
    return found


def plain_verdict(row, table):
    rules = [f"{c}_missing" if row[c] is None else f"{c}_not_positive" for c in POSITIVE_COLUMNS[table] if row[c] is None or row[c] <= 0]
    return "+".join(rules) or None


def test_verdicts():
    assert verdicts("customers") == [] and verdicts("products") == ["price_missing", "price_not_positive"]
    assert len(verdicts("order_items")) == 8 and "quantity_missing+unit_price_not_positive" in verdicts("order_items")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_every_row_is_accepted_or_rejected(spark, zones, fmt):
    jobs.run_bronze(spark, zones, DAY, layer_format=fmt)
    bronze = {name: files.scan(spark, zones.bronze_table(name, DAY), bronze_schema(name), fmt) for name in TABLES}
    counts = jobs.run_routed_silver(spark, zones, DAY, fmt)
    for name in TABLES:
        schema = silver_schema(name)
        accepted = files.scan(spark, zones.silver_table(name, DAY), schema, fmt)
        assert rows_of(accepted) == rows_of(to_silver(bronze)[name]) and accepted.columns == schema.names
        rejected = files.scan_rejected(spark, zones.rejected_table(name, DAY), REJECTED_BY, schema, fmt)
        assert rejected.columns == [*schema.names, REJECTED_BY]
        wanted = [(*r, plain_verdict(r, name)) for r in bronze[name].drop("source_system").collect() if plain_verdict(r, name)]
        assert rows_of(rejected) == sorted(wanted, key=repr)
        assert accepted.count() + rejected.count() == bronze[name].count() == sum(counts[name].values())
        by_rule = {r[REJECTED_BY]: r["count"] for r in rejected.groupBy(REJECTED_BY).count().collect()}
        assert by_rule == {v: n for v, n in counts[name].items() if v}
        assert rows_of(to_routed_silver(bronze)[name].filter(f"{REJECTED_BY} IS NOT NULL")) == rows_of(rejected)


def test_a_day_without_rejected_rows_takes_the_old_ones_away(spark, zones, fixture_tables):
    jobs.run_bronze(spark, zones, DAY)
    jobs.run_routed_silver(spark, zones, DAY)
    for name in ("orders", "order_items", "products"):
        assert not files.scan_rejected(spark, zones.rejected_table(name, DAY), REJECTED_BY, silver_schema(name), "parquet").isEmpty()
    good = {"orders": "total_amount > 0", "order_items": "quantity > 0 AND unit_price > 0", "products": "price < 0", "customers": "true"}
    for name, gate in good.items():
        kept = fixture_tables[name].filter(gate).withColumn("source_system", F.lit("x"))
        files.write(kept, zones.bronze_table(name, DAY), "parquet")
    counts = jobs.run_routed_silver(spark, zones, DAY)
    assert counts["products"] == {} and set(counts["orders"]) == {None}
    for name in TABLES:
        assert files.scan_rejected(spark, zones.rejected_table(name, DAY), REJECTED_BY, silver_schema(name), "parquet").isEmpty()
    assert files.scan(spark, zones.silver_table("products", DAY), silver_schema("products"), "parquet").schema == silver_schema("products")


def test_one_pass_writes_both(spark, zones):
    jobs.run_bronze(spark, zones, DAY)
    routed = to_routed_silver({n: files.scan(spark, zones.bronze_table(n, DAY), bronze_schema(n), "parquet") for n in TABLES})
    spark.sparkContext.setJobGroup("routed", "routed")
    try:
        files.write_routed(routed["orders"], REJECTED_BY, verdicts("orders"), f"{zones.silver}/a", f"{zones.silver}/r", "parquet")
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("routed")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
