import datetime as dt
import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from smeltery.operators.sales import FACT_COLUMNS
from smeltery.plans import batches, jobs
from smeltery.plans.layers import to_bronze, to_gold, to_silver
from smeltery.schemas import TABLES, bronze_schema, gold_schema, raw_schema, silver_schema
from smeltery.session import stored_bytes
from smeltery.sources import files
from smeltery.sources.folders import Zones
from tests.conftest import rows_of

DAY = "2025-02-20"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """A generated batch dense enough for joins to match: ids 1..60, two runs on one day."""
    root = tmp_path_factory.mktemp("zones")
    zones, marks = Zones.under(str(root)), str(root / "marks")
    files.write(spark.createDataFrame([(name, 0) for name in TABLES], batches.MARKS_SCHEMA), marks, "json")
    for _ in range(2):
        batches.run_batch(spark, zones, DAY, marks, 30)
    return zones


def expected(spark, zones):
    return to_gold(to_silver(to_bronze(jobs.read_raw(spark, zones, DAY))))


@pytest.mark.parametrize("layer_format,gold_format", [("csv", "csv"), ("parquet", "csv"), ("parquet", "parquet")])
def test_day_end_to_end(spark, landed, tmp_path, layer_format, gold_format):
    own = Zones.under(str(tmp_path))
    zones = Zones(landed.raw, own.bronze, own.silver, own.gold)
    loaded = F.lit("2025-02-20 01:02:03.456").cast("timestamp")
    written = jobs.run_day(
        spark, zones, dt.date(2025, 2, 20), ingested_at=loaded,
        layer_format=layer_format, gold_format=gold_format,
    )
    assert all(written.values())
    bronze = files.scan(spark, zones.bronze_table("orders", DAY), bronze_schema("orders"), layer_format)
    assert bronze.count() == 60
    assert rows_of(bronze.select("timestamp", "source_system").distinct()) == [(dt.datetime(2025, 2, 20, 1, 2, 3, 456000), "Orders")]
    silver = files.scan(spark, zones.silver_table("orders", DAY), silver_schema("orders"), layer_format)
    assert silver.columns == [*raw_schema("orders").names, "timestamp"]
    gold = expected(spark, zones)
    for name, df in gold.items():
        stored = files.scan(spark, zones.gold_table(name, DAY), gold_schema(name), gold_format)
        assert stored.dtypes == df.dtypes, name
        assert rows_of(stored) == rows_of(df), name
        assert stored.count() > 0, name


def test_csv_layers_take_less_room_than_the_raw_files(spark, tmp_path):
    """Bronze and silver add a load time to each row, and bronze a label: unpacked they are larger than raw."""
    zones, n = Zones.under(str(tmp_path)), 4000
    rows = {
        "customers": [
            "id AS customer_id", "concat('C ', id) AS full_name", "concat(id, '@x') AS email", "'1 St' AS address", "'Rome' AS city", "'NY' AS state",
        ],
        "products": [
            "id AS product_id", "IF(id = 7, 'two\\nlines', concat('P ', id)) AS product_name", "'Sports' AS category", "id + 0.5D AS price",
        ],
        "orders": [
            "id AS order_id", "DATE '2025-02-20' AS order_date", "id AS customer_id", "id + 1.5D AS total_amount", "'SHIPPED' AS order_status",
        ],
        "order_items": ["id AS order_item_id", "id AS order_id", "id AS product_id", "2 AS quantity", "id + 1.5D AS unit_price"],
    }
    for name, columns in rows.items():
        files.append(spark.range(0, n, 1, 2).selectExpr(*columns), zones.raw_day(name, DAY))
    jobs.run_day(spark, zones, DAY, layer_format="csv")
    size = {zone: stored_bytes(spark, getattr(zones, zone)) for zone in ("raw", "bronze", "silver")}
    assert size["bronze"] < size["raw"] / 2 and size["silver"] < size["raw"] / 2, size
    assert rows_of(files.scan(spark, zones.gold_table("fact_sales", DAY), gold_schema("fact_sales"))) == rows_of(expected(spark, zones)["fact_sales"])
    assert jobs.run_routed_silver(spark, zones, DAY, "csv") == {name: {None: n} for name in TABLES}
    assert stored_bytes(spark, zones.silver) < size["raw"] / 2


def test_gold_file_header(spark, landed, tmp_path):
    own = Zones.under(str(tmp_path))
    zones = Zones(landed.raw, own.bronze, own.silver, own.gold)
    jobs.run_day(spark, zones, DAY)
    parts = glob.glob(f"{zones.gold_table('fact_sales', DAY)}/*.csv")
    assert {open(part).readline().strip() for part in parts} == {",".join(FACT_COLUMNS)}


def test_bronze_returns_counts(spark, landed, tmp_path):
    own = Zones.under(str(tmp_path))
    counts = jobs.run_bronze(spark, Zones(landed.raw, own.bronze, own.silver, own.gold), DAY)
    assert counts == {"Customer Data": 60, "Order Items": 60, "Orders": 60, "Products": 60}


def test_rerun_replaces_only_its_day(spark, landed, tmp_path):
    own = Zones.under(str(tmp_path))
    zones = Zones(landed.raw, own.bronze, own.silver, own.gold)
    files.write(spark.createDataFrame([(1,)], "x INT"), zones.gold_table("fact_sales", "2025-02-19"))
    for _ in range(2):
        jobs.run_day(spark, zones, DAY)
    stored = files.scan(spark, zones.gold_table("fact_sales", DAY), gold_schema("fact_sales"))
    assert rows_of(stored) == rows_of(expected(spark, zones)["fact_sales"])
    assert files.scan(spark, zones.gold_table("fact_sales", "2025-02-19"), "x INT").count() == 1


def test_bronze_and_silver_need_every_table(spark, fixture_tables, tmp_path):
    zones = Zones.under(str(tmp_path))
    for name in ("customers", "products", "orders"):
        raw = fixture_tables[name].drop("timestamp")
        files.append(raw, zones.raw_day(name, DAY))
        files.write(to_bronze({name: raw})[name], zones.bronze_table(name, DAY), "parquet")
    for job in (jobs.run_bronze, jobs.run_silver):
        with pytest.raises(AnalysisException) as raised:
            job(spark, zones, DAY)
        assert raised.value.getCondition() == "PATH_NOT_FOUND"


@pytest.mark.parametrize("missing,written", [
    (["products"], {"customers", "orders", "order_items"}),
    (["customers"], {"fact_sales", "orders", "order_items", "products"}),
    (["orders"], {"customers", "order_items", "products"}),
    (["order_items"], {"customers", "orders", "products"}),
    (list(TABLES), set()),
])
def test_gold_with_missing_tables(spark, fixture_tables, tmp_path, missing, written):
    zones = Zones.under(str(tmp_path))
    silver = {name: None if name in missing else df for name, df in fixture_tables.items()}
    for name, df in silver.items():
        files.write_optional(df, zones.silver_table(name, DAY), "parquet")
    done = jobs.run_gold(spark, zones, DAY)
    assert {name for name, was in done.items() if was} == written
    for name, df in to_gold(silver).items():
        if df is not None:
            assert rows_of(files.scan(spark, zones.gold_table(name, DAY), df.schema)) == rows_of(df)


@pytest.mark.parametrize("table,column", [
    ("orders", "customer_id"), ("customers", "customer_id"), ("order_items", "order_id"), ("orders", "order_id"),
])
@pytest.mark.parametrize("layer_format", ["csv", "parquet"])
def test_feed_without_a_required_column(spark, fixture_tables, tmp_path, table, column, layer_format):
    zones = Zones.under(str(tmp_path))
    for name, df in fixture_tables.items():
        files.append(df.drop("timestamp", *([column] if name == table else [])), zones.raw_day(name, DAY))
    jobs.run_bronze(spark, zones, DAY, layer_format=layer_format)
    with pytest.raises(ValueError, match=f"Required column '{column}' missing"):
        jobs.run_silver(spark, zones, DAY, layer_format)


def test_feed_without_a_gated_column(spark, fixture_tables, tmp_path):
    zones = Zones.under(str(tmp_path))
    for name, df in fixture_tables.items():
        files.append(df.drop("timestamp", "total_amount"), zones.raw_day(name, DAY))
    jobs.run_bronze(spark, zones, DAY)
    with pytest.raises(AnalysisException) as raised:
        jobs.run_silver(spark, zones, DAY)
    assert raised.value.getCondition().startswith("UNRESOLVED_COLUMN")


def test_days_do_not_mix(spark, landed, tmp_path):
    own = Zones.under(str(tmp_path))
    zones = Zones(landed.raw, own.bronze, own.silver, own.gold)
    with pytest.raises(AnalysisException):
        jobs.run_bronze(spark, zones, "2025-02-21")


@pytest.mark.parametrize("fails", [False, True])
def test_staged_tables_are_removed(spark, fixture_tables, tmp_path, monkeypatch, fails):
    """The gold job leaves nothing in the shared folder, whether its writes succeed or not."""
    zones = Zones.under(str(tmp_path / "zones"))
    for name, df in fixture_tables.items():
        files.write(df, zones.silver_table(name, DAY), "parquet")
    monkeypatch.setattr(jobs, "new_folder", lambda spark, purpose: str(tmp_path / "shared" / purpose))
    if fails:
        def write_optional(df, folder, fmt):
            assert list((tmp_path / "shared").iterdir())
            raise OSError("disk full")
        monkeypatch.setattr(jobs, "write_optional", write_optional)
        with pytest.raises(OSError, match="disk full"):
            jobs.run_gold(spark, zones, DAY)
    else:
        jobs.run_gold(spark, zones, DAY)
    assert not list((tmp_path / "shared").iterdir())


def test_unparsed_values_are_counted(spark, fixture_tables, tmp_path):
    zones = Zones.under(str(tmp_path))
    for name, df in fixture_tables.items():
        files.append(df.drop("timestamp"), zones.raw_day(name, DAY))
    before = jobs.land_bronze(spark, zones, DAY)
    assert {table.unparsed for table in before.values()} == {0}
    bad = spark.createDataFrame([("x", "2025-13-01", "", "1,5", "SHIPPED"), ("1.0", "2025-02-20", None, "2", "n/a")], raw_schema("orders").names)
    files.append(bad, zones.raw_day("orders", DAY))
    after = jobs.land_bronze(spark, zones, DAY)
    assert after.pop("Orders") == (before.pop("Orders").rows + 2, 3)
    assert after == before
