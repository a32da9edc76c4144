import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from smeltery.plans import batches
from smeltery.plans.layers import to_bronze, to_gold, to_silver
from smeltery.schemas import TABLES, raw_schema
from smeltery.sources import files
from smeltery.sources.folders import Zones
from tests.conftest import rows_of

DAY = dt.date(2025, 2, 20)


@pytest.fixture(scope="module")
def allocation():
    return batches.allocate(None, 3000)


@pytest.fixture(scope="module")
def batch(spark, allocation):
    return {name: df.cache() for name, df in batches.batch(spark, allocation, DAY, seed=3).items()}


def test_ids_are_dense_above_the_default_mark(batch):
    for name, df in batch.items():
        low, high, n, distinct = df.agg(
            F.min(df.columns[0]), F.max(df.columns[0]), F.count(F.lit(1)), F.countDistinct(df.columns[0])
        ).first()
        assert (low, high, n, distinct) == (10001, 13000, 3000, 3000), name


def test_schemas(batch):
    for name in TABLES:
        assert [(f.name, f.dataType) for f in batch[name].schema] == [(f.name, f.dataType) for f in raw_schema(name)]


def test_texts_from_ids(batch):
    first = batch["customers"].filter("customer_id = 10001").first()
    assert (first["full_name"], first["email"]) == ("Customer 10001", "customer10001@example.com")
    assert batch["products"].filter("product_id = 10002").first()["product_name"] == "Product 10002"


def values(df, column):
    return {row[0] for row in df.select(column).distinct().collect()}


def test_domains(batch):
    customers, products, orders, items = (batch[n] for n in ("customers", "products", "orders", "order_items"))
    assert values(customers, "city") == set(batches.CITIES)
    assert values(customers, "state") == set(batches.STATES)
    assert {a.split(" ", 1)[1] for a in values(customers, "address")} == set(batches.STREETS)
    assert all(1 <= int(a.split(" ", 1)[0]) <= 9999 for a in values(customers, "address"))
    assert values(products, "category") == set(batches.CATEGORIES)
    assert values(orders, "order_status") == set(batches.STATUSES)
    assert values(orders, "order_date") == {DAY}
    assert values(items, "quantity") == set(range(1, 11))
    for df, column, low, high in (
        (products, "price", 5.0, 1000.0), (orders, "total_amount", 0.0, 5000.0), (items, "unit_price", 5.0, 500.0),
        (orders, "customer_id", 1, 13000), (items, "order_id", 1, 13000), (items, "product_id", 1, 13000),
    ):
        least, most, mean = df.agg(F.min(column), F.max(column), F.avg(column)).first()
        assert low <= least and most <= high, column
        assert abs(mean - (low + high) / 2) < 0.05 * (high - low), column
        assert least < low + 0.05 * (high - low) and most > high - 0.05 * (high - low), column
        assert df.filter(F.round(column, 2) != F.col(column)).count() == 0


def test_city_and_state_are_independent(batch):
    assert batch["customers"].select("city", "state").distinct().count() == 100


def test_draws_do_not_depend_on_partitioning(spark, allocation, batch):
    again = batches.orders(allocation.ids(spark, "orders").repartition(17), allocation.last["customers"], DAY, seed=3)
    assert rows_of(again) == rows_of(batch["orders"])
    other = batches.orders(allocation.ids(spark, "orders"), allocation.last["customers"], DAY, seed=4)
    assert rows_of(other) != rows_of(batch["orders"])


def test_orders_without_a_date_spread_over_the_range(spark, allocation):
    days = values(batches.orders(allocation.ids(spark, "orders"), 10, None), "order_date")
    assert min(days) >= batches.FIRST_DAY and max(days) <= batches.LAST_DAY and len(days) > 350


def test_rows_per_table(spark):
    counts = dict.fromkeys(TABLES, 5) | {"orders": 0}
    allocation = batches.allocate(None, counts)
    assert allocation.ids(spark, "orders").count() == 0 and allocation.last["orders"] == 10000


def test_batches_continue_from_the_marks(spark, tmp_path):
    zones, marks = Zones.under(str(tmp_path)), str(tmp_path / "marks")
    first = batches.run_batch(spark, zones, "2025-02-20", marks, 10)
    second = batches.run_batch(spark, zones, "2025-02-20", marks, 10)
    assert first.last == dict.fromkeys(TABLES, 10010)
    assert second.first == dict.fromkeys(TABLES, 10011)
    assert rows_of(batches.high_water(files.scan(spark, marks, batches.MARKS_SCHEMA, "json"))) == sorted(
        (name, 10020) for name in TABLES
    )
    # Both runs of the day are in the day's folder, under ids of their own.
    orders = files.scan(spark, zones.raw_day("orders", "2025-02-20"), raw_schema("orders"))
    assert orders.count() == orders.select("order_id").distinct().count() == 20


def test_failed_run_can_be_repeated(spark, tmp_path):
    zones, marks = Zones.under(str(tmp_path)), str(tmp_path / "marks")
    blocked = tmp_path / "raw_landing_zone" / "raw_orders"
    blocked.parent.mkdir()
    blocked.write_text("a file where the folder should go")
    with pytest.raises(Exception):
        batches.run_batch(spark, zones, "2025-02-20", marks, 10)
    found = batches.high_water(files.scan(spark, marks, batches.MARKS_SCHEMA, "json"))
    assert rows_of(found) == [("customers", 10010), ("products", 10010)]
    blocked.unlink()
    again = batches.run_batch(spark, zones, "2025-02-20", marks, 10)
    assert again.first == {"customers": 10011, "products": 10011, "orders": 10001, "order_items": 10001}


def test_marks_from_one_json_object(spark, tmp_path):
    (tmp_path / "tracker.json").write_text(json.dumps({"customers": 35000, "orders": 30000}, indent=2))
    marks = batches.marks_from_json(spark, str(tmp_path / "tracker.json"))
    assert rows_of(marks) == [("customers", 35000), ("orders", 30000)]
    assert batches.allocate(marks, 1).first == {"customers": 35001, "products": 10001, "orders": 30001, "order_items": 10001}


def test_a_default_batch_gives_the_expected_share_of_gold_orders(spark):
    """5000 orders over 30000 customer ids, 5000 of them delivered, 3 of 4 statuses active: 625 expected."""
    marks = spark.createDataFrame([(name, 25000) for name in TABLES], batches.MARKS_SCHEMA)
    raw = batches.batch(spark, batches.allocate(marks), DAY)
    assert 530 < to_gold(to_silver(to_bronze(raw)))["orders"].count() < 720


def test_runs_at_the_same_time_reserve_disjoint_dense_ranges(spark, tmp_path):
    marks = str(tmp_path / "marks")
    files.write(spark.createDataFrame([(name, 100) for name in TABLES], batches.MARKS_SCHEMA), marks, "json")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda k: batches.reserve(spark, marks, {name: k + 1 for name in TABLES}), range(8)))
    for table in TABLES:
        ids = sorted(i for a in got for i in range(a.first[table], a.last[table] + 1))
        assert ids == list(range(101, 101 + sum(range(1, 9))))


def test_two_batches_at_the_same_time(spark, tmp_path):
    zones, marks = Zones.under(str(tmp_path)), str(tmp_path / "marks")
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda k: batches.run_batch(spark, zones, f"2025-02-2{k}", marks, 20), range(2)))
    days = [files.scan(spark, zones.raw_day("orders", f"2025-02-2{k}"), raw_schema("orders")) for k in range(2)]
    ids = sorted(r["order_id"] for df in days for r in df.collect())
    assert ids == list(range(batches.LAST_ID + 1, batches.LAST_ID + 41))


def test_a_failed_batch_gives_its_ids_back(spark, tmp_path, monkeypatch):
    zones, marks = Zones.under(str(tmp_path)), str(tmp_path / "marks")
    real = batches.append

    def append(df, folder, fmt="csv"):
        if "raw_orders" in folder:
            raise OSError("disk full")
        real(df, folder, fmt)

    monkeypatch.setattr(batches, "append", append)
    with pytest.raises(OSError, match="disk full"):
        batches.run_batch(spark, zones, "2025-02-20", marks, 5)
    monkeypatch.undo()
    again = batches.run_batch(spark, zones, "2025-02-20", marks, 5)
    start = batches.LAST_ID + 1
    assert again.first == {"customers": start + 5, "products": start + 5, "orders": start, "order_items": start}
