import datetime as dt
import glob
import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from smeltery.operators.quality import keep_valid
from smeltery.schemas import bronze_schema, customers_without_city, raw_schema
from smeltery.sources import files
from smeltery.sources.folders import Zones, as_run_date, day
from tests.conftest import rows_of


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


ORDERS = "order_id,order_date,customer_id,total_amount,order_status\n"


def test_scan_reads_every_file_of_the_day(spark, tmp_path):
    put(tmp_path, "a.csv", f"{ORDERS}1,2025-02-20,7,1.5,SHIPPED\n")
    put(tmp_path, "b.csv", f"{ORDERS}1,2025-02-20,7,1.5,SHIPPED\n2,2025-02-20,,2.0,\n")
    put(tmp_path, "c.txt", "not a table\n")
    found = files.scan(spark, str(tmp_path), raw_schema("orders"))
    d = dt.date(2025, 2, 20)
    assert rows_of(found) == [(1, d, 7, 1.5, "SHIPPED")] * 2 + [(2, d, None, 2.0, None)]


def test_missing_folder_and_folder_without_csv(spark, tmp_path):
    put(tmp_path / "empty", "c.txt", "x")
    for folder in (tmp_path / "none", tmp_path / "empty"):
        with pytest.raises(AnalysisException) as raised:
            files.scan(spark, str(folder), raw_schema("orders"))
        assert raised.value.getCondition() == "PATH_NOT_FOUND"
        assert files.scan_optional(spark, str(folder), raw_schema("orders")) is None
    assert files.scan_optional(spark, str(tmp_path / "none"), raw_schema("orders"), "parquet") is None


def test_optional_scan_does_not_hide_other_errors(spark, tmp_path):
    put(tmp_path, "a.csv", ORDERS)
    with pytest.raises(AnalysisException):
        files.scan_optional(spark, str(tmp_path), "order_id NONSENSE")


def test_header_only_file_keeps_types(spark, tmp_path):
    put(tmp_path, "a.csv", ORDERS)
    found = files.scan(spark, str(tmp_path), raw_schema("orders"))
    assert found.schema == raw_schema("orders") and found.count() == 0


def test_unparsable_amount_is_null_and_gated(spark, tmp_path):
    put(tmp_path, "a.csv", f"{ORDERS}1,2025-02-20,7,abc,SHIPPED\n2,2025-02-20,7,3.0,SHIPPED\n")
    found = files.scan(spark, str(tmp_path), raw_schema("orders"))
    assert rows_of(found.select("order_id", "total_amount")) == [(1, None), (2, 3.0)]
    assert rows_of(keep_valid("orders", found).select("order_id")) == [(2,)]


def test_header_variants_align_by_name(spark, tmp_path):
    put(tmp_path, "a.csv", 'customer_id,full_name,email,address,city,state\n1,C 1,e1,"9 Main St, Apt 2",Boston,MA\n')
    put(tmp_path, "b.csv", 'customer_id,full_name,email,address,state\n2,C 2,e2,"8 Oak Ave, Apt 1",NY\n3,C 3,,,\n')
    put(tmp_path, "c.csv", "customer_id,full_name,email,address,city,state\nx4,C 4,e4,7 Pine Rd,Miami,FL\n")
    found = files.scan_csv_variants(spark, str(tmp_path), raw_schema("customers"), [customers_without_city()])
    assert found.schema == raw_schema("customers")
    assert rows_of(found) == sorted([
        (1, "C 1", "e1", "9 Main St, Apt 2", "Boston", "MA"),
        (2, "C 2", "e2", "8 Oak Ave, Apt 1", None, "NY"),
        (3, "C 3", None, None, None, None),
        (None, "C 4", "e4", "7 Pine Rd", "Miami", "FL"),
    ], key=repr)
    # The plain scan would have to match the city-less lines by position; it refuses.
    with pytest.raises(Exception, match="header"):
        files.scan(spark, str(tmp_path), raw_schema("customers")).collect()


def test_columns_follow_the_header(spark, tmp_path):
    put(tmp_path, "a.csv", "order_status,Order_ID,total_amount,note\nSHIPPED,1,2.5,07\n")
    for found in (
        files.scan(spark, str(tmp_path), raw_schema("orders")),
        files.scan_csv_variants(spark, str(tmp_path), raw_schema("orders"), []),
    ):
        assert found.dtypes == [("order_status", "string"), ("Order_ID", "bigint"), ("total_amount", "double"), ("note", "string")]
        assert rows_of(found) == [("SHIPPED", 1, 2.5, "07")]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_overwrite_replaces_and_round_trips(spark, fixture_tables, tmp_path, fmt):
    folder = str(tmp_path / "orders")
    schema = bronze_schema("orders")
    orders = fixture_tables["orders"].withColumn("source_system", F.lit("Orders"))
    files.write(orders.limit(1), folder, fmt)
    files.write(orders, folder, fmt)
    found = files.scan(spark, folder, schema, fmt)
    assert found.schema == schema
    assert rows_of(found) == rows_of(orders)


def test_append_adds_files(spark, fixture_tables, tmp_path):
    orders = fixture_tables["orders"].drop("timestamp")
    for _ in range(2):
        files.append(orders, str(tmp_path / "orders"))
    found = files.scan(spark, str(tmp_path / "orders"), raw_schema("orders"))
    assert rows_of(found) == rows_of(orders.unionAll(orders))


def test_counted_write(spark, tmp_path):
    assert files.write_counted(spark.range(1000).repartition(5), str(tmp_path / "a")) == 1000
    assert files.write_counted(spark.range(0), str(tmp_path / "b")) == 0


def test_optional_write(spark, fixture_tables, tmp_path):
    assert files.write_optional(None, str(tmp_path / "none")) is False
    assert not (tmp_path / "none").exists()
    empty = fixture_tables["orders"].drop("timestamp").filter("false")
    assert files.write_optional(empty, str(tmp_path / "empty")) is True
    texts = [open(name).read() for name in glob.glob(f"{tmp_path}/empty/*.csv")]
    assert texts == [ORDERS]


def test_staged_table_is_a_plain_scan(spark, fixture_tables, tmp_path):
    joined = fixture_tables["orders"].join(fixture_tables["customers"].select("customer_id"), "customer_id")
    stored = files.staged(joined, str(tmp_path / "staged"))
    assert rows_of(stored) == rows_of(joined)
    assert "Join" not in stored._jdf.queryExecution().toString()


def test_released_folder_is_gone(spark, tmp_path):
    files.staged(spark.range(100), str(tmp_path / "staged" / "one"))
    for _ in range(2):
        files.release(spark, str(tmp_path / "staged"))
        assert not (tmp_path / "staged").exists()


def test_zones_from_config():
    paths = {"output_folder": "s3://a/raw/", "bronze_folder": "s3://a/b", "silver_folder": "s3://a/s", "gold_folder": "s3://a/g"}
    assert Zones.from_config(paths) == Zones("s3://a/raw", "s3://a/b", "s3://a/s", "s3://a/g")


def test_folders():
    zones = Zones.under("gs://shop/data/")
    assert zones.raw_day("orders", "2025-02-20") == "gs://shop/data/raw_landing_zone/raw_orders/20250220"
    assert zones.bronze_table("orders", dt.date(2025, 2, 20)) == "gs://shop/data/bronze_landing_zone/bronze_orders/20250220/orders"
    assert zones.silver_table("products", "2025-02-20") == "gs://shop/data/silver_landing_zone/silver_products/20250220/products"
    assert zones.gold_table("fact_sales", "2025-02-20") == "gs://shop/data/gold_landing_zone/gold_analytics/20250220/fact_sales"
    assert zones.gold_table("orders", "2025-02-20") == "gs://shop/data/gold_landing_zone/gold_business_rules/20250220/orders"
    assert day("2025-02-20") == "20250220" and as_run_date("2024-02-29") == dt.date(2024, 2, 29)
    for wrong in ("20250220", "2025-13-01", "soon"):
        with pytest.raises(ValueError):
            as_run_date(wrong)


def test_file_uri(spark, tmp_path):
    folder = f"file://{tmp_path}/range"
    files.write(spark.range(3), folder, "parquet")
    assert files.scan(spark, folder, "id BIGINT", "parquet").count() == 3


VARIANTS = {
    "wide.csv": "customer_id,full_name,email,address,city,state\n1,A,a@,1 St,Boston,MA\n3,C,c@,3 St,Rome,NY\n",
    "narrow.csv": "customer_id,full_name,email,address,state\n2,B,b@,2 St,NY\n",
}


def test_variants_are_right_under_any_projection(spark, tmp_path):
    for name, text in VARIANTS.items():
        put(tmp_path, name, text)
    found = files.scan_csv_variants(spark, str(tmp_path), raw_schema("customers"), [customers_without_city()])
    assert rows_of(found.select("state")) == [("MA",), ("NY",), ("NY",)]
    assert rows_of(found.select("city")) == sorted([("Boston",), ("Rome",), (None,)], key=repr)
    assert rows_of(found.filter("state = 'NY'").select("customer_id")) == [(2,), (3,)]
    assert rows_of(found.groupBy("state").count()) == [("MA", 1), ("NY", 2)]


@pytest.mark.parametrize("header", ["customer_id,full_name,email,address,state,city", "customer_id,full_name,email,address,zip"])
def test_a_strange_header_beside_known_ones_raises(spark, tmp_path, header):
    put(tmp_path, "a.csv", VARIANTS["wide.csv"])
    put(tmp_path, "b.csv", f"{header}\n9,X,x@,9 St,TX,Houston\n")
    with pytest.raises(ValueError, match="b.csv"):
        files.scan_csv_variants(spark, str(tmp_path), raw_schema("customers"), [customers_without_city()])


def test_whole_numbers_with_a_fraction_of_zeros_stay(spark, tmp_path):
    put(tmp_path, "a.csv", "order_item_id,order_id,product_id,quantity,unit_price\n1.0,9007199254740993.0,3.,4.00,2.5\n2,1.5,x,-3,1\n")
    found = files.scan(spark, str(tmp_path), raw_schema("order_items"))
    assert found.schema == raw_schema("order_items")
    assert rows_of(found) == [(1, 9007199254740993, 3, 4, 2.5), (2, None, None, -3, 1.0)]


def test_white_space_of_texts_stays(spark, tmp_path):
    names = spark.createDataFrame([(1, " lead "), (2, "trail  ")], "product_id long, product_name string")
    files.write(names, str(tmp_path / "p"))
    assert rows_of(files.scan(spark, str(tmp_path / "p"), names.schema)) == rows_of(names)


def test_empty_texts_are_not_null(spark, tmp_path):
    names = spark.createDataFrame([(1, ""), (2, None), (3, ' "a", b ')], "product_id long, product_name string")
    files.write(names, str(tmp_path / "p"))
    found = files.scan(spark, str(tmp_path / "p"), names.schema)
    assert rows_of(found) == rows_of(names)
    assert rows_of(found.filter("product_name = ''")) == [(1, "")]
    put(tmp_path / "raw", "a.csv", f'{ORDERS}"",,7,"",""\n')
    assert rows_of(files.scan(spark, str(tmp_path / "raw"), raw_schema("orders"))) == [(None, None, 7, None, "")]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
@pytest.mark.parametrize("shape", ["tiny", "one"])
def test_files_near_a_size(spark, tmp_path, fmt, shape):
    """300 tiny partitions, most of them empty, or all rows in one: files are alike, and no row is lost."""
    rows = spark.range(0, 200_000, 1, 8).selectExpr("id AS product_id", "uuid(7) AS product_name")
    rows = rows.repartition(300, F.col("product_id") % 100) if shape == "tiny" else rows.repartition(1)
    files.write_sized(rows, str(tmp_path / "p"), 1 << 20, fmt)
    sizes = sorted(f.stat().st_size for f in (tmp_path / "p").glob(f"*.{fmt}*") if not f.name.startswith("."))
    assert 5 <= len(sizes) <= 24 and sizes[-1] < sum(sizes) / 3
    found = files.scan(spark, str(tmp_path / "p"), rows.schema, fmt)
    assert found.agg(F.count("*"), F.countDistinct("product_id", "product_name")).first()[:] == (200_000, 200_000)


def test_sized_files_of_an_empty_table(spark, tmp_path):
    files.write_sized(spark.range(0), str(tmp_path / "p"), 1 << 20, "parquet")
    assert files.scan(spark, str(tmp_path / "p"), "id long", "parquet").count() == 0


def test_packed_parts_are_read_with_plain_ones_and_other_gzip_files_are_not(spark, tmp_path):
    rows, folder = spark.createDataFrame([(1, "a\nb"), (2, "")], "id INT, t STRING").coalesce(1), str(tmp_path / "t")
    files.write(rows, folder, packed=True)
    assert [p.name[-7:] for p in (tmp_path / "t").glob("part-*")] == [".csv.gz"]
    files.append(rows, folder)
    shutil.copy(next((tmp_path / "t").glob("part-*.gz")), tmp_path / "t" / "delivered.csv.gz")
    for _ in range(2):
        assert rows_of(files.scan(spark, folder, "id INT")) == [(1, "a\nb")] * 2 + [(2, "")] * 2
        (tmp_path / "t" / "_line_breaks").unlink(missing_ok=True)
    files.write(rows.limit(0), folder, packed=True)
    assert files.scan_optional(spark, folder, "id INT").columns == ["id", "t"]
