import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from smeltery.operators import sales
from smeltery.operators.audit import row_counts, with_audit
from smeltery.operators.quality import (
    drop_columns, has_column, is_unique, keep_valid, require_columns, required_columns_report,
)
from smeltery.plans.layers import to_bronze, to_gold, to_silver
from smeltery.schemas import AUDIT_TIME, SOURCE_SYSTEM, SOURCE_SYSTEMS, TABLES, raw_schema
from tests.conftest import rows_of

DAY = dt.date(2025, 2, 20)


@pytest.fixture(scope="module")
def silver(fixture_tables):
    return to_silver({name: df.withColumn(SOURCE_SYSTEM, F.lit("x")) for name, df in fixture_tables.items()})


@pytest.fixture(scope="module")
def gold(silver):
    return to_gold(silver)


def ids(df, column):
    return sorted(row[0] for row in df.select(column).collect())


def test_bronze_adds_time_and_label(spark, fixture_tables):
    raw = {name: df.drop(AUDIT_TIME) for name, df in fixture_tables.items()}
    loaded = F.lit("2025-02-20 04:05:06").cast("timestamp")
    for name, df in to_bronze(raw, loaded).items():
        assert df.columns == [*raw_schema(name).names, AUDIT_TIME, SOURCE_SYSTEM]
        kept = df.select(AUDIT_TIME, SOURCE_SYSTEM).distinct().collect()
        assert [tuple(row) for row in kept] == [(dt.datetime(2025, 2, 20, 4, 5, 6), SOURCE_SYSTEMS[name])]


def test_bronze_time_is_one_instant_per_action(fixture_tables):
    stamped = with_audit(fixture_tables["orders"].drop(AUDIT_TIME), "Orders")
    assert stamped.select(AUDIT_TIME).distinct().count() == 1


def test_row_counts_use_source_labels(fixture_tables):
    assert rows_of(row_counts(fixture_tables)) == [
        ("Customer Data", 3), ("Order Items", 9), ("Orders", 8), ("Products", 3)
    ]


def test_gates_drop_zero_negative_and_null(silver):
    assert ids(silver["orders"], "order_id") == [1, 3, 4, 6, 7]
    assert ids(silver["products"], "product_id") == [1]
    assert [r[0] for r in silver["order_items"].select("order_item_id").orderBy("order_item_id").collect()] == [1, 2, 3, 4, 9]
    assert silver["customers"].count() == 3


def test_silver_drops_label_and_keeps_time(silver):
    for name in TABLES:
        assert silver[name].columns == [*raw_schema(name).names, AUDIT_TIME]


def test_required_columns(fixture_tables):
    require_columns(fixture_tables)
    for table, column in (("orders", "customer_id"), ("customers", "customer_id"), ("order_items", "order_id"), ("orders", "order_id")):
        broken = {**fixture_tables, table: fixture_tables[table].drop(column)}
        with pytest.raises(ValueError, match=f"Required column '{column}' missing"):
            require_columns(broken)
        absent = [r for r in required_columns_report(broken).collect() if not r["present"]]
        assert [(r["table_name"], r["column_name"]) for r in absent] == [(table, column)]


def test_missing_gated_column_raises(spark):
    with pytest.raises(AnalysisException) as raised:
        keep_valid("orders", spark.range(1))
    assert raised.value.getCondition().startswith("UNRESOLVED_COLUMN")


def test_column_helpers(fixture_tables):
    orders = fixture_tables["orders"]
    assert has_column(orders, "order_id") and not has_column(orders, "nope") and not has_column(None, "order_id")
    assert drop_columns(None, "x") is None
    assert drop_columns(orders, "nope", "order_id").columns == orders.columns[1:]


def test_valid_orders_keep_fan_out(silver):
    valid = sales.valid_orders(silver["orders"], silver["customers"])
    assert ids(valid, "order_id") == [1, 1, 3, 6, 6]
    items = sales.valid_order_items(silver["order_items"], valid)
    assert rows_of(items) == [(1, 1, 6, 187.56)] * 2 + [(1, 7, 1, 1.0)] * 2 + [(3, 1, 2, 1.0)]


def test_fact_sales(gold):
    assert gold["fact_sales"].columns == list(sales.FACT_COLUMNS)
    shipped = (1, 1, DAY, 1, "Product 1", 6, 187.56, 1125.3600000000001, 10.5)
    cancelled = (3, 2, DAY, 1, "Product 1", 2, 1.0, 2.0, 5.0)
    assert rows_of(gold["fact_sales"]) == [shipped] * 4 + [cancelled]


def test_active_orders_and_items(gold):
    assert gold["orders"].columns == list(sales.ORDER_COLUMNS)
    assert ids(gold["orders"], "order_id") == [1, 1]
    assert gold["order_items"].columns == [*sales.ITEM_COLUMNS, *sales.ORDER_COLUMNS[1:]]
    order = (1, DAY, 10.5, "SHIPPED")
    assert rows_of(gold["order_items"]) == [(1, 1, 6, 187.56, *order)] * 4 + [(1, 7, 1, 1.0, *order)] * 4


def test_masters_lose_audit_columns_only(gold):
    for name in ("customers", "products"):
        assert gold[name].columns == raw_schema(name).names


def test_status_is_case_sensitive(spark):
    valid = spark.createDataFrame([(1, 1, 1.0, "cancelled"), (2, 1, 1.0, "CANCELLED")], "order_id INT, c INT, total_amount DOUBLE, order_status STRING")
    assert ids(sales.active_orders(valid), "order_id") == [1]


def test_inactive_sales(gold):
    assert rows_of(sales.inactive_sales(gold["fact_sales"], gold["orders"]).select("order_id")) == [(3,)]


def test_unique_keys_give_the_same_rows(silver):
    unique = {**silver, "customers": silver["customers"].dropDuplicates(["customer_id"])}
    exact, fast = to_gold(unique), to_gold(unique, keys_unique=True)
    for name in exact:
        assert fast[name].columns == exact[name].columns
        assert rows_of(fast[name]) == rows_of(exact[name])


def test_uniqueness_check_decides_for_one_join_per_item(spark, silver):
    assert not is_unique(silver["customers"], "customer_id") and is_unique(silver["orders"], "order_id")
    assert is_unique(spark.createDataFrame([], "a INT"), "a")
    asked = []

    def check(valid):
        asked.append(is_unique(valid, "order_id"))
        return asked[-1]

    unique = {**silver, "customers": silver["customers"].dropDuplicates(["customer_id"])}
    for tables in (silver, unique):
        exact, checked = to_gold(tables), to_gold(tables, check=check)
        for name in exact:
            assert checked[name].columns == exact[name].columns
            assert rows_of(checked[name]) == rows_of(exact[name])
    assert asked == [False, True]


def test_repeated_order_rows_multiply(spark, silver):
    """Two order rows of one id, k=2 and k=1 customers: 3 valid rows, each item 3 times, 9 lines."""
    again = silver["orders"].filter("order_id = 1").withColumn("customer_id", F.lit(2).cast("long"))
    tables = {**silver, "orders": silver["orders"].unionByName(again)}
    valid = sales.valid_orders(tables["orders"], tables["customers"])
    assert ids(valid, "order_id").count(1) == 3
    assert to_gold(tables)["fact_sales"].filter("order_id = 1").count() == 9


# --- missing silver tables -------------------------------------------------------------------


def test_without_customers_every_silver_order_is_valid(silver):
    gold = to_gold({**silver, "customers": None})
    assert gold["customers"] is None
    assert gold["orders"].columns == raw_schema("orders").names
    assert ids(gold["orders"], "order_id") == [1, 4, 7]
    assert gold["order_items"].columns == [*sales.ITEM_COLUMNS, "order_date", "customer_id", "total_amount", "order_status"]
    assert [r[0] for r in rows_of(gold["order_items"])] == [1, 1, 4]
    assert [r[0] for r in rows_of(gold["fact_sales"])] == [1, 3, 4]
    assert gold["fact_sales"].columns == list(sales.FACT_COLUMNS)


def test_without_orders_items_pass_unfiltered(silver):
    gold = to_gold({**silver, "orders": None})
    assert gold["fact_sales"] is None and gold["orders"] is None
    assert gold["order_items"].columns == raw_schema("order_items").names
    assert rows_of(gold["order_items"]) == rows_of(silver["order_items"].drop(AUDIT_TIME))


def test_without_items_valid_orders_pass_unfiltered(silver):
    gold = to_gold({**silver, "order_items": None})
    assert gold["fact_sales"] is None and gold["order_items"] is None
    assert ids(gold["orders"], "order_id") == [1, 1, 3, 6, 6]


def test_without_products_there_is_no_fact(silver, gold):
    partial = to_gold({**silver, "products": None})
    assert partial["fact_sales"] is None and partial["products"] is None
    assert rows_of(partial["order_items"]) == rows_of(gold["order_items"])


def test_without_orders_and_customers(silver):
    gold = to_gold({"products": silver["products"], "order_items": silver["order_items"]})
    assert [name for name, df in gold.items() if df is not None] == ["order_items", "products"]


def test_nothing_there():
    assert set(to_gold({}).values()) == {None}
