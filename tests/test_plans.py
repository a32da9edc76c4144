"""Plan shape: what reaches the scan, what is shuffled, and how hot keys are split."""

import re

import pytest
from pyspark.sql import functions as F

from smeltery.operators import sales
from smeltery.plans.layers import to_bronze, to_gold, to_silver
from smeltery.schemas import TABLES, raw_schema
from smeltery.session import key_filter, settings
from smeltery.sources import files


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.toArrow()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture(scope="module")
def stored(spark, fixture_tables, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    tables = {}
    for name in TABLES:
        files.write(fixture_tables[name].drop("timestamp"), str(root / name), "parquet")
        tables[name] = files.scan(spark, str(root / name), raw_schema(name), "parquet")
    return tables


@pytest.fixture
def no_broadcast(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_gates_and_columns_reach_the_scan(stored):
    gold = to_gold(to_silver(to_bronze(stored)))
    plan = initial_plan(gold["fact_sales"])
    assert "GreaterThan(total_amount,0.0)" in plan
    assert "GreaterThan(quantity,0)" in plan and "GreaterThan(unit_price,0.0)" in plan
    assert "GreaterThan(price,0.0)" in plan
    assert "ReadSchema: struct<customer_id:bigint>" in plan
    assert "ReadSchema: struct<product_id:bigint,product_name:string,price:double>" in plan
    assert "order_item_id" not in plan and "order_status" not in plan and "email" not in plan


def test_csv_gate_reaches_the_scan(spark, fixture_tables, tmp_path):
    files.write(fixture_tables["orders"].drop("timestamp"), str(tmp_path))
    silver = files.scan(spark, str(tmp_path), raw_schema("orders")).filter("total_amount > 0")
    assert "GreaterThan(total_amount,0.0)" in initial_plan(silver)


def test_only_equi_joins(stored, no_broadcast):
    for df in to_gold(to_silver(to_bronze(stored))).values():
        plan = initial_plan(df)
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_bronze_and_silver_do_not_shuffle(stored):
    for df in to_silver(to_bronze(stored)).values():
        assert "Exchange" not in initial_plan(df)


def test_items_are_shuffled_once_for_both_order_joins(stored, no_broadcast):
    silver = to_silver(to_bronze(stored))
    lines = sales.order_lines(silver["order_items"], sales.valid_orders(silver["orders"], silver["customers"]))
    # Orders and customers for the check, the same for the columns, and the items: on order_id
    # there are two exchanges of orders and one of items.
    assert len(re.findall(r"Exchange hashpartitioning\(order_id", initial_plan(lines))) == 3
    unique = sales.order_lines(
        silver["order_items"], sales.valid_orders(silver["orders"], silver["customers"], keys_unique=True), keys_unique=True
    )
    assert len(re.findall(r"Exchange hashpartitioning\(order_id", initial_plan(unique))) == 2


def test_active_items_on_staged_lines_do_not_shuffle(spark, stored, tmp_path):
    staged = {}

    def stage(name, df):
        staged[name] = files.staged(df, str(tmp_path / name))
        return staged[name]

    gold = to_gold(to_silver(to_bronze(stored)), stage=stage)
    assert set(staged) == {"valid_orders", "order_lines"}
    for name in ("orders", "order_items"):
        plan = initial_plan(gold[name])
        assert "Exchange" not in plan and "Join" not in plan
    assert len(re.findall("Join", initial_plan(gold["fact_sales"]))) == 1


def _below(n, salt):
    return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A third of orders on one customer; a third of items on one order and on one product."""
    root, n = tmp_path_factory.mktemp("hot"), 200_000
    hot_or = lambda salt, m: F.when(_below(3, salt) == 0, 7).otherwise(_below(m, salt + 1)).cast("long")
    tables = {
        "customers": spark.range(20_000).select(F.col("id").alias("customer_id")),
        "products": spark.range(20_000).selectExpr("id AS product_id", "concat('P ', id) AS product_name"),
        "orders": spark.range(n).selectExpr(
            "id AS order_id", "id", "DATE '2025-01-01' AS order_date", "id + 1.5D AS total_amount", "'SHIPPED' AS order_status"
        ).withColumn("customer_id", hot_or(1, 20_000)).drop("id"),
        "order_items": spark.range(3 * n).selectExpr("id", "2 AS quantity", "id + 1.5D AS unit_price").withColumns(
            {"order_id": hot_or(3, n), "product_id": hot_or(5, 20_000)}
        ).drop("id"),
    }
    for name, df in tables.items():
        df.repartition(8).write.parquet(str(root / name))
    return {name: spark.read.parquet(str(root / name)) for name in tables}


def test_hot_keys_are_split_in_every_join(hot, no_broadcast):
    valid = sales.valid_orders(hot["orders"], hot["customers"])
    plan = final_plan(sales.fact_sales(sales.order_lines(hot["order_items"], valid), hot["products"]))
    joins = re.findall(r"SortMergeJoin(\(skew=true\))? \[(\w+)_id", plan)
    assert len(joins) == 5 and all(skew for skew, _ in joins), joins


def test_hot_keys_under_unique_keys(hot, no_broadcast):
    valid = sales.valid_orders(hot["orders"], hot["customers"], keys_unique=True)
    lines = sales.order_lines(hot["order_items"], valid, keys_unique=True)
    plan = final_plan(sales.fact_sales(lines, hot["products"]))
    joins = re.findall(r"SortMergeJoin(\(skew=true\))? \[(\w+)_id", plan)
    assert len(joins) == 3 and all(skew for skew, _ in joins), joins


def test_split_joins_keep_every_row(hot, no_broadcast):
    """Unique customers, orders and products: each item is one fact row."""
    valid = sales.valid_orders(hot["orders"], hot["customers"])
    fact = sales.fact_sales(sales.order_lines(hot["order_items"], valid), hot["products"])
    row = fact.agg(F.count(F.lit(1)), F.sum("line_total"), F.count_if(F.col("order_id") == 7)).first()
    items = hot["order_items"].agg(
        F.count(F.lit(1)), F.sum(F.col("quantity") * F.col("unit_price")), F.count_if(F.col("order_id") == 7)
    ).first()
    assert (row[0], row[2]) == (items[0], items[2])
    assert row[1] == pytest.approx(items[1])


def test_a_hot_order_of_less_than_256_mb_is_split(spark, tmp_path):
    """Under the settings that the plans run with, at the number of partitions that small inputs get."""
    spark.range(0, 6_000_000, 1, 8).selectExpr(
        "IF(id % 3 = 0, id % 100000, 7) AS order_id", "xxhash64(id) AS product_id", "CAST(id % 50 AS INT) AS quantity", "rand(1) AS unit_price"
    ).write.parquet(str(tmp_path / "items"))
    valid = spark.range(100_000).selectExpr(
        "id AS order_id", "id AS customer_id", "DATE '2025-01-01' AS order_date", "id + 1.5D AS total_amount", "'SHIPPED' AS order_status"
    )
    values = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    with settings(spark, values):
        lines = sales.order_lines(spark.read.parquet(str(tmp_path / "items")), valid, keys_unique=True).agg(F.count("*"), F.sum("quantity"), F.max("product_id"), F.max("unit_price"))
        assert re.findall(r"SortMergeJoin(\(skew=true\))? \[(\w+)_id", final_plan(lines)) == [("(skew=true)", "order")]
        assert lines.first()[:2] == (6_000_000, sum(range(50)) * 120_000)


def test_a_hot_order_is_split_in_both_order_joins(spark, tmp_path):
    """As hot_active_order_items joins it, without a promise of unique keys: the rows of the first join are dealt anew, and split again."""
    spark.range(0, 6_000_000, 1, 8).selectExpr(
        "IF(id % 3 = 0, id % 100000, 7) AS order_id", "xxhash64(id) AS product_id", "CAST(id % 50 AS INT) AS quantity", "rand(1) AS unit_price"
    ).write.parquet(str(tmp_path / "items"))
    valid = spark.range(100_000).selectExpr(
        "id AS order_id", "id AS customer_id", "DATE '2025-01-01' AS order_date", "id + 1.5D AS total_amount", "'SHIPPED' AS order_status"
    )
    values = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    with settings(spark, values):
        active = sales.active_order_items(sales.order_lines(spark.read.parquet(str(tmp_path / "items")), valid))
        found = active.agg(F.count("*"), F.sum("quantity"), F.max("product_id"), F.max("unit_price"))
        assert re.findall(r"SortMergeJoin(\(skew=true\))? \[(\w+)_id", final_plan(found)) == [("(skew=true)", "order")] * 2
        assert found.first()[:2] == (5_880_000, sum(range(50)) * 120_000)


def shuffled_rows(df) -> list[int]:
    """Rows that each shuffle of a plan that has run has written."""
    def of(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return of(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return of(plan.plan())
        mine = [plan.metrics().apply("shuffleRecordsWritten").value()] if name == "ShuffleExchangeExec" else []
        children = plan.children()
        return mine + [n for i in range(children.size()) for n in of(children.apply(i))]

    df.toArrow()
    return of(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("once", [False, True])
def test_items_without_a_valid_order_are_left_out_before_their_shuffle(spark, hot, no_broadcast, tmp_path, once):
    valid = files.staged(hot["orders"].filter("order_id % 10 = 3 OR order_id = 7"), str(tmp_path / "valid"))
    items, orders = hot["order_items"].count(), valid.count()
    found = {}
    for keys in (orders, 10**9):
        values = key_filter(keys)
        if keys == orders:
            values["spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"] = "0"
        with settings(spark, values):
            lines = sales.order_lines(hot["order_items"], valid, keys_unique=once)
            found[keys] = max(shuffled_rows(lines)), lines.agg(F.count("*"), F.sum("order_id"), F.sum("product_id")).first()
    assert found[10**9][0] == items
    left = found[orders][1][0]
    assert left < found[orders][0] + 1 < 1.1 * left + 0.1 * items < 0.6 * items
    assert found[orders][1] == found[10**9][1]


def test_least_and_null_keys_join_as_ever(spark):
    valid = spark.sql("SELECT id AS order_id, 1L AS customer_id, current_date() AS order_date, 1.5D AS total_amount, 'S' AS order_status FROM VALUES (-9223372036854775808L), (NULL), (5L) AS t(id)")
    items = spark.sql("SELECT id AS order_id, 1L AS product_id, 1 AS quantity, 1.5D AS unit_price FROM VALUES (-9223372036854775808L), (NULL), (5L), (6L) AS t(id)")
    for once in (False, True):
        assert [r[0] for r in sales.order_lines(items, valid, keys_unique=once).select("order_id").orderBy("order_id").collect()] == [-(1 << 63), 5]
