"""Every registered retail query against its SQL on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from retail_queries.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
GIVEN = ("customer", "part", "orders", "lineitem")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


def bag(table):
    return sorted(repr([row[name] for name in sorted(row)]) for row in table.to_pylist())


def test_every_retail_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sql, name):
    found = contract.queries()[name](spark, SF_DIR).toArrow()
    wanted = sql.sql(contract.oracle_sql()[name]).to_arrow_table()
    assert sorted(found.column_names) == sorted(wanted.column_names)
    assert {f.name: str(f.type) for f in found.schema} == {f.name: str(f.type) for f in wanted.schema}
    assert bag(found) == bag(wanted)
    assert found.num_rows > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_hot_batch_is_skewed(spark):
    """The hot-key queries do what their name says: about a third of the rows on one key."""
    from retail_queries import adapter

    raw = adapter.with_hot_keys(adapter.raw(spark, SF_DIR))
    for table, key in (("orders", "customer_id"), ("order_items", "order_id"), ("order_items", "product_id")):
        rows = raw[table].count()
        assert raw[table].filter(f"{key} = 0").count() > rows / 4
