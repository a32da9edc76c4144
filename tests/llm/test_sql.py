"""The operators' queries against their SQL on the smallest given tables."""

import duckdb
import pytest

from smeltery.llm.oracle import ORACLE
from smeltery.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


def bag(table):
    return sorted(repr([row[name] for name in sorted(row)]) for row in table.to_pylist())


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql(spark, sql, name):
    found = QUERIES[name](spark, SF_DIR).toArrow()
    wanted = sql.sql(ORACLE[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in found.schema} == {f.name: str(f.type) for f in wanted.schema}
    assert bag(found) == bag(wanted)
    assert found.num_rows > 0
