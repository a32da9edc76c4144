from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from smeltery.schemas import silver_schema  # noqa: E402
from smeltery.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


def columns_of(table: str) -> str:
    """Schema of a silver table for hand-written rows, dates and times as text."""
    return ", ".join(
        f"{f.name} {'STRING' if f.dataType.simpleString() in ('date', 'timestamp') else f.dataType.simpleString()}"
        for f in silver_schema(table).fields
    )


def table_of(spark, table: str, rows):
    """Hand-written rows, without the trailing load time, as a silver-shaped table."""
    texts = spark.createDataFrame([(*row, "2025-02-20 01:02:03") for row in rows], columns_of(table))
    return texts.selectExpr(*(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in silver_schema(table)))


def rows_of(df) -> list[tuple]:
    """Rows in an order of their own, for comparing bags."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture(scope="session")
def fixture_tables(spark):
    """Gates, dangling keys, a repeated customer, a cancelled order and a NULL status."""
    day = "2025-02-20"
    rows = {
        "customers": [
            (1, "Customer 1", None, None, None, "NY"),
            (1, "Customer 1", None, None, None, "NY"),
            (2, "Customer 2", None, None, None, "CA"),
        ],
        "products": [(1, "Product 1", "Sports", 3.5), (2, "Product 2", "Sports", 0.0), (3, "Product 3", "Sports", None)],
        "orders": [
            (1, day, 1, 10.5, "SHIPPED"),
            (2, day, 1, 0.0, "PENDING"),
            (3, day, 2, 5.0, "CANCELLED"),
            (4, day, 9, 5.0, "SHIPPED"),
            (5, day, 1, None, "SHIPPED"),
            (6, day, 1, 7.0, None),
            (7, day, None, 7.0, "SHIPPED"),
            (8, day, 2, -1.0, "SHIPPED"),
        ],
        "order_items": [
            (1, 1, 1, 6, 187.56),
            (2, 3, 1, 2, 1.0),
            (3, 4, 1, 2, 1.0),
            (4, 1, 7, 1, 1.0),
            (5, 1, 1, 0, 1.0),
            (6, 1, 1, 1, -2.0),
            (7, 1, 1, None, 1.0),
            (8, 1, 1, 1, None),
            (9, None, 1, 1, 1.0),
        ],
    }
    return {name: table_of(spark, name, lines) for name, lines in rows.items()}
