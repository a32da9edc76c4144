"""The given star-schema tables as the four raw retail entities.

Every row of every table is mapped; none is left out. The tables are clean, so the cases the
layers exist for are put in through row values: zero, negative and NULL amounts, NULL status,
and customer and product keys that refer to nothing or are NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.schemas import raw_schema
from smeltery.session import stored_bytes, tune

# The columns used, declared so that no job runs just to look up a schema.
_GIVEN = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING"
    ),
}

_sizes: dict[str, int] = {}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_GIVEN[table]).parquet(f"{sf_dir}/{table}.parquet")


def prepare(spark: SparkSession, sf_dir: str) -> SparkSession:
    """Fit the session to the size of the tables the queries read."""
    if sf_dir not in _sizes:
        _sizes[sf_dir] = stored_bytes(spark, *(f"{sf_dir}/{name}.parquet" for name in _GIVEN))
    return tune(spark, _sizes[sf_dir])


# One select list per entity.
_ENTITIES = {
    "customers": ("customer", (
        "c_custkey AS customer_id",
        "c_name AS full_name",
        "concat('customer', c_custkey, '@example.com') AS email",
        "concat(c_nationkey, ' Main St') AS address",
        "concat('City ', c_nationkey) AS city",
        "c_mktsegment AS state",
    )),
    "products": ("part", (
        "p_partkey AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "CASE WHEN p_size <= 3 THEN 0D WHEN p_size <= 6 THEN -p_retailprice WHEN p_size <= 9 THEN NULL "
        "ELSE p_retailprice END AS price",
    )),
    "orders": ("orders", (
        "o_orderkey AS order_id",
        "CAST(o_orderdate AS DATE) AS order_date",
        "CASE o_orderpriority WHEN '5-LOW' THEN -1 - o_custkey WHEN '4-NOT SPECIFIED' THEN NULL "
        "ELSE o_custkey END AS customer_id",
        "CASE WHEN o_totalprice < 20000 THEN 0D WHEN o_totalprice < 40000 THEN -o_totalprice "
        "WHEN o_totalprice < 60000 THEN NULL ELSE o_totalprice END AS total_amount",
        "CASE WHEN o_totalprice > 450000 THEN NULL WHEN o_orderstatus = 'F' THEN 'CANCELLED' "
        "WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE 'SHIPPED' END AS order_status",
    )),
    "order_items": ("lineitem", (
        "l_orderkey * 10 + l_linenumber AS order_item_id",
        "l_orderkey AS order_id",
        "IF(l_returnflag = 'R' AND l_linestatus = 'F', -1 - l_partkey, l_partkey) AS product_id",
        "IF(l_quantity < 3, 0, CAST(l_quantity AS INT)) AS quantity",
        "CASE WHEN l_extendedprice < 3000 THEN 0D WHEN l_extendedprice < 5000 THEN -l_extendedprice "
        "WHEN l_extendedprice < 7000 THEN NULL ELSE l_extendedprice END AS unit_price",
    )),
}


def raw(spark: SparkSession, sf_dir: str, *tables: str) -> dict[str, DataFrame]:
    """The named raw tables, or all four."""
    prepare(spark, sf_dir)
    entities = {name: _ENTITIES[name] for name in tables or _ENTITIES}
    return {name: given(spark, sf_dir, source).selectExpr(*columns) for name, (source, columns) in entities.items()}


def with_repeated_customers(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The same batch with one customer segment delivered a second time."""
    customers = raw["customers"]
    return {**raw, "customers": customers.unionByName(customers.filter(F.col("state") == "BUILDING"))}


def with_hot_keys(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The same batch with about a third of all orders on one customer, and a third of all
    items on one order and (another third) on one product."""
    shipped = F.col("order_status") == "SHIPPED"
    return {
        **raw,
        "orders": raw["orders"].withColumn("customer_id", F.when(shipped, 0).otherwise(F.col("customer_id"))),
        "order_items": raw["order_items"].withColumns({
            "order_id": F.when(F.col("quantity") > 33, 0).otherwise(F.col("order_id")),
            "product_id": F.when(F.col("quantity").between(17, 33), 0).otherwise(F.col("product_id")),
        }),
    }


def as_raw_files(table: str, df: DataFrame) -> DataFrame:
    """Columns and types of the raw file schema."""
    return df.select(*(F.col(f.name).cast(f.dataType) for f in raw_schema(table)))
