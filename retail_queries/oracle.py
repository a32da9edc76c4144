"""The same queries as plain SQL over the given tables."""

from __future__ import annotations

from smeltery.schemas import MARTS, SOURCE_SYSTEMS, TABLES

_RAW = {
    "raw_customers": """
        SELECT c_custkey AS customer_id, c_name AS full_name,
          'customer' || c_custkey || '@example.com' AS email, c_nationkey || ' Main St' AS address,
          'City ' || c_nationkey AS city, c_mktsegment AS state
        FROM customer""",
    "raw_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
          CASE WHEN p_size <= 3 THEN 0.0 WHEN p_size <= 6 THEN -p_retailprice
               WHEN p_size <= 9 THEN NULL ELSE p_retailprice END AS price
        FROM part""",
    "raw_orders": """
        SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
          CASE WHEN o_orderpriority = '5-LOW' THEN -1 - o_custkey
               WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_custkey END AS customer_id,
          CASE WHEN o_totalprice < 20000 THEN 0.0 WHEN o_totalprice < 40000 THEN -o_totalprice
               WHEN o_totalprice < 60000 THEN NULL ELSE o_totalprice END AS total_amount,
          CASE WHEN o_totalprice > 450000 THEN NULL WHEN o_orderstatus = 'F' THEN 'CANCELLED'
               WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE 'SHIPPED' END AS order_status
        FROM orders""",
    "raw_order_items": """
        SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
          CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -1 - l_partkey ELSE l_partkey END AS product_id,
          CASE WHEN l_quantity < 3 THEN 0 ELSE CAST(l_quantity AS INT) END AS quantity,
          CASE WHEN l_extendedprice < 3000 THEN 0.0 WHEN l_extendedprice < 5000 THEN -l_extendedprice
               WHEN l_extendedprice < 7000 THEN NULL ELSE l_extendedprice END AS unit_price
        FROM lineitem""",
}

# Replacements for single raw tables, as in the adapter's two changed batches.
_REPEATED = {
    "raw_customers": f"""
        SELECT * FROM ({_RAW["raw_customers"]}) AS a
        UNION ALL SELECT * FROM ({_RAW["raw_customers"]}) AS b WHERE state = 'BUILDING'""",
}
_HOT = {
    "raw_orders": f"""
        SELECT order_id, order_date, CASE WHEN order_status = 'SHIPPED' THEN 0 ELSE customer_id END AS customer_id,
          total_amount, order_status
        FROM ({_RAW["raw_orders"]}) AS a""",
    "raw_order_items": f"""
        SELECT order_item_id, CASE WHEN quantity > 33 THEN 0 ELSE order_id END AS order_id,
          CASE WHEN quantity BETWEEN 17 AND 33 THEN 0 ELSE product_id END AS product_id, quantity, unit_price
        FROM ({_RAW["raw_order_items"]}) AS a""",
}

_GATES = {
    "customers": "true",
    "products": "price > 0",
    "orders": "total_amount > 0",
    "order_items": "quantity > 0 AND unit_price > 0",
}

_LOADED = "TIMESTAMP '2025-02-20 00:00:00' AS \"timestamp\""

_LAYERS = {
    **{
        f"bronze_{name}": f"SELECT *, {_LOADED}, '{label}' AS source_system FROM raw_{name}"
        for name, label in SOURCE_SYSTEMS.items()
    },
    **{f"silver_{name}": f"SELECT *, {_LOADED} FROM raw_{name} WHERE {gate}" for name, gate in _GATES.items()},
    "valid_orders": """
        SELECT o.order_id, o.customer_id, o.order_date, o.total_amount, o.order_status
        FROM silver_orders o JOIN silver_customers c ON o.customer_id = c.customer_id""",
    "valid_order_items": """
        SELECT oi.order_id, oi.product_id, oi.quantity, oi.unit_price
        FROM silver_order_items oi JOIN valid_orders o ON oi.order_id = o.order_id""",
    "order_lines": """
        SELECT oi.order_id, oi.product_id, oi.quantity, oi.unit_price, o.customer_id, o.order_date,
          o.total_amount, o.order_status
        FROM valid_order_items oi JOIN valid_orders o ON oi.order_id = o.order_id""",
    "fact_sales": """
        SELECT o.order_id, o.customer_id, o.order_date, oi.product_id, p.product_name, oi.quantity, oi.unit_price,
          oi.quantity * oi.unit_price AS line_total, o.total_amount
        FROM valid_orders o JOIN valid_order_items oi ON o.order_id = oi.order_id
        JOIN silver_products p ON oi.product_id = p.product_id""",
    "active_orders": "SELECT * FROM valid_orders WHERE order_status <> 'CANCELLED' AND total_amount > 0",
    "active_order_items": """
        SELECT oi.order_id, oi.product_id, oi.quantity, oi.unit_price, o.customer_id, o.order_date,
          o.total_amount, o.order_status
        FROM valid_order_items oi JOIN active_orders o ON oi.order_id = o.order_id
        WHERE oi.quantity > 0 AND oi.unit_price > 0""",
}

_WITHOUT_CUSTOMERS = {
    "valid_orders": "SELECT order_id, order_date, customer_id, total_amount, order_status FROM silver_orders"
}


def _sql(body: str, **replaced: str) -> str:
    parts = _RAW | _LAYERS | replaced
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in parts.items())
    return f"WITH {ctes}\n{body}"


def _table(name: str, **replaced: str) -> str:
    return _sql(f"SELECT * FROM {name}", **replaced)


_LABELLED_COUNTS = " UNION ALL ".join(
    f"SELECT '{label}' AS source_system, count(*) AS row_count FROM raw_{name}" for name, label in SOURCE_SYSTEMS.items()
)

_GOLD = {
    "fact_sales": "fact_sales", "customers": "raw_customers", "orders": "active_orders",
    "order_items": "active_order_items", "products": "silver_products",
}

_OUTPUT_COUNTS = " UNION ALL ".join(
    f"SELECT '{MARTS[name]}' AS mart, '{name}' AS table_name, count(*) AS row_count FROM {source}"
    for name, source in _GOLD.items()
)

_UNPARSED = {"orders": "order_status = 'PENDING'", "order_items": "quantity > 33"}

_KEYS = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "order_items": "order_item_id"}

_MARKS = {
    "marks": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, max({key}) AS last_id, count(*) AS n FROM raw_{name}"
        for name, key in _KEYS.items()
    )
}


_NO_TIME = 'SELECT * EXCLUDE ("timestamp") FROM '

ORACLE: dict[str, str] = {
    **{f"bronze_{name}": _table(f"bronze_{name}") for name in TABLES},
    "bronze_row_counts": _sql(_LABELLED_COUNTS),
    "bronze_written_counts": _sql(_LABELLED_COUNTS),
    **{f"silver_{name}": _table(f"silver_{name}") for name in TABLES},
    "item_line_totals": _sql(
        "SELECT order_item_id, order_id, product_id, quantity * unit_price AS line_total FROM silver_order_items"
    ),
    **{
        name: _table(name)
        for name in ("valid_orders", "valid_order_items", "order_lines", "fact_sales", "active_orders", "active_order_items")
    },
    "gold_customers": _sql(f"{_NO_TIME} silver_customers"),
    "gold_products": _sql(f"{_NO_TIME} silver_products"),
    "fact_not_active": _sql("""
        SELECT f.* FROM fact_sales f LEFT JOIN active_orders a ON f.order_id = a.order_id WHERE a.order_id IS NULL"""),
    "unique_keys_fact_sales": _table("fact_sales"),
    "unique_keys_order_items": _table("active_order_items"),
    "fan_valid_orders": _table("valid_orders", **_REPEATED),
    "fan_valid_order_items": _table("valid_order_items", **_REPEATED),
    "fan_fact_sales": _table("fact_sales", **_REPEATED),
    "fan_active_order_items": _table("active_order_items", **_REPEATED),
    "hot_valid_orders": _table("valid_orders", **_HOT),
    "hot_fact_sales": _table("fact_sales", **_HOT),
    "hot_active_order_items": _table("active_order_items", **_HOT),
    "no_customers_orders": _table("active_orders", **_WITHOUT_CUSTOMERS),
    "no_customers_order_items": _table("active_order_items", **_WITHOUT_CUSTOMERS),
    "no_customers_fact_sales": _table("fact_sales", **_WITHOUT_CUSTOMERS),
    "no_orders_order_items": _sql(f"{_NO_TIME} silver_order_items"),
    "no_order_items_orders": _table("valid_orders"),
    "no_products_order_items": _table("active_order_items"),
    "order_day_folders": _sql("""
        SELECT order_id, 'raw/raw_orders/' || strftime(order_date, '%Y%m%d') AS folder, order_date AS run_date
        FROM raw_orders"""),
    "csv_round_trip_orders": _table("raw_orders"),
    "csv_round_trip_order_items": _table("raw_order_items"),
    "parquet_round_trip_products": _table("raw_products"),
    "csv_overwrite_orders": _table("raw_orders"),
    "csv_two_runs_orders": _sql("SELECT * FROM raw_orders UNION ALL SELECT * FROM raw_orders"),
    "csv_header_variants": _sql("""
        SELECT customer_id, full_name, email, address, CASE WHEN state <> 'BUILDING' THEN city END AS city, state
        FROM raw_customers"""),
    "medallion_fact_sales": _table("fact_sales"),
    "medallion_orders": _table("active_orders"),
    "medallion_order_items": _table("active_order_items"),
    "medallion_output_counts": _sql(_OUTPUT_COUNTS),
    "gold_files_without_products": _table("active_order_items"),
    "external_customer": """
        SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal,
          CAST(NULL AS VARCHAR) AS loyalty_tier
        FROM customer""",
    "external_outputs": """
        SELECT o_orderkey AS order_id, o_totalprice AS amount FROM orders
        UNION ALL SELECT l_orderkey, l_extendedprice FROM lineitem""",
    "external_year_folders": """
        SELECT o_orderkey AS order_id, CAST(year(o_orderdate) AS VARCHAR) AS year
        FROM orders WHERE year(o_orderdate) IN (1994, 1996)""",
    "id_high_water": _sql("SELECT table_name, last_id, last_id + 1 AS next_id FROM marks", **_MARKS),
}

_BREAKS = f"""
    SELECT product_id, CASE product_id % 6 WHEN 0 THEN chr(10) || product_name || chr(10)
        WHEN 1 THEN product_name || chr(13) || chr(10) || product_name
        WHEN 2 THEN 'say "' || chr(10) || product_name || '",' || chr(10) || '"twice"'
        WHEN 3 THEN product_name || chr(92) || chr(10) || chr(92)
        WHEN 4 THEN product_name || chr(13) || product_name ELSE product_name END AS product_name, category, price
    FROM ({_RAW["raw_products"]}) AS a"""


def _rule(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '{column}_missing' WHEN NOT {column} > 0 THEN '{column}_not_positive' END"


_RULES = {
    name: f"nullif(concat_ws('+', {', '.join(_rule(gate.split()[0]) for gate in gates.split(' AND '))}), '')"
    if gates != "true" else "CAST(NULL AS VARCHAR)"
    for name, gates in _GATES.items()
}

_DAYS = {
    "day_orders": """
        SELECT *, CASE order_status WHEN 'PENDING' THEN DATE '2025-02-20' WHEN 'SHIPPED' THEN DATE '2025-02-19'
          ELSE DATE '2025-02-21' END AS run_date FROM valid_orders""",
    "day_items": """
        SELECT *, CASE WHEN quantity > 33 THEN DATE '2025-02-20' WHEN quantity > 16 THEN DATE '2025-02-19'
          ELSE DATE '2025-02-21' END AS run_date FROM silver_order_items""",
}

ORACLE |= {
    "days_fact_sales": _sql("""
        SELECT o.order_id, o.customer_id, o.order_date, oi.product_id, p.product_name, oi.quantity, oi.unit_price,
          oi.quantity * oi.unit_price AS line_total, o.total_amount, o.run_date
        FROM day_orders o JOIN day_items oi ON o.order_id = oi.order_id AND o.run_date = oi.run_date
        JOIN silver_products p ON oi.product_id = p.product_id""", **_DAYS),
    "csv_line_breaks": _BREAKS,
    "medallion_line_breaks": _table("fact_sales", raw_products=_BREAKS),
    "csv_failed_overwrite_orders": _table("raw_orders"),
    "gold_rerun_without_products": _sql(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {present} AS present, {'count(*)' if present else 'CAST(0 AS BIGINT)'} AS row_count"
        + (f" FROM {source}" if present else "")
        for name, source in _GOLD.items() for present in [name not in ("fact_sales", "products")]
    )),
    "rejected_order_items": _sql(
        f"SELECT * FROM (SELECT *, {_RULES['order_items']} AS rejected_by FROM raw_order_items) AS a WHERE rejected_by IS NOT NULL"
    ),
    "routed_silver_counts": _sql(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {rule} AS rejected_by, count(*) AS row_count FROM raw_{name} GROUP BY ALL"
        for name, rule in _RULES.items()
    )),
    "gold_csv_files_without_products": ORACLE["gold_files_without_products"],
    "bronze_unparsed_counts": _sql(" UNION ALL ".join(
        f"SELECT '{label}' AS source_system, count(*) AS row_count, count(*) FILTER (WHERE {_UNPARSED.get(name, 'false')}) AS unparsed "
        f"FROM raw_{name}" for name, label in SOURCE_SYSTEMS.items()
    )),
    "csv_texts_kept": f"""
        SELECT product_id, CASE product_id % 5 WHEN 0 THEN '  ' || product_name || ' ' WHEN 1 THEN '' WHEN 2 THEN NULL
            WHEN 3 THEN 'say "' || product_name || '", twice' ELSE product_name END AS product_name, category, price
        FROM ({_RAW["raw_products"]}) AS a""",
    "csv_fractional_order_items": ORACLE["csv_round_trip_order_items"],
    "csv_header_variants_state": f"SELECT state FROM ({ORACLE['csv_header_variants']})",
    "csv_header_variants_city": f"SELECT city FROM ({ORACLE['csv_header_variants']})",
    "csv_header_variants_filtered": f"SELECT customer_id FROM ({ORACLE['csv_header_variants']}) WHERE state > 'M'",
    "csv_header_variants_by_state": f"SELECT state, count(*) AS n FROM ({ORACLE['csv_header_variants']}) GROUP BY state",
}
