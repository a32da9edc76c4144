"""Every registered query, built from the library's own functions over the given tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_queries import adapter
from smeltery.functions.rules import day_folder, line_total, run_day
from smeltery.operators import sales
from smeltery.operators.audit import row_counts
from smeltery.operators.quality import REJECTED_BY
from smeltery.plans import batches, days, jobs
from smeltery.plans.layers import to_bronze, to_gold, to_silver
from smeltery.schemas import MARTS, SOURCE_SYSTEM, TABLES, customers_without_city, gold_schema, raw_schema, silver_schema
from smeltery.session import new_folder
from smeltery.sources import external, files
from smeltery.sources.folders import Zones

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = "2025-02-20"
EXTERNAL_DATABASE = "smeltery_external"


def _loaded() -> Column:
    """A fixed load time without zone, so that results can be compared."""
    return F.lit(f"{RUN_DATE} 00:00:00").cast("timestamp_ntz")


# --- layers over the mapped tables -------------------------------------------------------


def _bronze(spark, sf_dir, *tables):
    return to_bronze(adapter.raw(spark, sf_dir, *tables), _loaded())


def _silver(spark, sf_dir, change=None, missing=None):
    raw = adapter.raw(spark, sf_dir)
    silver = to_silver(to_bronze(change(raw) if change else raw, _loaded()))
    return {name: None if name == missing else df for name, df in silver.items()}


def _bronze_table(name) -> Query:
    return lambda spark, sf_dir: _bronze(spark, sf_dir, name)[name]


def _silver_table(name) -> Query:
    return lambda spark, sf_dir: _silver(spark, sf_dir)[name]


def _gold_table(name, change=None, missing=None, keys_unique=False) -> Query:
    return lambda spark, sf_dir: to_gold(_silver(spark, sf_dir, change, missing), keys_unique=keys_unique)[name]


def _valid_orders(change=None) -> Query:
    def query(spark, sf_dir):
        silver = _silver(spark, sf_dir, change)
        return sales.valid_orders(silver["orders"], silver["customers"])
    return query


def _valid_order_items(change=None) -> Query:
    def query(spark, sf_dir):
        return sales.valid_order_items(_silver(spark, sf_dir, change)["order_items"], _valid_orders(change)(spark, sf_dir))
    return query


def order_lines(spark, sf_dir):
    return sales.order_lines(_silver(spark, sf_dir)["order_items"], _valid_orders()(spark, sf_dir))


def fact_not_active(spark, sf_dir):
    gold = to_gold(_silver(spark, sf_dir))
    return sales.inactive_sales(gold["fact_sales"], gold["orders"])


def bronze_row_counts(spark, sf_dir):
    return row_counts(_bronze(spark, sf_dir))


def item_line_totals(spark, sf_dir):
    items = _silver(spark, sf_dir)["order_items"]
    return items.select("order_item_id", "order_id", "product_id", line_total().alias("line_total"))


def order_day_folders(spark, sf_dir):
    orders = adapter.raw(spark, sf_dir, "orders")["orders"]
    return orders.select(
        "order_id",
        F.concat(F.lit("raw/raw_orders/"), day_folder(F.col("order_date"))).alias("folder"),
        run_day(F.col("order_date").cast("string")).alias("run_date"),
    )


# --- files -------------------------------------------------------------------------------


def _raw_files(spark, sf_dir, table):
    return adapter.as_raw_files(table, adapter.raw(spark, sf_dir, table)[table])


def _round_trip(table, fmt) -> Query:
    def query(spark, sf_dir):
        folder = new_folder(spark, f"{fmt}-{table}")
        files.write(_raw_files(spark, sf_dir, table), folder, fmt)
        return files.scan(spark, folder, raw_schema(table), fmt)
    return query


def csv_overwrite_orders(spark, sf_dir):
    """Written twice: the second run replaces the first."""
    folder = new_folder(spark, "overwrite")
    orders = _raw_files(spark, sf_dir, "orders")
    files.write(orders.withColumn("order_status", F.lit("STALE")), folder)
    files.write(orders, folder)
    return files.scan(spark, folder, raw_schema("orders"))


def csv_two_runs_orders(spark, sf_dir):
    """Two runs on one day accumulate, duplicates and all."""
    folder = new_folder(spark, "append")
    orders = _raw_files(spark, sf_dir, "orders")
    files.append(orders, folder)
    files.append(orders, folder)
    return files.scan(spark, folder, raw_schema("orders"))


def csv_header_variants(spark, sf_dir):
    """Customers of one segment come in files without the city column."""
    folder = new_folder(spark, "variants")
    customers = _raw_files(spark, sf_dir, "customers")
    narrow = customers_without_city()
    building = F.col("state") == "BUILDING"
    files.append(customers.filter(~building), folder)
    files.append(customers.filter(building).select(*narrow.names), folder)
    return files.scan_csv_variants(spark, folder, raw_schema("customers"), [narrow])


def _landed(spark, sf_dir) -> Zones:
    """Raw day folders as a feed would deliver them."""
    zones = Zones.under(new_folder(spark, "zones"))
    jobs.together(
        spark, lambda table: files.append(_raw_files(spark, sf_dir, table), zones.raw_day(table, RUN_DATE)), TABLES
    )
    return zones


def bronze_written_counts(spark, sf_dir):
    counts = jobs.run_bronze(spark, _landed(spark, sf_dir), RUN_DATE)
    return spark.createDataFrame(list(counts.items()), f"{SOURCE_SYSTEM} STRING, row_count BIGINT")


def bronze_unparsed_counts(spark, sf_dir):
    """Some dates and quantities are words; the bronze job counts them."""
    zones = Zones.under(new_folder(spark, "zones"))
    word = {
        "orders": ("order_date", F.when(F.col("order_status") == "PENDING", "soon")),
        "order_items": ("quantity", F.when(F.col("quantity") > 33, "many")),
    }
    for table in TABLES:
        df = _raw_files(spark, sf_dir, table)
        if table in word:
            column, text = word[table]
            df = df.withColumn(column, F.coalesce(text, F.col(column).cast("string")))
        files.append(df, zones.raw_day(table, RUN_DATE))
    landed = jobs.land_bronze(spark, zones, RUN_DATE)
    rows = [(label, table.rows, table.unparsed) for label, table in landed.items()]
    return spark.createDataFrame(rows, f"{SOURCE_SYSTEM} STRING, row_count BIGINT, unparsed BIGINT")


def _medallion(output, **options) -> Query:
    """Raw files to gold files through all the layer jobs."""
    def query(spark, sf_dir):
        zones = _landed(spark, sf_dir)
        jobs.run_day(spark, zones, RUN_DATE, **options)
        fmt = options.get("gold_format", "csv")
        return files.scan(spark, zones.gold_table(output, RUN_DATE), gold_schema(output), fmt)
    return query


def medallion_output_counts(spark, sf_dir):
    """Rows in each of the five gold folders."""
    zones = _landed(spark, sf_dir)
    jobs.run_day(spark, zones, RUN_DATE)
    counts = (
        files.scan(spark, zones.gold_table(name, RUN_DATE), gold_schema(name))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(mart).alias("mart"), F.lit(name).alias("table_name"), "row_count")
        for name, mart in MARTS.items()
    )
    return reduce(DataFrame.unionAll, counts)


def gold_files_without_products(spark, sf_dir):
    """No products folder: the job skips it and the fact, and still writes the active items."""
    zones = Zones.under(new_folder(spark, "zones"))
    for name, df in _silver(spark, sf_dir, missing="products").items():
        if df is not None:
            files.write(df, zones.silver_table(name, RUN_DATE), "parquet")
    written = jobs.run_gold(spark, zones, RUN_DATE)
    if written["products"] or written["fact_sales"]:
        raise AssertionError(written)
    return files.scan(spark, zones.gold_table("order_items", RUN_DATE), gold_schema("order_items"))


def gold_csv_files_without_products(spark, sf_dir):
    """The same over silver tables in CSV, whose folders are looked for by their files."""
    zones = Zones.under(new_folder(spark, "zones"))
    for name, df in _silver(spark, sf_dir, missing="products").items():
        files.write_optional(df, zones.silver_table(name, RUN_DATE))
    written = jobs.run_gold(spark, zones, RUN_DATE, layer_format="csv")
    if written["products"] or written["fact_sales"]:
        raise AssertionError(written)
    return files.scan(spark, zones.gold_table("order_items", RUN_DATE), gold_schema("order_items"))


def csv_texts_kept(spark, sf_dir):
    """Products whose names start and end with blanks, are empty or NULL, hold quotes and commas."""
    folder = new_folder(spark, "texts")
    kind, name = F.col("product_id") % 5, F.col("product_name")
    odd = (
        F.when(kind == 0, F.concat(F.lit("  "), name, F.lit(" "))).when(kind == 1, F.lit(""))
        .when(kind == 2, F.lit(None)).when(kind == 3, F.concat(F.lit('say "'), name, F.lit('", twice'))).otherwise(name)
    )
    files.write(_raw_files(spark, sf_dir, "products").withColumn("product_name", odd), folder)
    return files.scan(spark, folder, raw_schema("products"))


def csv_line_breaks(spark, sf_dir):
    """Products whose names hold line breaks of every kind, next to quotes, commas and backslashes."""
    folder = new_folder(spark, "breaks")
    files.write(_raw_files(spark, sf_dir, "products").withColumn("product_name", _with_breaks()), folder)
    return files.scan(spark, folder, raw_schema("products"))


def _with_breaks() -> Column:
    kind, name = F.col("product_id") % 6, F.col("product_name")
    return (
        F.when(kind == 0, F.concat(F.lit("\n"), name, F.lit("\n"))).when(kind == 1, F.concat(name, F.lit("\r\n"), name))
        .when(kind == 2, F.concat(F.lit('say "\n'), name, F.lit('",\n"twice"'))).when(kind == 3, F.concat(name, F.lit("\\\n\\")))
        .when(kind == 4, F.concat(name, F.lit("\r"), name)).otherwise(name)
    )


def medallion_line_breaks(spark, sf_dir):
    """The fact through CSV layers, with product names of several lines."""
    zones = Zones.under(new_folder(spark, "zones"))
    for table in TABLES:
        df = _raw_files(spark, sf_dir, table)
        files.append(df.withColumn("product_name", _with_breaks()) if table == "products" else df, zones.raw_day(table, RUN_DATE))
    jobs.run_day(spark, zones, RUN_DATE, layer_format="csv")
    return files.scan(spark, zones.gold_table("fact_sales", RUN_DATE), gold_schema("fact_sales"))


_DAY_OF = {
    "orders": "CASE order_status WHEN 'PENDING' THEN '2025-02-20' WHEN 'SHIPPED' THEN '2025-02-19' ELSE '2025-02-21' END",
    "order_items": "CASE WHEN quantity > 33 THEN '2025-02-20' WHEN quantity > 16 THEN '2025-02-19' ELSE '2025-02-21' END",
}


def days_fact_sales(spark, sf_dir):
    """All orders and items dealt to three days, each with all customers and products, and the three days run at once."""
    zones, dates = Zones.under(new_folder(spark, "zones")), ["2025-02-19", "2025-02-20", "2025-02-21"]
    for table in TABLES:
        df = _raw_files(spark, sf_dir, table)
        for date in dates:
            files.append(df.filter(F.expr(_DAY_OF[table]) == date) if table in _DAY_OF else df, zones.raw_day(table, date))
    days.run_days(spark, zones, dates)
    schema = gold_schema("fact_sales")
    facts = (files.scan(spark, zones.gold_table("fact_sales", d), schema).withColumn("run_date", F.lit(d).cast("date")) for d in dates)
    return reduce(DataFrame.unionAll, facts)


# --- runs that fail, or have less than the last one --------------------------------------------


def csv_failed_overwrite_orders(spark, sf_dir):
    """A second write breaks off at pending orders: the rows of the first one stay."""
    folder = new_folder(spark, "failed")
    orders = _raw_files(spark, sf_dir, "orders")
    files.write(orders, folder)
    broken = F.when(F.col("order_status") == "PENDING", F.raise_error(F.lit("broken off"))).otherwise(F.col("order_status"))
    try:
        files.write(orders.withColumn("order_status", broken.cast("string")), folder)
    except Exception as error:  # noqa: BLE001  (the error's class depends on where it comes up)
        if "broken off" not in str(error):
            raise
    else:
        raise AssertionError("the second write went through")
    return files.scan(spark, folder, raw_schema("orders"))


def gold_rerun_without_products(spark, sf_dir):
    """The day runs whole, and once more without products: the fact and the products of the first run are gone."""
    zones = _landed(spark, sf_dir)
    jobs.run_day(spark, zones, RUN_DATE)
    files.release(spark, zones.silver_table("products", RUN_DATE))
    jobs.run_gold(spark, zones, RUN_DATE)

    def line(name: str) -> DataFrame:
        found = files.scan_optional(spark, zones.gold_table(name, RUN_DATE), gold_schema(name))
        rows = spark.createDataFrame([], gold_schema(name)) if found is None else found
        return rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(found is not None).alias("present"), "row_count"
        )

    return reduce(DataFrame.unionAll, map(line, MARTS))


def _routed(spark, sf_dir, fmt):
    zones = Zones.under(new_folder(spark, "zones"))
    for name, df in _bronze(spark, sf_dir).items():
        files.write(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")), zones.bronze_table(name, RUN_DATE), fmt)
    return zones, jobs.run_routed_silver(spark, zones, RUN_DATE, fmt)


def rejected_order_items(spark, sf_dir):
    """The items that the gates reject, as kept beside silver in Parquet, with the rules that they fail."""
    zones, _ = _routed(spark, sf_dir, "parquet")
    found = files.scan_rejected(spark, zones.rejected_table("order_items", RUN_DATE), REJECTED_BY, silver_schema("order_items"), "parquet")
    return found.drop("timestamp")


def routed_silver_counts(spark, sf_dir):
    """Rows of both kinds in the CSV folders, by table and rule."""
    zones, _ = _routed(spark, sf_dir, "csv")

    def both(name: str) -> DataFrame:
        schema = silver_schema(name)
        kept = files.scan(spark, zones.silver_table(name, RUN_DATE), schema).select(F.lit(None).cast("string").alias(REJECTED_BY))
        gone = files.scan_rejected(spark, zones.rejected_table(name, RUN_DATE), REJECTED_BY, schema).select(REJECTED_BY)
        counts = kept.unionAll(gone).groupBy(REJECTED_BY).agg(F.count(F.lit(1)).alias("row_count"))
        return counts.select(F.lit(name).alias("table_name"), REJECTED_BY, "row_count")

    return reduce(DataFrame.unionAll, map(both, TABLES))


# --- catalog -----------------------------------------------------------------------------


def _config(spark, sf_dir, name, columns, output=None) -> dict:
    # Registering is a no-op for a known name, so the name tells the folders apart.
    table = f"{name}_{hashlib.md5(sf_dir.encode()).hexdigest()[:8]}"
    entry = {
        "database": EXTERNAL_DATABASE,
        "table_name": table,
        "columns": [{"name": column, "type": kind} for column, kind in columns],
        f"s3_{table}_location": f"{sf_dir}/{name}.parquet",
    }
    return entry | ({f"{table}_output_location": output} if output else {})


def external_customer(spark, sf_dir):
    """Widened, case-differing and absent columns of a declared table; registered twice."""
    columns = [
        ("c_custkey", "bigint"), ("C_NAME", "string"), ("c_nationkey", "bigint"),
        ("c_acctbal", "double"), ("loyalty_tier", "string"),
    ]
    table = external.ExternalTable.from_config(_config(spark, sf_dir, "customer", columns))
    external.register(spark, [table])
    external.register(spark, [table])
    return spark.table(table.qualified).withColumnRenamed("C_NAME", "c_name")


def external_outputs(spark, sf_dir):
    """Two tables from one config; a query over each goes to its output location."""
    prepare = [
        ("orders", [("o_orderkey", "bigint"), ("o_totalprice", "double")]),
        ("lineitem", [("l_orderkey", "bigint"), ("l_extendedprice", "double")]),
    ]
    tables = [
        external.ExternalTable.from_config(_config(spark, sf_dir, name, columns, new_folder(spark, f"output-{name}")))
        for name, columns in prepare
    ]
    external.register(spark, tables)
    results = []
    for table in tables:
        rows = spark.table(table.qualified).toDF("order_id", "amount")
        external.export(rows, table)
        results.append(files.scan(spark, table.output_location, rows.schema, "parquet"))
    return results[0].unionAll(results[1])


def external_year_folders(spark, sf_dir):
    """Folders of years as partitions of a table whose older declaration had another column; two of the years are read."""
    years = [str(year) for year in range(1992, 1999)]
    name, root = f"years_{hashlib.md5(sf_dir.encode()).hexdigest()[:8]}", new_folder(spark, "years")
    folders = {year: f"{root}/{year}" for year in years}
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = orders.select(F.col("o_orderkey").alias("order_id"), F.year("o_orderdate").cast("string").alias("year"))
    files.write_parts(rows.filter(F.col("year").isin(years)), "year", folders, f"{root}/staged", "parquet")
    older = external.ExternalTable(EXTERNAL_DATABASE, name, "order_id INT, year STRING", f"{root}/older", None, ("year",))
    table = external.ExternalTable(EXTERNAL_DATABASE, name, f"order_id {rows.schema['order_id'].dataType.simpleString()}, year STRING", root, None, ("year",))
    external.register(spark, [older])
    external.register(spark, [table], drifted="replace")
    external.add_folders(spark, table, folders)
    return spark.table(table.qualified).filter(F.col("year").isin("1994", "1996"))


# --- id marks over the given tables ---------------------------------------------------------


def _marks(spark, sf_dir) -> DataFrame:
    raw = adapter.raw(spark, sf_dir)
    keys = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "order_items": "order_item_id"}
    return reduce(DataFrame.unionAll, (
        raw[table].select(F.lit(table).alias("table_name"), F.col(key).alias("last_id"))
        for table, key in keys.items()
    ))


def id_high_water(spark, sf_dir):
    return batches.high_water(_marks(spark, sf_dir)).withColumn("next_id", F.col("last_id") + 1)


def csv_fractional_order_items(spark, sf_dir):
    """Whole numbers written as n.0 are read back whole."""
    folder = f"{new_folder(spark, 'csv')}/order_items"
    items = adapter.raw(spark, sf_dir)["order_items"]
    whole = ("order_item_id", "order_id", "product_id", "quantity")
    files.write(items.withColumns({c: F.concat(F.col(c).cast("string"), F.lit(".0")) for c in whole}), folder)
    return files.scan(spark, folder, raw_schema("order_items"))


REPEATED, HOT = adapter.with_repeated_customers, adapter.with_hot_keys

QUERIES: dict[str, Query] = {
    **{f"bronze_{name}": _bronze_table(name) for name in TABLES},
    "bronze_row_counts": bronze_row_counts,
    "bronze_written_counts": bronze_written_counts,
    **{f"silver_{name}": _silver_table(name) for name in TABLES},
    "item_line_totals": item_line_totals,
    "valid_orders": _valid_orders(),
    "valid_order_items": _valid_order_items(),
    "order_lines": order_lines,
    "fact_sales": _gold_table("fact_sales"),
    "active_orders": _gold_table("orders"),
    "active_order_items": _gold_table("order_items"),
    "gold_customers": _gold_table("customers"),
    "gold_products": _gold_table("products"),
    "fact_not_active": fact_not_active,
    "unique_keys_fact_sales": _gold_table("fact_sales", keys_unique=True),
    "unique_keys_order_items": _gold_table("order_items", keys_unique=True),
    "fan_valid_orders": _valid_orders(REPEATED),
    "fan_valid_order_items": _valid_order_items(REPEATED),
    "fan_fact_sales": _gold_table("fact_sales", REPEATED),
    "fan_active_order_items": _gold_table("order_items", REPEATED),
    "hot_valid_orders": _valid_orders(HOT),
    "hot_fact_sales": _gold_table("fact_sales", HOT),
    "hot_active_order_items": _gold_table("order_items", HOT),
    "no_customers_orders": _gold_table("orders", missing="customers"),
    "no_customers_order_items": _gold_table("order_items", missing="customers"),
    "no_customers_fact_sales": _gold_table("fact_sales", missing="customers"),
    "no_orders_order_items": _gold_table("order_items", missing="orders"),
    "no_order_items_orders": _gold_table("orders", missing="order_items"),
    "no_products_order_items": _gold_table("order_items", missing="products"),
    "order_day_folders": order_day_folders,
    "csv_round_trip_orders": _round_trip("orders", "csv"),
    "csv_round_trip_order_items": _round_trip("order_items", "csv"),
    "parquet_round_trip_products": _round_trip("products", "parquet"),
    "csv_overwrite_orders": csv_overwrite_orders,
    "csv_two_runs_orders": csv_two_runs_orders,
    "csv_fractional_order_items": csv_fractional_order_items,
    "csv_header_variants": csv_header_variants,
    "csv_header_variants_state": lambda spark, sf_dir: csv_header_variants(spark, sf_dir).select("state"),
    "csv_header_variants_city": lambda spark, sf_dir: csv_header_variants(spark, sf_dir).select("city"),
    "csv_header_variants_filtered": lambda spark, sf_dir: csv_header_variants(spark, sf_dir).filter("state > 'M'").select("customer_id"),
    "csv_header_variants_by_state": lambda spark, sf_dir: csv_header_variants(spark, sf_dir).groupBy("state").agg(F.count("*").alias("n")),
    "medallion_fact_sales": _medallion("fact_sales", layer_format="csv"),
    "medallion_orders": _medallion("orders"),
    "medallion_order_items": _medallion("order_items", gold_format="parquet"),
    "medallion_output_counts": medallion_output_counts,
    "gold_files_without_products": gold_files_without_products,
    "gold_csv_files_without_products": gold_csv_files_without_products,
    "csv_texts_kept": csv_texts_kept,
    "bronze_unparsed_counts": bronze_unparsed_counts,
    "days_fact_sales": days_fact_sales,
    "csv_line_breaks": csv_line_breaks,
    "medallion_line_breaks": medallion_line_breaks,
    "csv_failed_overwrite_orders": csv_failed_overwrite_orders,
    "gold_rerun_without_products": gold_rerun_without_products,
    "rejected_order_items": rejected_order_items,
    "routed_silver_counts": routed_silver_counts,
    "external_customer": external_customer,
    "external_outputs": external_outputs,
    "external_year_folders": external_year_folders,
    "id_high_water": id_high_water,
}
