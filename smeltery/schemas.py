"""Schemas of the four retail entities and the fixed labels of their layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Entity columns in file-header order. Ids are 64 bits wide so that they do
# not overflow on large histories; the text in the files is the same.
_RAW = {
    "customers": {
        "customer_id": "long", "full_name": "string", "email": "string", "address": "string", "city": "string",
        "state": "string",
    },
    "products": {"product_id": "long", "product_name": "string", "category": "string", "price": "double"},
    "orders": {
        "order_id": "long", "order_date": "date", "customer_id": "long", "total_amount": "double",
        "order_status": "string",
    },
    "order_items": {
        "order_item_id": "long", "order_id": "long", "product_id": "long", "quantity": "integer",
        "unit_price": "double",
    },
}

# Gold tables that are not simply a raw table again.
_GOLD = {
    "fact_sales": {
        "order_id": "long", "customer_id": "long", "order_date": "date", "product_id": "long",
        "product_name": "string", "quantity": "integer", "unit_price": "double", "line_total": "double",
        "total_amount": "double",
    },
    "orders": {
        "order_id": "long", "customer_id": "long", "order_date": "date", "total_amount": "double",
        "order_status": "string",
    },
    "order_items": {
        "order_id": "long", "product_id": "long", "quantity": "integer", "unit_price": "double",
        "customer_id": "long", "order_date": "date", "total_amount": "double", "order_status": "string",
    },
}

# The audit literal written to source_system by the bronze layer.
SOURCE_SYSTEMS = {
    "customers": "Customer Data",
    "order_items": "Order Items",
    "orders": "Orders",
    "products": "Products",
}

# The mart that holds each gold output.
MARTS = {
    "fact_sales": "gold_analytics",
    "customers": "gold_business_rules",
    "orders": "gold_business_rules",
    "order_items": "gold_business_rules",
    "products": "gold_business_rules",
}

TABLES = tuple(_RAW)
SOURCE_SYSTEM = "source_system"
AUDIT_TIME = "timestamp"


def _struct(columns: dict[str, str]) -> T.StructType:
    struct = T.StructType()
    for name, kind in columns.items():
        struct.add(name, kind)
    return struct


def raw_schema(table: str) -> T.StructType:
    return _struct(_RAW[table])


def bronze_schema(table: str) -> T.StructType:
    return silver_schema(table).add(SOURCE_SYSTEM, T.StringType())


def silver_schema(table: str) -> T.StructType:
    return raw_schema(table).add(AUDIT_TIME, T.TimestampType())


def gold_schema(table: str) -> T.StructType:
    """Schema of a gold table when all silver tables were there."""
    return _struct(_GOLD[table]) if table in _GOLD else raw_schema(table)


def customers_without_city() -> T.StructType:
    """Header variant of raw customers that some feeds deliver."""
    return T.StructType([f for f in raw_schema("customers") if f.name != "city"])
