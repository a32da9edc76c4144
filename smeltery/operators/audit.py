"""Audit columns and row counts of the bronze layer."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.schemas import AUDIT_TIME, SOURCE_SYSTEM, SOURCE_SYSTEMS


def with_audit(df: DataFrame, source_system: str, ingested_at: Column | None = None) -> DataFrame:
    """Add load time and source label. Pass ``ingested_at`` to fix the time across actions."""
    loaded = F.current_timestamp() if ingested_at is None else ingested_at
    return df.withColumns({AUDIT_TIME: loaded, SOURCE_SYSTEM: F.lit(source_system)})


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = (
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(SOURCE_SYSTEMS[name]).alias(SOURCE_SYSTEM), "row_count")
        for name, df in tables.items()
    )
    return reduce(DataFrame.unionAll, counts)
