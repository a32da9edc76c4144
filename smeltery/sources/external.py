"""External Parquet tables in the session catalog, declared by configuration."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Literal, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from smeltery.sources.files import write

# The declared columns of the three standard external tables. Some
# numeric-looking weather columns are text on purpose.
STANDARD_COLUMNS = {
    "housing_data": (
        "price bigint, area bigint, bedrooms bigint, bathrooms bigint, stories bigint, mainroad string, "
        "guestroom string, basement string, hotwaterheating string, airconditioning string, parking bigint, "
        "prefarea string, furnishingstatus string"
    ),
    "iris_data": (
        "sepal_length double, sepal_width double, petal_length double, petal_width double, variety string"
    ),
    "weather_data": (
        "MinTemp double, MaxTemp double, Rainfall double, Evaporation double, Sunshine string, "
        "WindGustDir string, WindGustSpeed string, WindDir9am string, WindDir3pm string, WindSpeed9am string, "
        "WindSpeed3pm bigint, Humidity9am bigint, Humidity3pm bigint, Pressure9am double, Pressure3pm double, "
        "Cloud9am bigint, Cloud3pm bigint, Temp9am double, Temp3pm double, RainToday string, RISK_MM double, "
        "RainTomorrow string"
    ),
}


@dataclass(frozen=True)
class ExternalTable:
    database: str
    name: str
    columns: str
    location: str
    output_location: str | None = None
    partitioned_by: tuple[str, ...] = ()  # of the columns, those that the files do not hold

    @classmethod
    def from_config(cls, entry: Mapping) -> ExternalTable:
        """From one entry of a ``tables`` list: both location keys carry the table's name."""
        name = entry["table_name"]
        key = name.lower()
        columns = ", ".join(f"{_quoted(column['name'])} {column['type']}" for column in entry["columns"])
        return cls(
            entry["database"], name, columns, entry[f"s3_{key}_location"], entry.get(f"{key}_output_location"),
            tuple(entry.get("partitioned_by", ())),
        )

    @property
    def qualified(self) -> str:
        return f"{_quoted(self.database)}.{_quoted(self.name)}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Drift(NamedTuple):
    """Where the catalog and the configuration of a table differ."""

    table: str
    what: Literal["columns", "partitions", "location", "format"]
    declared: str
    found: str


def _ddl(fields: Iterable[T.StructField]) -> str:
    """Columns as they are compared: names whatever the case of their letters, types, and the order."""
    return ", ".join(f"{f.name.lower()} {f.dataType.simpleString()}" for f in fields)


def _qualified(spark: SparkSession, location: str) -> str:
    """A location with its scheme and without doubled or closing slashes."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


def drift(spark: SparkSession, tables: Iterable[ExternalTable]) -> list[Drift]:
    """What the catalog has otherwise than configured, of the tables that are registered. It looks at the catalog only, not at
    the files; a type conflict with these shows when they are read."""
    found = []
    for table in tables:
        if not spark.catalog.tableExists(table.qualified):
            continue
        described = {
            row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table.qualified}").collect()
        }
        schema = spark.table(table.qualified).schema
        held = [c.name.lower() for c in spark.catalog.listColumns(table.qualified) if c.isPartition]
        # The catalog puts the columns of partitions last.
        last = {name.lower() for name in table.partitioned_by}
        wanted = sorted(T.StructType.fromDDL(table.columns).fields, key=lambda f: f.name.lower() in last)
        pairs = {
            "columns": (_ddl(wanted), _ddl(schema.fields)),
            "partitions": (", ".join(table.partitioned_by).lower(), ", ".join(held)),
            "location": (_qualified(spark, table.location), _qualified(spark, described["Location"])),
            "format": ("parquet", described["Provider"].lower()),
        }
        found += [Drift(table.qualified, what, *pair) for what, pair in pairs.items() if pair[0] != pair[1]]
    return found


def register(
    spark: SparkSession, tables: Iterable[ExternalTable], drifted: Literal["keep", "raise", "replace"] = "keep",
) -> list[str]:
    """Declare the tables over their files.

    A table that already exists is left as it is, if it is as configured. If not, ``drifted`` says what happens: it stays, all
    drift is raised as a ValueError before any table is declared, or the table is declared anew. Files are never touched; partitions of a table
    declared anew are to be added again.
    """
    tables = list(tables)
    differing = drift(spark, tables) if drifted != "keep" else []
    if differing and drifted == "raise":
        raise ValueError("; ".join(f"{d.table}: {d.what} declared as {d.declared}, found {d.found}" for d in differing))
    for table in {d.table for d in differing}:
        spark.sql(f"DROP TABLE {table}")
    registered = []
    for table in tables:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(table.database)}")
        by = f"PARTITIONED BY ({', '.join(map(_quoted, table.partitioned_by))}) " if table.partitioned_by else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table.qualified} ({table.columns}) "
            f"USING parquet {by}LOCATION {_literal(table.location)}"
        )
        registered.append(table.qualified)
    return registered


def add_folders(spark: SparkSession, table: ExternalTable, folders: Mapping[str, str]) -> None:
    """Add folders as partitions of a registered table with one column of partitions, such as its days: value to location.

    A filter on the column then reads the folders of its values only. A folder that is there already takes the new location.
    """
    (column,) = table.partitioned_by
    for value, folder in folders.items():
        part = f"PARTITION ({_quoted(column)} = {_literal(value)})"
        spark.sql(f"ALTER TABLE {table.qualified} ADD IF NOT EXISTS {part} LOCATION {_literal(folder)}")
        spark.sql(f"ALTER TABLE {table.qualified} {part} SET LOCATION {_literal(folder)}")


def export(df: DataFrame, table: ExternalTable) -> None:
    """Write a query result to the table's output location, if it has one."""
    if table.output_location:
        write(df, table.output_location, "parquet")
