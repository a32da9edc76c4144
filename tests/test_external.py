import pytest
from pyspark.errors import AnalysisException

from smeltery.sources import files
from smeltery.sources.external import STANDARD_COLUMNS, ExternalTable, add_folders, drift, export, register
from tests.conftest import rows_of


def entry(name, columns, location, **more):
    return {
        "database": "shop", "table_name": name, "columns": [{"name": n, "type": t} for n, t in columns],
        f"s3_{name.lower()}_location": str(location), **more,
    }


def test_register_from_config(spark, tmp_path):
    spark.sql("SELECT 1 AS Id, 'a' AS label, 2 AS extra").write.parquet(str(tmp_path / "data"))
    columns = [("id", "bigint"), ("LABEL", "string"), ("absent", "double")]
    table = ExternalTable.from_config(entry("Things", columns, tmp_path / "data", things_output_location=str(tmp_path / "out")))
    register(spark, [table])
    register(spark, [table, ExternalTable.from_config(entry("Things", [("other", "int")], tmp_path / "nowhere"))])
    found = spark.table("shop.Things")
    assert [(f.name.lower(), f.dataType.simpleString()) for f in found.schema] == [
        ("id", "bigint"), ("label", "string"), ("absent", "double")
    ]
    assert rows_of(found) == [(1, "a", None)]
    assert spark.catalog.getTable("shop.Things").tableType == "EXTERNAL"
    export(found.select("id"), table)
    assert rows_of(files.scan(spark, str(tmp_path / "out"), "id BIGINT", "parquet")) == [(1,)]
    spark.sql("DROP TABLE shop.Things")
    assert spark.read.parquet(str(tmp_path / "data")).count() == 1


def test_missing_location_is_an_empty_table(spark, tmp_path):
    register(spark, [ExternalTable("shop", "later", "a BIGINT", str(tmp_path / "none"))])
    assert spark.table("shop.later").count() == 0


def test_type_conflict_fails_at_read(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "n"))
    register(spark, [ExternalTable("shop", "clash", "id STRING", str(tmp_path / "n"))])
    with pytest.raises(Exception):
        spark.table("shop.clash").collect()


def test_quoting(spark, tmp_path):
    folder = tmp_path / "it's"
    spark.range(2).withColumnRenamed("id", "my id").write.parquet(str(folder))
    register(spark, [table := ExternalTable.from_config(entry("odd", [("my id", "bigint")], folder))])
    assert spark.table(table.qualified).columns == ["my id"]
    assert spark.table(table.qualified).count() == 2


def test_standard_tables_register(spark, tmp_path):
    tables = [ExternalTable("shop", name, ddl, str(tmp_path / name)) for name, ddl in STANDARD_COLUMNS.items()]
    assert register(spark, tables) == [table.qualified for table in tables]
    widths = {name: len(spark.table(f"shop.{name}").columns) for name in STANDARD_COLUMNS}
    assert widths == {"housing_data": 13, "iris_data": 5, "weather_data": 22}
    assert dict(spark.table("shop.weather_data").dtypes)["Sunshine"] == "string"


def test_missing_config_key(tmp_path):
    broken = entry("t", [("a", "int")], tmp_path)
    del broken["s3_t_location"]
    with pytest.raises(KeyError):
        ExternalTable.from_config(broken)


def test_bad_type_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        register(spark, [ExternalTable("shop", "bad", "a nonsense", str(tmp_path))])


def test_drift_is_reported_raised_or_mended(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "old"))
    spark.range(5).write.parquet(str(tmp_path / "new"))
    old = ExternalTable("shop", "moved", "ID BIGINT", f"{tmp_path}//old/")
    new = ExternalTable("shop", "moved", "id BIGINT, label STRING", str(tmp_path / "new"))
    assert drift(spark, [old]) == []  # not registered yet
    register(spark, [old])
    assert drift(spark, [ExternalTable("shop", "moved", "id BIGINT", f"file:{tmp_path}/old")]) == []
    assert [d.what for d in drift(spark, [new])] == ["columns", "location"]
    assert drift(spark, [new])[0][2:] == ("id bigint, label string", "id bigint")
    other = ExternalTable("shop", "never_declared", "a INT", str(tmp_path / "none"))
    with pytest.raises(ValueError, match="moved.*columns.*location"):
        register(spark, [other, new], drifted="raise")
    assert not spark.catalog.tableExists("shop.never_declared")
    register(spark, [new])
    assert spark.table("shop.moved").count() == 3
    register(spark, [new], drifted="replace")
    assert spark.table("shop.moved").count() == 5 and drift(spark, [new]) == []
    register(spark, [new], drifted="raise")
    assert spark.read.parquet(str(tmp_path / "old")).count() == 3


def test_a_filter_on_days_reads_their_folders_only(spark, tmp_path):
    days = {f"2025022{i}": str(tmp_path / f"2025022{i}" / "orders") for i in range(3)}
    for i, folder in enumerate(days.values()):
        spark.range(10 * i, 10 * i + 5).write.parquet(folder)
    columns = [("day", "string"), ("id", "bigint")]
    table = ExternalTable.from_config(entry("daily", columns, tmp_path / "root", partitioned_by=["day"]))
    register(spark, [table])
    assert drift(spark, [table]) == []
    assert [d.what for d in drift(spark, [ExternalTable("shop", "daily", table.columns, table.location)])] == ["columns", "partitions"]
    add_folders(spark, table, days)
    found = spark.table(table.qualified)
    assert found.columns == ["id", "day"] and found.count() == 15
    one = found.filter("day = '20250221'")
    assert rows_of(one) == [(i, "20250221") for i in range(10, 15)]
    assert one.inputFiles() and all("/20250221/orders/" in name for name in one.inputFiles())
    spark.range(7).write.parquet(str(tmp_path / "again"))
    add_folders(spark, table, {"20250221": str(tmp_path / "again")})
    assert spark.table(table.qualified).filter("day = '20250221'").count() == 7
