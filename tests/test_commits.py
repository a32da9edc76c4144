"""Runs that fail or die leave the old rows or all of the new ones."""

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from smeltery.plans import jobs
from smeltery.schemas import MARTS, TABLES, gold_schema
from smeltery.sources import commits, files
from smeltery.sources.folders import Zones
from tests.conftest import rows_of

DAY = "2025-02-20"


class Died(BaseException):
    """The driver is gone: nothing that would clean up runs."""


def failing(spark, n=1000):
    """Rows of which the last task's last one cannot be computed, when the other tasks have written theirs."""
    return spark.range(n).repartition(4).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")).cast("long").alias("id"))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path, fmt):
    folder = str(tmp_path / "zone" / "t")
    with pytest.raises(Exception, match="bad row"):
        files.write(failing(spark), folder, fmt)
    assert not list((tmp_path / "zone").glob("[!.]*")), "nothing was there, nothing is"
    files.write(spark.range(5), folder, fmt)
    with pytest.raises(Exception, match="bad row"):
        files.write(failing(spark), folder, fmt)
    assert rows_of(files.scan(spark, folder, "id BIGINT", fmt)) == [(i,) for i in range(5)]
    assert [p.name for p in (tmp_path / "zone").glob("[!.]*")] == ["t"]
    files.write(spark.range(7, 9), folder, fmt)
    assert rows_of(files.scan(spark, folder, "id BIGINT", fmt)) == [(7,), (8,)]
    assert [p.name for p in (tmp_path / "zone").glob("[!.]*")] == ["t"]


def test_a_table_may_be_rewritten_from_itself(spark, tmp_path):
    folder = str(tmp_path / "t")
    files.write(spark.range(4), folder, "parquet")
    files.write(files.scan(spark, folder, "id BIGINT", "parquet").selectExpr("id + 1 AS id"), folder, "parquet")
    assert rows_of(files.scan(spark, folder, "id BIGINT", "parquet")) == [(1,), (2,), (3,), (4,)]


def test_death_between_the_two_renames(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    files.write(spark.range(3), folder, "parquet")
    rename, calls = commits.Files.rename, []

    def once(self, source, target):
        calls.append(target)
        if len(calls) == 2:
            raise Died
        return rename(self, source, target)

    monkeypatch.setattr(commits.Files, "rename", once)
    with pytest.raises(Died):
        files.write(spark.range(10, 12), folder, "parquet")
    monkeypatch.undo()
    assert not (tmp_path / "t").exists()
    assert rows_of(files.scan(spark, folder, "id BIGINT", "parquet")) == [(0,), (1,), (2,)]
    files.write(spark.range(20, 22), folder, "parquet")
    assert rows_of(files.scan(spark, folder, "id BIGINT", "parquet")) == [(20,), (21,)]
    assert not list(tmp_path.glob("_t.replaced"))


@pytest.fixture
def zones(spark, fixture_tables, tmp_path):
    found = Zones.under(str(tmp_path / "zones"))
    for name, df in fixture_tables.items():
        files.write(df, found.silver_table(name, DAY), "parquet")
    return found


def gold(spark, zones):
    """Rows of each gold table of the day, None for a missing one."""
    out = {}
    for name in MARTS:
        folder = jobs.standing(spark, zones, "gold", DAY).get(name)
        df = files.scan_optional(spark, folder, gold_schema(name)) if folder else None
        out[name] = None if df is None else rows_of(df)
    return out


def fewer(spark, zones, fixture_tables):
    """Another state of the silver tables: other orders, no products."""
    files.write(fixture_tables["orders"].filter("order_id < 5").withColumn("total_amount", F.lit(99.0)), zones.silver_table("orders", DAY), "parquet")
    files.release(spark, zones.silver_table("products", DAY))


def test_a_run_without_products_takes_the_old_fact_away(spark, zones, fixture_tables):
    jobs.run_gold(spark, zones, DAY)
    before = gold(spark, zones)
    assert all(before.values())
    fewer(spark, zones, fixture_tables)
    written = jobs.run_gold(spark, zones, DAY)
    after = gold(spark, zones)
    assert {name for name, was in written.items() if was} == {name for name, rows in after.items() if rows is not None} == {"customers", "orders", "order_items"}
    assert after["orders"] != before["orders"]
    for name in ("fact_sales", "products"):
        with pytest.raises(AnalysisException) as raised:
            files.scan(spark, zones.gold_table(name, DAY), gold_schema(name))
        assert raised.value.getCondition() == "PATH_NOT_FOUND"


def test_a_run_that_fails_on_one_table_changes_none(spark, zones, fixture_tables, monkeypatch):
    jobs.run_gold(spark, zones, DAY)
    before = gold(spark, zones)
    fewer(spark, zones, fixture_tables)
    real = files.write_optional

    def write_optional(df, folder, fmt):
        if "order_items" in folder:
            raise OSError("disk full")
        return real(df, folder, fmt)

    monkeypatch.setattr(jobs, "write_optional", write_optional)
    with pytest.raises(OSError, match="disk full"):
        jobs.run_gold(spark, zones, DAY)
    assert gold(spark, zones) == before
    left = [p.name for name in MARTS for p in Path(zones.gold_table(name, DAY)).parent.glob("_*")]
    assert left == []


@pytest.mark.parametrize("after", [0, 1, 2])
def test_death_while_the_tables_are_moved(spark, zones, fixture_tables, monkeypatch, after):
    """The run is recorded: readers see all of it, whatever was moved, and the next run moves the rest."""
    jobs.run_gold(spark, zones, DAY)
    fewer(spark, zones, fixture_tables)
    whole = Zones(zones.raw, zones.bronze, zones.silver, zones.gold + "_apart")
    jobs.run_gold(spark, whole, DAY)
    wanted = gold(spark, whole)
    put, calls = commits.put, []

    def some(spark, staged, folder):
        calls.append(folder)
        if len(calls) > after:
            raise Died
        put(spark, staged, folder)

    monkeypatch.setattr(commits, "put", some)
    with pytest.raises(Died):
        jobs.run_gold(spark, zones, DAY)
    monkeypatch.undo()
    assert gold(spark, zones) == wanted
    commits.recover(spark, zones.log("gold", DAY))
    assert gold(spark, zones) == wanted
    for name, rows in wanted.items():
        df = files.scan_optional(spark, zones.gold_table(name, DAY), gold_schema(name))
        assert (None if df is None else rows_of(df)) == rows
    jobs.run_gold(spark, zones, DAY)
    assert gold(spark, zones) == wanted


def test_silver_reads_bronze_of_a_run_that_died(spark, fixture_tables, tmp_path, monkeypatch):
    zones = Zones.under(str(tmp_path))
    for name, df in fixture_tables.items():
        files.append(df.drop("timestamp"), zones.raw_day(name, DAY))
    monkeypatch.setattr(commits, "put", lambda *_: (_ for _ in ()).throw(Died()))
    with pytest.raises(Died):
        jobs.run_bronze(spark, zones, DAY)
    monkeypatch.undo()
    jobs.run_silver(spark, zones, DAY)
    assert set(jobs.standing(spark, zones, "silver", DAY)) == set(TABLES)
    assert files.scan(spark, zones.silver_table("orders", DAY), "", "parquet").count() == 5


def test_a_record_cut_short_does_not_count(spark, tmp_path):
    log, table = str(tmp_path / "_runs" / "d"), str(tmp_path / "t")
    with commits.replacing(spark, log, {"t": table}) as run:
        files.write(spark.range(2), run.folders["t"], "parquet")
    commits.Files(spark, log).create(f"{log}/{5:020d}.json", '{"tables": {"t": {"fr')
    assert commits.current(spark, log, {"t": table}) == {"t": table}
    with commits.replacing(spark, log, {"t": table}) as run:
        files.write(spark.range(3), run.folders["t"], "parquet")
    assert files.scan(spark, table, "id BIGINT", "parquet").count() == 3


def test_runs_at_the_same_time_do_not_mix(spark, tmp_path):
    log, finals = str(tmp_path / "_runs" / "d"), {name: str(tmp_path / name) for name in ("a", "b", "c")}

    def run(k):
        with commits.replacing(spark, log, finals) as found:
            for name in finals:
                files.write(spark.range(k, k + 1), found.folders[name], "parquet")

    for k in range(0, 12, 4):
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(run, range(k, k + 4)))
        rows = {tuple(rows_of(files.scan(spark, f, "id BIGINT", "parquet"))) for f in finals.values()}
        assert len(rows) == 1 and rows.pop()[0][0] in range(k, k + 4)
    assert not list(tmp_path.glob("_[abc].*")) and not (tmp_path / "_runs" / "d" / "moving").exists()


def test_the_moves_of_a_dead_run_are_taken_over(spark, tmp_path, monkeypatch):
    log, table = str(tmp_path / "_runs" / "d"), str(tmp_path / "t")
    monkeypatch.setattr(commits, "PATIENCE", 0.2)
    known = commits.Files(spark, log)
    with commits.replacing(spark, log, {"t": table}) as run:
        files.write(spark.range(2), run.folders["t"], "parquet")
        known.create(f"{log}/moving", "a run that died")
    assert files.scan(spark, table, "id BIGINT", "parquet").count() == 2 and not known.exists(f"{log}/moving")


def test_one_writer_creates_a_file(spark, tmp_path):
    at = f"{tmp_path}/deep/record"
    known = commits.Files(spark, at)
    with ThreadPoolExecutor(8) as pool:
        wins = list(pool.map(lambda k: known.create(at, str(k)), range(32)))
    assert sum(wins) == 1 and known.read(at) == str(wins.index(True))
