"""Header discovery: only first lines are read, and many files pass."""

import pytest

from smeltery.schemas import customers_without_city, raw_schema
from smeltery.sources import files, headers
from tests.conftest import rows_of

WIDE = ",".join(raw_schema("customers").names)
NARROW = ",".join(customers_without_city().names)


def bytes_read(spark) -> int:
    """By this process from local files."""
    spark.sparkContext._jvm.System.gc()
    return sum(s.getBytesRead() for s in spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode())


def test_large_files_are_not_read(spark, tmp_path):
    line = "1,C 1,c@example.com,1 St,Boston,MA\n"
    for name in "abc":
        put(tmp_path, f"{name}.csv", f"{WIDE}\n" + line * 600_000)
    size = sum(f.stat().st_size for f in tmp_path.iterdir())
    before = bytes_read(spark)
    assert headers.files_by_header(spark, str(tmp_path), [WIDE, NARROW]) == {WIDE: None}
    assert bytes_read(spark) - before < size / 20


def test_files_are_opened_in_one_of_two_passes(spark, tmp_path):
    put(tmp_path, "large.csv", f"{WIDE}\n" + "1,C 1,,,,\n" * 20_000)
    put(tmp_path, "small.csv", f"{NARROW}\n2,C 2,,,\n")
    for large, name in ((True, "large.csv"), (False, "small.csv")):
        found = headers.first_lines(spark, str(tmp_path), large)
        assert [row["file"].rsplit("/", 1)[1] for row in found.collect()] == [name]
    by = headers.files_by_header(spark, str(tmp_path), [WIDE, NARROW])
    assert {h: [f.rsplit("/", 1)[1] for f in names] for h, names in by.items()} == {WIDE: ["large.csv"], NARROW: ["small.csv"]}


@pytest.mark.parametrize("lines", [0, 20_000])
def test_first_lines_as_the_reader_has_them(spark, tmp_path, lines):
    """Blank lines ahead, a byte order mark, quotes and carriage returns; a header further down is a row like others."""
    rest = "1,C 1,,,,\r\n" * lines
    put(tmp_path, "bom.csv", f"﻿{WIDE}\r\n{rest}")
    put(tmp_path, "quoted.csv", ",".join(f'"{name}"' for name in WIDE.split(",")) + f"\n{rest}")
    put(tmp_path, "blank.csv", f"\n \n{WIDE}\n{NARROW}\n{rest}")
    put(tmp_path, "none.csv", "")
    put(tmp_path, "only_blank.csv", "\n\n")
    put(tmp_path, "other.txt", "x\n")
    assert headers.files_by_header(spark, str(tmp_path), [WIDE, NARROW]) == {WIDE: None}
    put(tmp_path, "strange.csv", f"a,b\n{WIDE}\n{rest}")
    by = headers.files_by_header(spark, str(tmp_path), [WIDE, NARROW])
    assert [f.rsplit("/", 1)[1] for f in by[None]] == ["strange.csv"] and len(by[WIDE]) == 3


def test_no_lines_no_headers(spark, tmp_path):
    put(tmp_path, "a.csv", "")
    assert headers.files_by_header(spark, str(tmp_path), [WIDE]) == {}


def test_many_small_files(spark, tmp_path):
    for i in range(600):
        put(tmp_path, f"{i}.csv", f"{WIDE}\n{i},C,,,,\n" if i % 3 else f"{NARROW}\n{i},C,,,\n")
    found = files.scan_csv_variants(spark, str(tmp_path), raw_schema("customers"), [customers_without_city()])
    assert rows_of(found.select("customer_id")) == sorted([(i,) for i in range(600)], key=repr)


def test_settings_come_back(spark, tmp_path):
    put(tmp_path, "a.csv", f"{WIDE}\n")
    before = {key: spark.conf.get(key, None) for key in headers._ONE_FILE_A_TASK}
    headers.files_by_header(spark, str(tmp_path), [WIDE])
    assert {key: spark.conf.get(key, None) for key in before} == before
