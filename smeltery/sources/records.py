"""CSV records whose quoted texts hold line breaks, read by many tasks a file.

A file is read as lines, in blocks as Spark splits it; a packed file is one block. At the end of a line the reader is either between two records or inside
a quoted text, so a line is a map from the one of these two states at its start to that at its end, and so is a block. One pass
over the lines that hold quotes gives each block's map; running over the blocks of a file gives the state in which each
starts. Knowing that, a task puts its lines together to records on its own. What lies before the first end of a record in
a block that starts inside a text belongs to the block before: these fragments, at most two a block, are joined afterwards.

Quotes open a text only at the start of a field, a backslash takes the meaning from the character after it, and what follows a
closing quote runs to the next comma, as in Spark's own reader. Records end with \n or \r\n.

The functions that run in tasks are shipped by value: executors do not need this library.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smeltery.sources.folders import CSV_FILES

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_REST_OF_TEXT = r'[^"\\]*+(?:\\(?:.|$)[^"\\]*+)*+"'  # up to its closing quote
_FIELDS = rf'(?:(?:"{_REST_OF_TEXT}[^,]*+|[^",][^,]*+)?+,)*+(?:"{_REST_OF_TEXT}[^,]*+|[^",][^,]*+)?+'
_WHOLE = re.compile(_FIELDS, re.DOTALL)  # a line that starts between records and ends so
_CLOSING = re.compile(rf"{_REST_OF_TEXT}[^,]*+(?:,{_FIELDS})?+", re.DOTALL)  # that starts inside a text and ends between records


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that starts inside a quoted text, or between records, ends inside one."""
    if '"' not in line:
        return inside
    return (_CLOSING if inside else _WHOLE).fullmatch(line) is None


def has_line_breaks(spark: SparkSession, paths: str | list[str]) -> bool:
    """Whether any record of the CSV files goes over several lines. It reads all lines, of which those with quotes are looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if any(ends_inside(line, False) for line in batch.column(0).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array([True])], ["broken"])
                return

    # Lines as Spark's own reader has them, which ends lines at \r too. While none of them ends inside a text, each starts between records.
    lines = spark.read.option("pathGlobFilter", CSV_FILES).text(paths)
    return not lines.filter(F.contains("value", F.lit('"'))).mapInArrow(run, "broken boolean").isEmpty()


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    lines = spark.read.option("pathGlobFilter", CSV_FILES).option("lineSep", "\n").text(paths)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The parts of a batch that lie in one block each."""
    files = batch.column("file").dictionary_encode().indices.to_numpy()
    starts = batch.column("block").to_numpy()
    edges = np.flatnonzero((np.diff(files) != 0) | (np.diff(starts) != 0)) + 1
    for at, end in zip([0, *edges], [*edges, len(batch)], strict=True):
        if end > at:
            yield batch.slice(at, end - at)


def _key(part: pa.RecordBatch) -> tuple[str, int]:
    return part.column("file")[0].as_py(), part.column("block")[0].as_py()


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block the state at its end, if it starts between records and if it starts inside a text."""
    key, state = None, [False, True]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, *state)], ["file", "block", "between", "inside"])

    for batch in batches:
        for part in _runs(batch):
            if _key(part) != key:
                if key is not None:
                    yield row()
                key, state = _key(part), [False, True]
            for line in part.column("value").to_pylist():
                if '"' in line:
                    state = [ends_inside(line, s) for s in state]
    if key is not None:
        yield row()


def _starts(lines: DataFrame) -> DataFrame:
    """file, block and whether the block starts inside a text: each block's map applied to what the ones before it give."""
    maps = lines.mapInArrow(_maps, "file string, block long, between boolean, inside boolean")
    order = Window.partitionBy("file").orderBy("block")
    # A block that ends alike however it starts settles the state; one that ends in the other state turns it.
    turned = F.sum((F.col("between") & ~F.col("inside")).cast("int")).over(order)
    maps = maps.withColumn("turned", turned)
    settled = F.when(F.col("between") == F.col("inside"), F.struct(F.col("between").cast("int").alias("state"), "turned"))
    maps = maps.withColumn("settled", F.last(settled, ignorenulls=True).over(order))
    end = F.coalesce(F.col("settled.state") + F.col("turned") - F.col("settled.turned"), F.col("turned")) % 2
    return maps.select("file", "block", F.coalesce(F.lag(end == 1).over(order), F.lit(False)).alias("starts_inside"))


_BLANK = "".join(map(chr, range(33)))

# What a task hands on: a record, and what belongs to a record of the blocks before, or goes on in the blocks after.
RECORD, BEFORE, AFTER = 0, 1, 2


def _assembled(header: Sequence[str], crossing: bool):
    """Records of blocks whose state at the start is known; the header, the first record of a file, is checked and left out.

    If none is `crossing` from block to block, one that is open at the end of a block is the last of its file.
    """
    left_open = AFTER if crossing else RECORD

    def rows(kind: int, texts: list[str] | pa.Array, part: pa.RecordBatch) -> pa.RecordBatch:
        file, block = _key(part)
        n, values = len(texts), texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        columns = [pa.array([kind] * n, pa.int32()), pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), values]
        return pa.RecordBatch.from_arrays(columns, ["kind", "file", "block", "value"])

    def body(records: list[str], file: str) -> list[str]:
        names = next(csv.reader([records[0].removesuffix("\r").removeprefix("\ufeff")], escapechar="\\", doublequote=False))
        if [n.lower() for n in names] != [n.lower() for n in header]:
            raise ValueError(f"CSV header of {file} is {names}, not {list(header)}")
        return records[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # a part of the block at hand
        inside = leads = headed = False
        kept: list[str] = []
        for batch in batches:
            for part in _runs(batch):
                if last is None or _key(part) != _key(last):
                    if kept:
                        yield rows(BEFORE if leads else left_open, ["\n".join(kept)], last)
                    inside = leads = part.column("starts_inside")[0].as_py()
                    kept, headed = [], _key(part)[1] > 0
                last, values = part, part.column("value")
                if headed and not inside and not kept and not pc.any(pc.match_substring(values, '"')).as_py():
                    yield rows(RECORD, values, part)
                    continue
                records = []
                for line in values.to_pylist():
                    kept.append(line)
                    inside = ends_inside(line, inside)
                    if inside:
                        continue
                    text, kept = "\n".join(kept), []
                    if leads:
                        yield rows(BEFORE, [text], part)
                        leads = False
                    elif text.strip(_BLANK):
                        records.append(text)
                if not headed and records:
                    records, headed = body(records, _key(part)[0]), True
                yield rows(RECORD, records, part)
        if kept:
            yield rows(BEFORE if leads else left_open, ["\n".join(kept)], last)

    return run


def records(spark: SparkSession, paths: str | list[str], header: Sequence[str]) -> DataFrame:
    """The records of the CSV files, without headers, as one column of text each. Blank lines between them are left out.

    Files are read once for the state at the start of each block, and once for the records; a third time for fragments, but
    only if a block starts inside a text.
    """
    lines = _lines(spark, paths)
    # At most one row a block, of which the driver has a list anyway. Not cached: a cache would outlive the files of that path.
    inside = _starts(lines).filter("starts_inside").collect()
    crossing = bool(inside)
    starts = spark.createDataFrame(inside, "file string, block long, starts_inside boolean")
    known = lines.join(F.broadcast(starts), ["file", "block"], "left") if crossing else lines.withColumn("starts_inside", F.lit(False))
    known = known.withColumn("starts_inside", F.coalesce("starts_inside", F.lit(False)))
    found = known.mapInArrow(_assembled(header, crossing), "kind int, file string, block long, value string")
    whole = found.filter(F.col("kind") == RECORD).select("value")
    if crossing:
        # What goes on after a block opens a record, to which all belongs that lies before the next one.
        parts = found.filter(F.col("kind") != RECORD)
        order = Window.partitionBy("file").orderBy("block", "kind")
        parts = parts.withColumn("number", F.sum((F.col("kind") == AFTER).cast("int")).over(order))
        texts = F.transform(F.sort_array(F.collect_list(F.struct("block", "kind", "value"))), lambda p: p["value"])
        whole = whole.unionAll(parts.groupBy("file", "number").agg(F.array_join(texts, "\n").alias("value")).select("value"))
    return whole.filter(F.col("value").rlike(r"[^\x00-\x20]")).withColumn("value", F.regexp_replace("value", "\r$", ""))
