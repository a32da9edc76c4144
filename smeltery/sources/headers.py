"""Headers of a folder's CSV files, found without reading the files.

Tasks read first lines only. A large file is a task of its own, which stops once it has the line, so that little more than
one read buffer of the file is fetched. Files of up to SMALL bytes, for which opening costs more than reading, share tasks and
are read whole. Sizes come from the listing: a file is only opened in one of the two passes. What goes to the driver is a row
a header; files are named there only where headers differ, and then the scans need their names.

The functions that run in tasks are shipped by value: executors do not need this library.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from smeltery.session import settings
from smeltery.sources.folders import CSV_FILES

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SMALL = 64 * 1024  # bytes
# As the size of a partition and as the cost of opening a file, this makes each file a partition; only files beyond it have
# several. Batches are small, so that a task has its line before much is read.
_ONE_FILE_A_TASK = {
    "spark.sql.files.maxPartitionBytes": str(1 << 40),
    "spark.sql.files.openCostInBytes": str(1 << 40),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
}
# Characters beside each line: the buffers between Spark and Python, which are filled before a task can stop, then hold few lines.
_PADDING = 16 * 1024


def _first_lines(alone: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """First lines of the files of a task, those without a character that is not white space passed over; ``alone`` says that
    there is one file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = None
        for batch in batches:
            found = []
            for file, block, line in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "line")), strict=True):
                if file != done and block == 0 and line.strip():
                    found.append((file, line))
                    done = file
            files, lines = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(lines, pa.string())], ["file", "line"])
            if alone and (found or batch.column("block")[0].as_py()):
                return

    return run


def first_lines(spark: SparkSession, folder: str, large: bool) -> DataFrame:
    """(file, line): the first line of each CSV file of the folder that is beyond SMALL bytes, or of each that is not.
    The byte order mark, quotes and carriage returns are taken out. Files without a line have no row."""
    lines = spark.read.option("pathGlobFilter", CSV_FILES).text(folder)
    lines = lines.filter(F.col("_metadata.file_size") > SMALL if large else F.col("_metadata.file_size") <= SMALL)
    columns = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line")]
    if large:
        columns.append(F.repeat(F.lit(" "), F.lit(_PADDING)).alias("padding"))
    found = lines.select(*columns).mapInArrow(_first_lines(large), "file string, line string")
    return found.withColumn("line", F.regexp_replace("line", r'["\ufeff\r]', ""))


def files_by_header(spark: SparkSession, folder: str, known: Sequence[str]) -> dict[str | None, list[str] | None]:
    """The known headers that the folder's CSV files have, and None if some files have another; with the files of each where
    there are several, else without. Nothing for a folder without lines."""

    def collected(*columns: str) -> list[Row]:
        rows = []
        for large, values in ((True, _ONE_FILE_A_TASK), (False, {})):
            with settings(spark, values):
                header = F.when(F.col("line").isin(*known), F.col("line")).alias("header")
                rows += first_lines(spark, folder, large).select("file", header).select(*columns).distinct().collect()
        return rows

    headers = {row["header"] for row in collected("header")}
    by: dict[str | None, list[str] | None] = dict.fromkeys(headers)
    if len(headers) > 1:
        by = {header: [] for header in headers}
        for row in collected("header", "file"):
            by[row["header"]].append(row["file"])
    return by
