"""Folder scans and sinks for CSV, Parquet and JSON.

CSV types are declared by column name, never inferred: no inference pass over the data,
stable types for header-only files, and a value that does not parse becomes NULL (and is
dropped by the gates, and counted where an observation is given) instead of turning its
column into text. Whole numbers may be written with a fraction of zeros, as in 3.0. Which columns there are is
up to the files, so that a column the feed forgot is seen to be missing. Quoted texts may hold line breaks.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.session import settings
from smeltery.sources import commits, headers, records
from smeltery.sources.folders import CSV_FILES

# What stands for NULL besides an empty field: no text holds it, so that a quoted empty text stays a text.
_NO_TEXT = "\x00"
_UNPARSED = "__unparsed"
# Fixed value: the name Spark gives the partition of NULL.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Beside the files of a written CSV table: whether their texts hold line breaks. Scans pass over it.
_NOTE = "_line_breaks"
PACKED_CSV = "csv.gz"


def _files(spark: SparkSession):
    """Reader of the folder's CSV files; the folder is listed once, whatever the number of files."""
    return spark.read.option("pathGlobFilter", CSV_FILES).option("nullValue", _NO_TEXT)


def _header(spark: SparkSession, folder: str) -> list[str]:
    """Column names in the first line of one of the folder's CSV files; nothing else is read."""
    try:
        return _files(spark).option("header", True).csv(folder).columns
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        # No such file, or only empty ones: the pattern as a path says which.
        return spark.read.option("header", True).csv(f"{folder}/{CSV_FILES}").columns


def _value(f: T.StructField) -> Column:
    """A column read as text, with its wanted type."""
    text = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.StringType):
        return text
    text = F.trim(text)
    if isinstance(f.dataType, T.IntegralType):
        text = F.when(text.rlike(r"^[+-]?[0-9]+[.]0*$"), F.substring_index(text, ".", 1)).otherwise(text)
    return text.try_cast(f.dataType).alias(f.name)


def _lost(fields: Sequence[T.StructField]) -> Column:
    """How many of a row's values are there but do not parse."""
    typed = [f for f in fields if not isinstance(f.dataType, T.StringType)]
    lost = ((F.trim(F.col(f"`{f.name}`")) != "") & _value(f).isNull() for f in typed)
    return sum((F.coalesce(one, F.lit(False)).cast("long") for one in lost), F.lit(0).cast("long"))


def _csv(
    spark: SparkSession, fields: Sequence[T.StructField], paths: str | list[str], counted: bool, broken: bool,
) -> DataFrame:
    """The typed columns, and if counted the number of lost values.

    To count them all values are read as text; else only whole numbers are, so that gates on amounts reach the scan. With
    broken lines, records are put together first.
    """
    as_text = [counted or isinstance(f.dataType, T.IntegralType) for f in fields]
    read = [T.StructField(f.name, T.StringType() if text else f.dataType) for f, text in zip(fields, as_text, strict=True)]
    if broken:
        found = records.records(spark, paths, [f.name for f in fields])
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read)
        rows = found.select(F.from_csv("value", kinds, {"nullValue": _NO_TEXT}).alias("row")).select("row.*")
    else:
        reader = _files(spark).schema(T.StructType(read)).option("header", True).option("enforceSchema", False)
        rows = reader.csv(paths)
    columns = [_value(f) if text else F.col(f"`{f.name}`") for f, text in zip(fields, as_text, strict=True)]
    if counted:
        columns.append(_lost(fields).alias(_UNPARSED))
    return rows.select(*columns)


def _lines_broken(spark: SparkSession, folder: str) -> bool:
    """Whether a text of the folder's CSV files holds a line break: as noted when they were written, if nothing has come to
    the folder since; else all lines are looked at."""
    noted = _noted(commits.Files(spark, folder), folder)
    return records.has_line_breaks(spark, folder) if noted is None else noted


def _noted(known: commits.Files, folder: str) -> bool | None:
    """The folder's note on line breaks, unless the folder has changed since it was made."""
    path = f"{folder}/{_NOTE}"
    if not known.exists(path):
        return None
    text = known.read(path)
    files, size = known.summary(folder)
    note = json.loads(text)
    return note["broken"] if (files - 1, size - len(text)) == (note["files"], note["bytes"]) else None


def _observed(df: DataFrame, unparsed: Observation | None) -> DataFrame:
    if unparsed is None:
        return df
    return df.observe(unparsed, F.sum(_UNPARSED).alias("unparsed")).drop(_UNPARSED)


def scan(
    spark: SparkSession, folder: str, schema: T.StructType | str, fmt: str = "csv",
    unparsed: Observation | None = None,
) -> DataFrame:
    """All files of one folder as one table, duplicates kept. A missing folder raises.

    ``schema`` gives the CSV and JSON types by column name; CSV columns it does not name are
    text. CSV files whose headers differ from each other raise when read, and so does a
    folder without any ``*.csv`` or packed part. Parquet files bring their own types. ``unparsed`` counts CSV
    values that do not parse, in the pass of whoever uses the table.
    """
    folder = commits.standing(spark, folder)
    if fmt == "parquet":
        return spark.read.parquet(folder)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(folder)
    types = {f.name.lower(): f.dataType for f in schema}
    typed = [T.StructField(name, types.get(name.lower(), T.StringType())) for name in _header(spark, folder)]
    return _observed(_csv(spark, typed, folder, unparsed is not None, _lines_broken(spark, folder)), unparsed)


def scan_rejected(spark: SparkSession, folder: str, by: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """The rows that write_routed() rejected, with the verdict in the text column ``by``. No folder, no rows."""
    whole = T.StructType([*schema.fields, T.StructField(by, T.StringType())])
    folder = commits.standing(spark, folder)
    known = commits.Files(spark, folder)
    verdicts = [name.partition("=")[2] for name in known.names(folder) if name.startswith(f"{by}=")]
    parts = [scan(spark, f"{folder}/{by}={v}", schema, fmt).withColumn(by, F.lit(unquote(v))) for v in verdicts]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], whole)


def scan_optional(spark: SparkSession, folder: str, schema: T.StructType | str, fmt: str = "csv") -> DataFrame | None:
    """Like :func:`scan`, but None where there is nothing to read. Other errors still raise."""
    try:
        return scan(spark, folder, schema, fmt)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan_csv_variants(
    spark: SparkSession, folder: str, schema: T.StructType, narrower: Sequence[T.StructType],
    unparsed: Observation | None = None,
) -> DataFrame:
    """CSV files of which some lack columns of ``schema``, aligned by name; the columns a file lacks are NULL.

    Each file is read by its own header, so any selection of columns is right. Tasks read the first lines of the files to
    find the headers; a file without one of them raises ValueError, but for folders in which no file has one: these are
    scanned as they are.
    """
    folder = commits.standing(spark, folder)
    known = {",".join(variant.names): variant for variant in (schema, *narrower)}
    by = headers.files_by_header(spark, folder, list(known))
    if set(by) <= {None}:
        return scan(spark, folder, schema, unparsed=unparsed)
    if None in by:
        raise ValueError(f"unknown header in {sorted(by[None])[:3]}")
    broken = _lines_broken(spark, folder)
    parts = [
        _csv(spark, known[h].fields, folder if len(by) == 1 else files, unparsed is not None, broken)
        for h, files in sorted(by.items())
    ]
    whole = _observed(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), unparsed)
    missing = [f for f in schema.fields if f.name not in whole.columns]
    whole = whole.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return whole.select(*schema.names)


def write(df: DataFrame, folder: str, fmt: str = "csv", mode: str = "overwrite", packed: bool = False) -> None:
    """Replace the table in ``folder``, once the new one is whole: a write that fails leaves the old one, or none where
    there was none. Files are as many as ``df`` has partitions; ``packed`` CSV files are gzip files, each read by one task."""
    if mode != "overwrite":
        return _save(df, folder, fmt, mode, packed=packed)
    spark = df.sparkSession
    known = commits.Files(spark, folder)
    target = commits.new_sibling(folder) if known.exists(commits.standing(spark, folder)) else folder
    try:
        _save(df, target, fmt, "overwrite", packed=packed)
    except BaseException:
        known.delete(target)
        raise
    if target != folder:
        commits.put(spark, target, folder)


def write_sized(df: DataFrame, folder: str, file_bytes: int, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Write like :func:`write`, in files that are near a size, however many partitions ``df`` has and however uneven they are.

    The rows are shuffled once, by no key, and adaptive execution joins small parts and splits large ones, so no task holds the
    table. ``file_bytes`` counts shuffled bytes; files of a columnar format are smaller. For tables made of many tiny partitions:
    others cost a shuffle for nothing. Not for several tables at a time, as the size is a setting of the session.
    """
    spark = df.sparkSession
    values = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    with settings(spark, values):
        write(df.hint("rebalance"), folder, fmt, mode)


def write_routed(
    df: DataFrame, by: str, verdicts: Sequence[str], accepted: str, rejected: str, fmt: str = "csv", packed: bool = False,
) -> dict[str | None, int]:
    """Write the rows whose text column ``by`` is NULL to one new folder and the others to a second one, partitioned by that
    column, in one pass. Returns the rows of each verdict, NULL included, counted in the same pass.

    The files do not hold the column. The first folder is there even if no row is accepted, the second only if one is rejected.
    """
    known, seen = commits.Files(df.sparkSession, rejected), Observation()
    counts = [F.count_if(F.col(by).eqNullSafe(v)).alias(str(i)) for i, v in enumerate([None, *verdicts])]
    broken = _save(df.observe(seen, *counts), rejected, fmt, "errorifexists", by, packed)
    found = {v: seen.get[str(i)] for i, v in enumerate([None, *verdicts])}
    if not known.rename(f"{rejected}/{by}={_NO_VALUE}", accepted):
        _save(df.drop(by).limit(0), accepted, fmt, "errorifexists", packed=packed)
    if sum(found.values()) == found[None]:
        known.delete(rejected)
    if fmt == "csv":
        for folder in (accepted, rejected):
            _note(known, folder, broken)
    return {v: n for v, n in found.items() if n}


def write_parts(df: DataFrame, by: str, folders: Mapping[str, str], staged: str, fmt: str = "csv") -> None:
    """Write the rows of each value of the text column ``by`` to the new folder named for it, all in one job that writes to
    ``staged`` first. The files do not hold the column; a value without rows gets an empty table.
    The format PACKED_CSV is CSV in gzip files."""
    packed = fmt == PACKED_CSV
    fmt = "csv" if packed else fmt
    known = commits.Files(df.sparkSession, staged)
    broken = _save(df, staged, fmt, "errorifexists", by, packed)
    for value, folder in folders.items():
        if not known.rename(f"{staged}/{by}={value}", folder):
            _save(df.drop(by).limit(0), folder, fmt, "errorifexists", packed=packed)
        if fmt == "csv":
            _note(known, folder, broken)
    known.delete(staged)


def _save(df: DataFrame, folder: str, fmt: str, mode: str, by: str | None = None, packed: bool = False) -> bool:
    """Write, partitioned by a column if one is given. Returns whether a CSV text holds a line break."""
    if fmt != "csv":
        (df.write if by is None else df.write.partitionBy(by)).mode(mode).format(fmt).save(folder)
        return False
    known, texts = commits.Files(df.sparkSession, folder), [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    before = _noted(known, folder) if mode == "append" and known.exists(folder) else False
    breaks = reduce(or_, (F.col(f"`{name}`").rlike("[\n\r]") for name in texts), F.lit(False))
    seen = Observation()
    writer = df.observe(seen, F.count_if(breaks).alias("broken")).write
    writer = writer if by is None else writer.partitionBy(by)
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer.mode(mode).option("header", True).option("compression", "gzip" if packed else "none").options(**keep).csv(folder)
    broken = bool(seen.get["broken"])
    _note(known, folder, None if before is None else before or broken)
    return broken


def _note(known: commits.Files, folder: str, broken: bool | None) -> None:
    """Note on a folder whether its texts hold line breaks; None leaves it without a note."""
    known.delete(f"{folder}/{_NOTE}")
    if broken is not None and known.exists(folder):
        files, size = known.summary(folder)
        known.create(f"{folder}/{_NOTE}", json.dumps({"broken": broken, "files": files, "bytes": size}))


def write_counted(df: DataFrame, folder: str, fmt: str = "csv", mode: str = "overwrite", packed: bool = False) -> int:
    """Write and return the number of rows written, counted during the same pass."""
    counted = Observation()
    write(df.observe(counted, F.count(F.lit(1)).alias("row_count")), folder, fmt, mode, packed)
    return counted.get["row_count"]


def write_optional(df: DataFrame | None, folder: str, fmt: str = "csv") -> bool:
    """Write unless the table is missing (None); an empty table is written. True if written."""
    if df is None:
        return False
    write(df, folder, fmt)
    return True


def append(df: DataFrame, folder: str, fmt: str = "csv") -> None:
    """Add the files of one more run to a raw day folder."""
    write(df, folder, fmt, mode="append")


def staged(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` once and hand back the written table, which cuts its lineage."""
    _save(df, folder, "parquet", "errorifexists")
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession, folder: str) -> None:
    """Remove a folder of staged tables once their readers are done; a missing one is fine."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
