"""Session settings the plans rely on, and where intermediate tables are written."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# forceOptimizeSkewedJoin lets a hot key be split even where that costs one more
# shuffle: the two joins on order_id share a partitioning, and without it a hot order
# would keep the whole first join in one task.
# Broadcasts are chosen by file size; the compression factor accounts for columns growing
# in memory, so that only sides that really are small qualify.
# A partition counts as skewed from 64 MB and twice the median, at any input size: that is what Spark cuts a skewed one down to
# anyway, so a hot key's partition is not read whole by one task until it is larger.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
}

_SHUFFLE_TARGET = 256 * 1024 * 1024
# Session setting that bounds the number of shuffle partitions; unset, nothing does.
MOST_PARTITIONS = "spark.smeltery.maxShufflePartitions"


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes under the given files and folders, as the file system sums them up; no job runs."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    total = 0
    for path in paths:
        at = hadoop.Path(path)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(at):
            total += fs.getContentSummary(at).getLength()
    return total


def shuffle_partitions(input_bytes: int, slots: int, most: int | None = None) -> int:
    """Partitions for shuffles of an input of this size on this many task slots, of 256 MB at most.

    Compressed columns grow about threefold in a shuffle. With ``most`` partitions grow beyond that size instead.
    """
    wanted = max(math.ceil(3 * input_bytes / _SHUFFLE_TARGET), slots)
    return wanted if most is None else min(wanted, most)


def _settings(spark: SparkSession, input_bytes: int | None) -> dict[str, str]:
    if input_bytes is None:
        return _SETTINGS
    most = spark.conf.get(MOST_PARTITIONS, None)
    partitions = shuffle_partitions(input_bytes, spark.sparkContext.defaultParallelism, int(most) if most else None)
    return _SETTINGS | {"spark.sql.shuffle.partitions": str(partitions)}


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Turn on adaptive skew handling; with an input size, fit the shuffles to it too."""
    for key, value in _settings(spark, input_bytes).items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def tuned(spark: SparkSession, *input_paths: str) -> Iterator[None]:
    """Apply :func:`tune` for the data under these folders while a job runs."""
    with settings(spark, _settings(spark, stored_bytes(spark, *input_paths))):
        yield


# Keys that a Bloom filter is made for: at 8 bits each, tasks and executors hold up to 16 MB.
_MOST_KEYS = 16_000_000
_BLOOM = "spark.sql.optimizer.runtime.bloomFilter"


def key_filter(keys: int) -> dict[str, str]:
    """Settings under which Spark filters the large side of a join by a Bloom filter of this many keys of the other side, before
    it shuffles the large side; with more keys than a filter is made for, none."""
    if keys > _MOST_KEYS:
        return {f"{_BLOOM}.enabled": "false"}
    keys = max(keys, 1000)
    return {
        f"{_BLOOM}.enabled": "true",
        # The keys are counted, so the bytes of their columns, as Spark guesses them, need not bound the filter.
        f"{_BLOOM}.creationSideThreshold": "10g",
        f"{_BLOOM}.applicationSideScanSizeThreshold": "1g",
        f"{_BLOOM}.expectedNumItems": str(keys),
        f"{_BLOOM}.numBits": str(8 * keys),
        f"{_BLOOM}.maxNumItems": str(_MOST_KEYS),
        f"{_BLOOM}.maxNumBits": str(8 * _MOST_KEYS),
    }


# A packed CSV file is read by one task, so few share one. Its columns take up to ten times its size in memory.
_PACKED_BYTES, _PACKED_FACTOR = 32 * 1024 * 1024, "10.0"


def layer_scans(spark: SparkSession, fmt: str) -> dict[str, str]:
    """Settings to read a layer of this format under: packed CSV files are dealt to more tasks, and broadcast from smaller sizes only,
    than plain ones."""
    if fmt != "csv":
        return {}
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return {
        "spark.sql.files.maxPartitionBytes": str(min(most, _PACKED_BYTES)),
        "spark.sql.sources.fileCompressionFactor": _PACKED_FACTOR,
    }


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or else one under the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir") + "/_shared").rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/smeltery/{purpose}-{uuid.uuid4().hex}"
