"""Helpers of several operators: tables in the shared folder, columns, and words of Arrow texts as numpy arrays."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the contracts, [\x20\x09-\x0D].
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"

CHUNK_BYTES = 1 << 18  # text that numpy works on at once


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else one beside the warehouse's tables."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written once to a folder of its own in the shared folder and read from there.

    It cuts the lineage: a lost executor costs a read of the files, and values that depend on a task's number stay as
    they were written. The folder stays for the result's reader; its owner empties the shared folder after a run.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lean(run):
    """run, a function of batches, that hands its task's freed memory back to the system: workers live on between tasks
    of different jobs, and what each has ever used would add up."""

    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return wrapped


def slices(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that the reader of whole texts holds few of them at once."""
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)


def packed(docs: DataFrame, column: str = "text") -> DataFrame:
    """docs with the texts of a column as zstd blobs, a third smaller in a shuffle than Spark's own compression of rows."""
    others = [c for c in docs.columns if c != column]

    def run(batches):
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            blobs = pa.array([compress((t.as_py() or "").encode()) for t in batch.column(column)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), blobs], [*others, column])

    return docs.select(*others, column).mapInArrow(lean(run), docs.select(*others).withColumn(column, F.lit(b"")).schema)


def unpacked(blobs: pa.Array) -> list[bytes]:
    """The UTF-8 texts of packed()."""
    read = zstandard.ZstdDecompressor().decompress
    return [read(b) for b in blobs.to_pylist()]


def table(which: str) -> np.ndarray:
    """For each byte, whether it belongs to a word: 'space' splits at white space, 'alnum' at all ASCII but 0-9 A-Z a-z."""
    inside = np.ones(256, bool)
    if which == "space":
        inside[[ord(c) for c in SPACE]] = False
    else:
        inside[:128] = [chr(b).isalnum() for b in range(128)]
    return inside


def lowered() -> np.ndarray:
    """Each byte, A-Z as a-z."""
    return np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts, about limit bytes each; a longer text is a run of its own.
    Null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def words_of(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the words in byte positions; text i has the words first[i] to first[i + 1]."""
    is_in = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts = is_in.copy()
    starts[1:] &= ~is_in[:-1] | edge[1:-1]
    ends = is_in.copy()
    ends[:-1] &= ~is_in[1:] | edge[1:-1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of words, and of runs of words, by polynomials modulo 2^64 over random byte codes."""

    ODD = 0x9E3779B97F4A7C15

    def __init__(self, seed: int = 7) -> None:
        self.codes = np.random.default_rng(seed).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 2 * CHUNK_BYTES)
            one = np.ones(1, np.uint64)
            self.power = np.cumprod(np.concatenate([one, np.full(n - 1, self.ODD, np.uint64)]))
            self.inverse = np.cumprod(np.concatenate([one, np.full(n - 1, pow(self.ODD, -1, 1 << 64), np.uint64)]))

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.power[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.inverse[starts])

    @staticmethod
    def runs(words: np.ndarray, k: int) -> np.ndarray:
        """Hashes of k consecutive words from each position on; the last k - 1 positions are left out."""
        n = len(words) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = words[:n].copy()
        for j in range(1, k):
            out *= np.uint64(Hasher.ODD)
            out += words[j : j + n]
        return mixed(out)
