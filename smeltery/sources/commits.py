"""Replacing tables so that a run that fails or dies leaves the old rows, or all of the new ones, and never a mixture.

A table is written to a folder beside its own, whose name starts with an underscore, and takes the old one's place by renaming
once it is whole. Tables that belong together, those of a layer's day, share a log: a record in it names the tables of the
run, and from the moment it is there the run counts, even if it dies before every folder is moved. Until the record is marked as
moved, readers follow it and the next run moves what is left. Tables that a run does not have go.

Renaming a folder is a single step on distributed and local file systems. Object stores copy: there the moves take longer,
which the record covers.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import SparkSession

_OLD = ".replaced"
PATIENCE = 60  # seconds without an end of another run's moves, which are renames, until it counts as dead


class Files:
    """The file system operations that commits need, by Hadoop paths."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """What is directly in a folder; nothing, if it is not there."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder))) if self.exists(folder) else []

    def rename(self, source: str, target: str) -> bool:
        if not self.exists(source):
            return False
        self._fs.mkdirs(self._path(target).getParent())
        return self._fs.rename(self._path(source), self._path(target))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def create(self, path: str, text: str) -> bool:
        """Write a small file unless there is one of that name; of several writers one succeeds."""
        at = self._path(path)
        self._fs.mkdirs(at.getParent())
        if self._fs.getScheme() == "file":
            # The local file system looks first and creates then; the operating system does both at once.
            local = self._jvm.java.io.File(at.toUri().getPath())
            if not local.createNewFile():
                return False
            out = self._fs.create(at, True)
        else:
            try:
                out = self._fs.create(at, False)
            except (Py4JJavaError, CapturedException) as error:
                if self.exists(path):
                    return False
                raise error
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def read(self, path: str) -> str:
        source = self._fs.open(self._path(path))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def summary(self, folder: str) -> tuple[int, int]:
        """Files under a folder and their bytes, hidden ones included."""
        found = self._fs.getContentSummary(self._path(folder))
        return found.getFileCount(), found.getLength()


def _beside(folder: str, what: str) -> str:
    parent, _, name = folder.rstrip("/").rpartition("/")
    return f"{parent}/_{name}{what}"


def new_sibling(folder: str) -> str:
    """A folder of its own beside this one that scans of their parent pass over."""
    return _beside(folder, f".next-{uuid.uuid4().hex}")


def standing(spark: SparkSession, folder: str) -> str:
    """Where the folder's rows are: in itself, or, if a run died between two renames, in the one that it was to replace."""
    files = Files(spark, folder)
    old = _beside(folder, _OLD)
    return old if not files.exists(folder) and files.exists(old) else folder


def put(spark: SparkSession, staged: str, folder: str) -> None:
    """Move a written folder to its place. One that is not there any more has been moved already."""
    files = Files(spark, folder)
    old = _beside(folder, _OLD)
    if not files.exists(staged):
        return
    if files.exists(folder):
        files.delete(old)
        files.rename(folder, old)
    if not files.rename(staged, folder):
        if files.exists(old) and not files.exists(folder):
            files.rename(old, folder)
        raise OSError(f"could not move {staged} to {folder}")
    files.delete(old)


# --- tables that belong together ---------------------------------------------------------


class Run:
    """One run over the tables of a log: folders to write to, and what becomes of the tables."""

    def __init__(self, finals: Mapping[str, str]) -> None:
        self.finals = dict(finals)
        self.folders = {name: new_sibling(folder) for name, folder in finals.items()}
        self.missing: set[str] = set()

    def leave_out(self, *names: str) -> None:
        """These tables are not part of the run: what an earlier one left of them goes."""
        self.missing.update(names)


def _records(files: Files, log: str) -> list[str]:
    return [name for name in files.names(log) if name.endswith(".json")]


def _newest(files: Files, log: str) -> tuple[str, dict] | None:
    """The last record and its content; one that its writer did not finish does not count."""
    for name in reversed(_records(files, log)):
        try:
            return name, json.loads(files.read(f"{log}/{name}"))
        except ValueError:
            continue
    return None


def _unmoved(files: Files, log: str) -> tuple[str, dict] | None:
    newest = _newest(files, log)
    return newest if newest and not files.exists(f"{log}/{newest[0]}.moved") else None


@contextmanager
def _alone(files: Files, log: str) -> Iterator[None]:
    """One run moves tables of a log at a time. A holder that shows no end for PATIENCE seconds is taken for dead."""
    lock, owner, seen, since = f"{log}/moving", uuid.uuid4().hex, None, time.monotonic()
    while not files.create(lock, owner):
        try:
            holder = files.read(lock)
        except (Py4JJavaError, CapturedException):  # gone meanwhile
            continue
        if holder != seen:
            seen, since = holder, time.monotonic()
        elif time.monotonic() - since >= PATIENCE:
            files.delete(lock)
        else:
            time.sleep(0.05)
    try:
        yield
    finally:
        files.delete(lock)


def recover(spark: SparkSession, log: str) -> None:
    """Move what the last run recorded and did not move."""
    files = Files(spark, log)
    if _unmoved(files, log) is None:
        return
    with _alone(files, log):
        left = _unmoved(files, log)
        if left is None:
            return
        name, record = left
        for folder in record["tables"].values():
            if folder["from"] is None:
                files.delete(folder["to"])
                files.delete(_beside(folder["to"], _OLD))
            else:
                put(spark, folder["from"], folder["to"])
        files.create(f"{log}/{name}.moved", "")
        for older in _records(files, log):
            if older < name:
                files.delete(f"{log}/{older}")
                files.delete(f"{log}/{older}.moved")


def current(spark: SparkSession, log: str, finals: Mapping[str, str]) -> dict[str, str | None]:
    """Folder of each table as of the last recorded run; None for tables that this run does not have."""
    files = Files(spark, log)
    left = _unmoved(files, log)
    tables = left[1]["tables"] if left else {}
    found: dict[str, str | None] = {}
    for name, final in finals.items():
        moved = tables.get(name)
        if moved and moved["from"] is None:
            found[name] = None
        elif moved and files.exists(moved["from"]):
            found[name] = moved["from"]
        else:
            found[name] = standing(spark, final)
    return found


@contextmanager
def replacing(spark: SparkSession, log: str, finals: Mapping[str, str]) -> Iterator[Run]:
    """A run whose tables take the places of these folders together, when the block ends; after an error none does.

    Of two runs over one log at a time, the one that records later wins.
    """
    recover(spark, log)
    files, run = Files(spark, log), Run(finals)
    try:
        yield run
    except BaseException:
        _drop(files, run.folders.values())
        raise
    tables = {name: {"from": None if name in run.missing else run.folders[name], "to": final} for name, final in run.finals.items()}
    text = json.dumps({"tables": tables})
    at = int((_records(files, log) or ["-1"])[-1].removesuffix(".json")) + 1
    while not files.create(f"{log}/{at:020d}.json", text):
        at += 1
    recover(spark, log)
    _drop(files, run.folders.values())


def _drop(files: Files, folders: Iterable[str]) -> None:
    for folder in folders:
        files.delete(folder)
