"""Benchmark decontamination: one Aho-Corasick automaton over the windows of normalised benchmark items."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.llm.shared import chunks, fresh, lean, lowered, slices, staged, table, words_of

WINDOW = 13
PATTERN_CHARS = 2_000_000  # in one automaton; about 100 MB in a task

_SPAN = T.StructType([T.StructField(c, T.LongType()) for c in ("first_word", "end_word", "start", "end")])
REPORT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(_SPAN)),
])


_SPACED = np.where(table("alnum"), lowered(), 32).astype(np.uint8).tobytes()


def plain(text: bytes) -> str:
    """Words in lower case, each between single spaces; one character per byte."""
    words = text.translate(_SPACED).split()
    return f" {b' '.join(words).decode('latin-1')} " if words else ""


def automaton_of(shared: Broadcast) -> ahocorasick.Automaton:
    """The automaton over broadcast windows. A worker builds it once and keeps it with the broadcast, for its later tasks."""
    if not hasattr(shared, "automaton"):
        shared.automaton = ahocorasick.Automaton()
        for window, items in shared.value.items():
            shared.automaton.add_word(window, (len(window), window.count(" ") - 1, items))
        shared.automaton.make_automaton()
    return shared.automaton


def found_in(automaton: ahocorasick.Automaton, text: str) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged ranges of word numbers that windows cover, and the items whose windows occur."""
    if not len(automaton):
        return [], set()
    hits, items = [], set()
    for end, (length, n, of) in automaton.iter(text):
        hits.append((end - length + 1, n))
        items.update(of)
    if not hits:
        return [], items
    gaps = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
    ranges = [(int(f), int(f) + n) for f, (_, n) in zip(np.searchsorted(gaps, [h[0] for h in hits]), hits, strict=True)]
    return merged(ranges), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def windows_of(item: str, text: str | None, size: int = WINDOW) -> Iterator[tuple[str, str]]:
    words = plain((text or "").encode()).split(" ")[1:-1]
    for i in range(max(1, len(words) - size + 1) if words else 0):
        yield f" {' '.join(words[i : i + size])} ", item


def pattern_groups(benchmark: DataFrame, size: int = WINDOW, limit: int = PATTERN_CHARS) -> Iterator[dict[str, list[str]]]:
    """The benchmark's windows in groups of about limit characters at most, dealt by their hashes; one group for usual
    benchmarks. Tasks cut the windows, and the driver holds one group at a time."""

    def run(batches):
        for batch in batches:
            rows = (w for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True) for w in windows_of(item or "", text, size))
            while some := list(islice(rows, 10_000)):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*some, strict=True)], ["window", "item"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    cut = staged(items.mapInArrow(lean(run), "window string, item string").groupBy("window").agg(F.collect_set("item").alias("items")), "windows")
    n = -(-(cut.agg(F.sum(F.length("window"))).first()[0] or 0) // limit)
    if n > 1:
        number = F.pmod(F.xxhash64("window"), F.lit(n))
        cut = staged(cut.withColumn("number", number).repartitionByRange("number").sortWithinPartitions("number"), "window-groups")
    for i in range(max(1, n)):
        found = (cut.filter(F.col("number") == i) if n > 1 else cut).select("window", "items").toArrow()
        yield {w: sorted(of) for w, of in zip(found["window"].to_pylist(), found["items"].to_pylist(), strict=True)}


def _scan(patterns, text_column: str, report: str, keep: list[str]):
    """A pass of mapInArrow over whole texts that adds what one automaton finds to the report column."""
    kind = pa.struct([
        ("n_words", pa.int64()), ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([(c, pa.int64()) for c in ("first_word", "end_word", "start", "end")]))),
    ])

    def spans(text: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
        """Word ranges with their code-point offsets in the original text."""
        if not ranges:
            return []
        data = np.frombuffer(text, np.uint8)
        starts, ends, _ = words_of(data, np.array([0, len(data)]), table("alnum"))
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return [{"first_word": a, "end_word": b, "start": int(points[starts[a]]), "end": int(points[ends[b - 1]])} for a, b in ranges]

    def run(batches):
        for batch in batches:
            before = batch.column(report).to_pylist() if report in batch.schema.names else [None] * len(batch)
            out = []
            for first, data, at in chunks(batch.column(text_column)):
                whole = data.tobytes()
                for i in range(len(at) - 1):
                    text = whole[at[i] : at[i + 1]]
                    words = plain(text)
                    ranges, items = found_in(automaton_of(patterns), words)
                    if was := before[first + i]:
                        ranges = merged(ranges + [(s["first_word"], s["end_word"]) for s in was["spans"]])
                        items = items | set(was["items"])
                    out.append({"n_words": max(0, words.count(" ") - 1), "items": sorted(items), "spans": spans(text, ranges)})
            columns = [batch.column(c) for c in keep] + [pa.array(out, kind)]
            yield from slices(pa.RecordBatch.from_arrays(columns, [*keep, report]))

    return run


def scanned(docs: DataFrame, benchmark: DataFrame, keep: list[str], report: str, size: int = WINDOW, limit: int = PATTERN_CHARS) -> DataFrame:
    """The columns keep of docs and one column report: n_words, items (sorted ids of the items with windows in the
    text), spans (word ranges that windows cover, with the code-point offsets of the original text).

    Null texts have no words, and so have null items; a null item_id counts as the empty string. Rows with equal ids are
    scanned each for itself; items with one id count once. Benchmarks beyond limit characters of windows are scanned by
    several automata, one pass each; what a pass has found is written to the shared folder with the rows before the next, so that one
    automaton lives at a time.
    """
    spark, groups = docs.sparkSession, pattern_groups(benchmark, size, limit)
    found, patterns = docs.select(*dict.fromkeys([*keep, "text"])), next(groups)
    while True:
        shared, patterns = spark.sparkContext.broadcast(patterns), next(groups, None)
        columns = found.columns if patterns is not None else keep
        columns = [c for c in columns if c != report]
        schema = T.StructType([docs.schema[c] for c in columns] + [T.StructField(report, REPORT)])
        found = found.mapInArrow(lean(_scan(shared, "text", report, columns)), schema)
        if patterns is None:
            return found
        found = staged(found, "scanned")
        shared.unpersist()


def n_hit(report: str) -> Column:
    return F.aggregate(f"{report}.spans", F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["first_word"])


def is_contaminated(report: str, per: int = 20) -> Column:
    """At least one word in per is hit, and one at all."""
    return (n_hit(report) > 0) & (per * n_hit(report) >= F.col(f"{report}.n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    report = fresh(docs, "report")
    found = scanned(docs, benchmark, ["doc_id"], report)
    return found.select(
        "doc_id", f"{report}.n_words", n_hit(report).alias("n_hit"), F.size(f"{report}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(f"{report}.items"), ","), 256).alias("items_sha256"),
        is_contaminated(report).alias("contaminated"), f"{report}.spans",
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that are not contaminated. Null and empty texts stay, repeated rows are judged each; an
    empty table, or an empty benchmark, changes nothing."""
    report = fresh(docs, "report")
    found = scanned(docs, benchmark, docs.columns, report)
    return found.filter(~is_contaminated(report)).drop(report)
