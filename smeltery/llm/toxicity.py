"""Toxicity by a linear classifier on character n-grams that are scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.shared import chunks, text_or_empty

SIZES = (3, 4, 5)  # of n-grams, in code points
BITS = 20  # of n-gram buckets
FEATURES = 3000  # buckets that the classifier weighs, those whose classes differ most
PER_CLASS = 2000  # labelled texts that it is fitted on, about, of each class


@dataclass
class Model:
    """Weights of n-gram buckets, already multiplied with their log-count ratios, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float

    def table(self) -> np.ndarray:
        weights = np.zeros(1 << BITS, np.float32)
        weights[self.buckets] = self.weights
        return weights


def grams(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text numbers, buckets) of all n-grams of lower-cased texts, one n after another."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    points = np.where((points >= 65) & (points <= 90), points + np.uint64(32), points)
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]
    of = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(starts))
    for n in SIZES:
        m = len(points) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + points[j : j + m]
            h ^= h >> np.uint64(29)
        inside = of[:m] == of[n - 1 :]
        bucket = (h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int64)
        yield of[:m][inside], bucket[inside]


def present(data: np.ndarray, at: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, bucket) of the buckets that wanted marks; each n-gram of a text counts once."""
    pairs = []
    for of, bucket in grams(data, at):
        held = wanted[bucket]
        pairs.append(of[held].astype(np.int64) << BITS | bucket[held])
    pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def fitted(texts: pa.Array, toxic: np.ndarray, totals: tuple[int, int], features: int = FEATURES, steps: int = 400, penalty: float = 1e-3) -> Model:
    """A logistic regression on the n-grams' log-count ratios. totals: rows of each class that the texts stand for.

    Without texts of both classes every score is the share of toxic rows, or 0.5 without rows."""
    toxic, n = toxic.astype(bool), len(toxic)
    prior = np.log((totals[1] + 1) / (totals[0] + 1))
    if not n or toxic.all() or not toxic.any():
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), float(prior))
    seen, every = np.zeros((2, 1 << BITS), np.int32), np.ones(1 << BITS, bool)
    for first, data, at in chunks(texts):
        of, bucket = present(data, at, every)
        for label in (0, 1):
            seen[label] += np.bincount(bucket[toxic[first + of] == label], minlength=1 << BITS).astype(np.int32)
    count = np.array([(~toxic).sum(), toxic.sum()])
    share = (seen + 1) / (count[:, None] + 2)
    ratio = np.log(share[1] / share[0])
    error = np.sqrt((share * (1 - share) / (count[:, None] + 2)).sum(0))
    chosen = np.argsort(-np.abs(share[1] - share[0]) / error, kind="stable")[:features]
    chosen = chosen[(seen[:, chosen].sum(0) > 2)]
    column = np.full(1 << BITS, -1)
    column[chosen] = np.arange(len(chosen))
    x = np.zeros((n, len(chosen)), np.float32)
    for first, data, at in chunks(texts):
        of, bucket = present(data, at, column >= 0)
        x[first + of, column[bucket]] = ratio[bucket]
    weight = np.where(toxic, totals[1] / count[1], totals[0] / count[0]).astype(np.float32)
    weight /= weight.sum()
    w, b = np.zeros(len(chosen), np.float32), np.float32(prior)
    m, v = np.zeros(len(w) + 1, np.float32), np.zeros(len(w) + 1, np.float32)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        e = weight * (p - toxic)
        g = np.append(x.T @ e + penalty * w, e.sum()).astype(np.float32)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(chosen.astype(np.int64), (w * ratio[chosen]).astype(np.float32), float(b))


def held_out(of: int, rest: int):
    """Whether a document is never learned from, by the CRC-32 of its id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % of == rest


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Learns labels.toxic of documents that are not held out, from about per_class texts of each class, drawn by the
    hashes of their ids. Null labels and ids and labels without a document do not count; of repeated ids the highest does."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out(5, 0))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    share = F.lit(0.0)
    for label in (0, 1):
        share = F.when(F.col("toxic") == label, min(1.0, per_class / counts.get(label, 1))).otherwise(share)
    drawn = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)).orderBy(F.xxhash64("doc_id")).limit(3 * per_class)
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(drawn), "doc_id").select("text", "toxic", "doc_id").limit(4 * per_class).toArrow()
    texts = texts.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
    label = texts["toxic"].to_numpy()
    return fitted(texts["text"].chunk(0) if len(label) else pa.array([], pa.string()), label, (counts.get(0, 0), counts.get(1, 0)))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted. Null and empty texts get the intercept's score;
    repeated rows are scored each; other columns are not read."""

    def run(batches):
        table = model.table()
        wanted = table != 0
        for batch in batches:
            scores = np.full(len(batch), model.intercept)
            for first, data, at in chunks(batch.column("text")):
                of, bucket = present(data, at, wanted)
                scores[first : first + len(at) - 1] += np.bincount(of, table[bucket], len(at) - 1)
            scores = 1 / (1 + np.exp(-np.clip(scores, -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
