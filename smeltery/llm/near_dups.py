"""Near duplicates: MinHash candidates, verified sequentially by Bayes' rule, then on the full sets.

Documents with equal shingle sets are one class. Bands of the classes' signatures put similar classes into buckets.
A pair of a bucket is compared signature batch by signature batch; it is dropped once the posterior probability that its
similarity reaches the threshold falls below a chosen miss probability. Survivors are compared on their whole sets.

Only which classes hang together matters, so a bucket does not emit its pairs. First all its members are compared with one
of them, the hub; members that hang together then need no comparison among themselves. Then the members outside the
bucket's largest component are compared with those of other components, in bounded blocks inside tasks, each pair in the
first band that it shares, and only the links leave the task. After that no pair of a bucket is left whose comparison
could join two components.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.components import components
from smeltery.llm.shared import Hasher, chunks, fresh, lean, lowered, mixed, packed, staged, table, text_or_empty, unpacked, words_of


@dataclass(frozen=True)
class Settings:
    """Shingles of `shingle` words; links from a similarity of percent / 100 on. With 32 bands of 8 rows a pair at 0.85
    shares no band once in 26,000 times, at 0.8 once in 360; miss is the probability at which a batch drops a pair."""

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 8
    batch: int = 32
    miss: float = 1e-6
    asked: int = 2048  # members of a bucket outside its largest component that a task holds at once
    met: int = 32_768  # members that it compares them with

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


#: For the threshold 0.8: a pair at it shares no band once in 20,000 times.
NEAR = Settings(bands=42, rows=7)


def least_matches(s: Settings) -> list[tuple[int, int]]:
    """(n, m): of the first n hashes m must agree, else the posterior of a similarity at the threshold or above, under a
    uniform prior, is below the miss probability. For m of n it is the chance of at most m successes in n + 1 draws."""
    out, t = [], s.percent / 100
    for n in range(s.batch, s.hashes + 1, s.batch):
        total, m = 0.0, -1
        while total < s.miss:
            m += 1
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def shingle_sets(data: np.ndarray, at: np.ndarray, k: int, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the sorted distinct shingles of each text, text i from first[i] to first[i + 1]. A text of fewer
    words than k has its whole sequence as one shingle, without words none."""
    data = lowered()[data]
    starts, ends, first = words_of(data, at, table("space"))
    words = hasher.words(data, starts, ends)
    n = np.diff(first)
    of = np.repeat(np.arange(len(n)), n)
    grams = Hasher.runs(words, k)
    inside = of[: len(grams)] == of[len(words) - len(grams) :] if len(grams) else np.zeros(0, bool)
    grams, of = grams[inside], of[: len(grams)][inside]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        extra = np.array([mixed(Hasher.runs(words[first[i] : first[i + 1]], int(n[i])) + np.uint64(n[i]))[0] for i in short], np.uint64)
        grams, of = np.concatenate([grams, extra]), np.concatenate([of, short])
    order = np.lexsort((grams, of))
    grams, of = grams[order], of[order]
    new = np.concatenate([[True], (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])]) if len(grams) else np.zeros(0, bool)
    grams, of = grams[new], of[new]
    return grams, np.searchsorted(of, np.arange(len(n) + 1))


def signatures(grams: np.ndarray, first: np.ndarray, hashes: int, seed: int = 11) -> np.ndarray:
    """(texts, hashes): for each hash function the minimum over the text's shingles, 16 bits of it. Empty sets have zeros."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 1 << 31, hashes, np.uint32) * np.uint32(2) + np.uint32(1)
    offsets = rng.integers(0, 1 << 32, hashes, np.uint32)
    out = np.zeros((len(first) - 1, hashes), np.uint16)
    some = np.flatnonzero(np.diff(first))
    if not len(some):
        return out
    x = (grams >> np.uint64(32)).astype(np.uint32)
    begin = first[some]
    for j in range(hashes):
        least = np.minimum.reduceat(x * factors[j] + offsets[j], begin)
        out[some, j] = (mixed(least) >> np.uint64(48)).astype(np.uint16)
    return out


def sketched(docs: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, n_shingles, sets, signature) per row: sets is the SHA-256 of the sorted shingle hashes."""

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            n, sets, signed = [], [], []
            for _, data, at in chunks(batch.column("text")):
                grams, first = shingle_sets(data, at, s.shingle, hasher)
                n += np.diff(first).tolist()
                sets += [hashlib.sha256(grams[a:b].tobytes()).digest() for a, b in zip(first[:-1], first[1:], strict=True)]
                signed += [row.tobytes() for row in signatures(grams, first, s.hashes)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(signed, pa.binary())], ["doc_id", "n_shingles", "sets", "signature"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(lean(run), "doc_id long, n_shingles long, sets binary, signature binary")


def bands(classes: DataFrame, s: Settings) -> DataFrame:
    """(bucket, rep): a row for each band of each class. The band is the remainder of the bucket by the bands' number."""

    def run(batches):
        for batch in batches:
            n = len(batch)
            data = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(n, s.bands, s.rows)
            key = np.zeros((n, s.bands), np.uint64)
            for r in range(s.rows):
                key = mixed(key * np.uint64(Hasher.ODD) + data[:, :, r] + np.uint64(1))
            key = mixed(key) >> np.uint64(1)
            key = key - key % np.uint64(s.bands) + np.arange(s.bands, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(batch.column("rep").to_numpy(), s.bands))], ["bucket", "rep"])

    return classes.select("rep", "signature").mapInArrow(lean(run), "bucket long, rep long")


def survivors(pairs: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) that the sequential comparison of their signatures does not drop."""
    stops = least_matches(s)

    def run(batches):
        for batch in batches:
            n = len(batch)
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(n, s.hashes) for c in ("sa", "sb"))
            alive, agree, done = np.arange(n), np.zeros(n, np.int64), 0
            for upto, least in stops:
                agree[alive] += (x[alive, done:upto] == y[alive, done:upto]).sum(1)
                alive, done = alive[agree[alive] >= least], upto
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(alive)) for c in ("a", "b")], ["a", "b"])

    signed = lambda c: classes.select(F.col("rep").alias(c), F.col("signature").alias(f"s{c}"))
    return pairs.join(signed("a"), "a").join(signed("b"), "b").select("a", "b", "sa", "sb").mapInArrow(lean(run), "a long, b long")


def _similar(x: np.ndarray, y: np.ndarray, allowed: np.ndarray, stops: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (of x, of y) of the allowed pairs that the sequential comparison keeps."""
    i, j = np.nonzero(allowed)
    agree, done = np.zeros(len(i), np.int64), 0
    for upto, least in stops:
        agree += (x[i, done:upto] == y[j, done:upto]).sum(1)
        held = agree >= least
        i, j, agree, done = i[held], j[held], agree[held], upto
    return i, j


def _sets(blobs: list[bytes], s: Settings, hasher: Hasher) -> list[np.ndarray]:
    """Shingle sets of texts as packed() has them."""
    out = []
    for _, data, at in chunks(pa.array(unpacked(pa.array(blobs, pa.binary())), pa.binary()).cast(pa.string())):
        grams, first = shingle_sets(data, at, s.shingle, hasher)
        out += [grams[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    return out


def _linked(x: np.ndarray, y: np.ndarray, s: Settings) -> bool:
    if 100 * min(len(x), len(y)) < s.percent * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= s.percent * (len(x) + len(y) - common)


class Asked:
    """Some rows of a batch: their classes, components, signatures, and shingle sets, each made when it is asked for."""

    def __init__(self, rep, component, out, signed, texts, s: Settings, hasher: Hasher) -> None:
        self.rep, self.component, self.out, self.signed, self.texts = rep, component, out, signed, texts
        self.sets, self.s, self.hasher = {}, s, hasher

    def have(self, rows: np.ndarray) -> None:
        new = [int(i) for i in np.unique(rows) if int(i) not in self.sets]
        self.sets.update(zip(new, _sets([self.texts[i] for i in new], self.s, self.hasher), strict=True))


def links_across(members: DataFrame, classes: DataFrame, texts: DataFrame, s: Settings, tile: int = 128) -> DataFrame:
    """The links (u, v) between members of a bucket that are in different components.

    members: bucket, rep, component. In each bucket those outside its largest component ask, and all others answer; large
    buckets are cut into blocks of both, and each pair of blocks is a group of its own, in any task."""
    by = members.groupBy("bucket", "component").count().groupBy("bucket").agg(F.max(F.struct("count", "component"))["component"].alias("largest"), F.sum("count").alias("n"), (F.sum("count") - F.max("count")).alias("n_out"))
    known = classes.select("rep", "signature").join(texts, "rep")
    rows = members.join(by, "bucket").join(known, "rep")
    part = lambda n: F.pmod(F.xxhash64("rep"), n)
    rows = rows.withColumn("x", F.ceil(F.col("n") / s.met)).withColumn("y", F.ceil(F.col("n_out") / s.asked)).withColumn("out", F.col("component") != F.col("largest"))
    asks = rows.filter("out").withColumn("kind", F.lit(0)).withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("x") - 1))).withColumn("y", part(F.col("y")))
    answers = rows.withColumn("kind", F.lit(1)).withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("y") - 1))).withColumn("x", part(F.col("x")))
    both = asks.unionByName(answers).select(F.xxhash64("bucket", "x", "y").alias("block"), "kind", "bucket", "rep", "component", "out", "signature", "text")
    stops = least_matches(s)

    def compared(q: Asked, r: Asked, band: int, found: list) -> None:
        for u in range(0, len(q.rep), tile):
            for v in range(0, len(r.rep), tile):
                c, p = r.component[v : v + tile, None], r.rep[v : v + tile, None]
                allowed = (c != q.component[None, u : u + tile]) & (~r.out[v : v + tile, None] | (p < q.rep[None, u : u + tile]))
                i, j = _similar(r.signed[v : v + tile], q.signed[u : u + tile], allowed, stops)
                i, j = i + v, j + u
                shared = (r.signed[i] == q.signed[j]).reshape(len(i), s.bands, s.rows).all(2)
                first = shared.argmax(1) == band
                i, j = i[first], j[first]
                r.have(i)
                q.have(j)
                found += [(int(r.rep[a]), int(q.rep[b])) for a, b in zip(i, j, strict=True) if _linked(r.sets[int(a)], q.sets[int(b)], s)]

    def run(batches):
        block, asked, hasher = None, [], Hasher()
        for batch in batches:
            at, kind, bucket, rep, component, out = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "kind", "bucket", "rep", "component", "out"))
            signed = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(len(batch), s.hashes)
            blobs, found = batch.column("text").to_pylist(), []
            edges = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (kind[1:] != kind[:-1]), [True]])) if len(at) else [0]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if at[a] != block:
                    block, asked = at[a], []
                rows = Asked(rep[a:b], component[a:b], out[a:b], signed[a:b], blobs[a:b], s, hasher)
                if kind[a] == 0:
                    asked.append(rows)
                else:
                    for q in asked:
                        compared(q, rows, int(bucket[a] % s.bands), found)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else ((), ()))], ["u", "v"])

    return both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(lean(run), "u long, v long")


def links(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The pairs (u, v) whose full shingle sets are similar enough. texts: rep and its text as packed() has it."""

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            ok, blobs = np.zeros(len(batch), bool), {}
            sides = [[blobs.setdefault(b, len(blobs)) for b in batch.column(c).to_pylist()] for c in ("ta", "tb")]
            sets = _sets(list(blobs), s, hasher)
            for i, (p, q) in enumerate(zip(*sides, strict=True)):
                ok[i] = _linked(sets[p], sets[q], s)
            keep = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)], ["u", "v"])

    text = lambda c: texts.select(F.col("rep").alias(c), F.col("text").alias(f"t{c}"))
    return pairs.join(text("a"), "a").join(text("b"), "b").select("a", "b", "ta", "tb").mapInArrow(lean(run), "u long, v long")


def near_duplicates(docs: DataFrame, s: Settings = NEAR) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id that can be reached by links. Null and empty texts have empty sets and no links;
    equal sets always link. Rows that share a doc_id are one node with several sets; rows that repeat are returned as often.
    Rows with a null doc_id take no part: component_id is null, kept is true. An empty table gives no rows.
    """
    base = staged(sketched(docs, s), "sketches")
    usable = base.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = staged(usable.groupBy("sets").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")), "classes")
    members = staged(usable.select("doc_id", "sets").distinct().join(classes.select("sets", "rep"), "sets").select("doc_id", "rep").distinct(), "members")
    rows = bands(classes, s)
    met = rows.groupBy("bucket").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).filter("x <> y").select("bucket")
    open_ = staged(rows.join(met, "bucket"), "buckets")
    wanted = open_.select(F.col("rep").alias("doc_id")).distinct()
    texts = packed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")))
    texts = staged(texts.join(wanted, "doc_id").select(F.col("doc_id").alias("rep"), "text"), "texts")

    same = members.filter("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    hub = open_.groupBy("bucket").agg(F.min("rep").alias("hub"))
    pairs = open_.join(hub, "bucket").filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    linked = staged(links(staged(survivors(pairs, classes, s), "survivors"), texts, s), "links")
    at = components(linked).withColumnRenamed("node", "rep")
    rest = open_.join(at, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    apart = rest.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("bucket")
    rest = staged(rest.join(apart, "bucket"), "apart")
    across = links_across(rest, classes, texts, s)
    at = components(same.unionByName(linked).unionByName(across)).withColumnRenamed("node", "doc_id").withColumnRenamed("component", "found")
    out = base.select("doc_id", "n_shingles").join(at, "doc_id", "left")
    component = F.coalesce("found", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, s: Settings = NEAR) -> DataFrame:
    """One row of docs, all columns, of each group of near duplicates: the one with the smallest doc_id.

    Rows that share a doc_id, and rows without one, are documents of their own here: they are numbered in the order of their
    ids, those without one last. Null and empty texts are in no group and all stay; an empty table stays empty; columns may
    have any names.
    """
    odd = docs.groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1")
    number, of = fresh(docs, "number"), fresh(docs, "dropped_id")
    if odd.isEmpty():
        numbered = docs.withColumn(number, F.col("doc_id").cast("long"))
    else:
        order = [F.asc_nulls_last("doc_id"), F.xxhash64("text").asc()]
        numbered = docs.repartitionByRange(*order).sortWithinPartitions(*order)
        numbered = staged(numbered.withColumn(number, F.monotonically_increasing_id()), "numbered")
    dropped = near_duplicates(numbered.select(F.col(number).alias("doc_id"), "text"), s).filter("NOT kept").select(F.col("doc_id").alias(of))
    return numbered.join(dropped, F.col(number) == F.col(of), "left_anti").drop(number)
