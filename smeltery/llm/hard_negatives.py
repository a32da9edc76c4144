"""Hard negatives by exact integer inner products, computed in a residue number system.

Component matrices are reduced modulo small primes and multiplied in float32, where every partial sum is a whole number
below 2^24 and so exact; Chinese remaindering gives the signed scores back. Rows and anchors are dealt into cells of bounded
size, each pair of which meets in one task: first for the best rows of each anchor's label, then for the rows of other
labels whose scores lie in the window that each of those sets. Tasks hand on the first few of a cell; windows merge them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRIME_LIMIT = 512  # residues lie in -255 to 255
SLICE = 256  # components multiplied at once: 256 * 255^2 < 2^24
ROWS, ANCHORS = 65_536, 16_384  # of a cell, about
SCORES = 1 << 21  # held at once in a task
LARGEST = 1 << 62  # of a score


def primes_for(bound: int) -> list[int]:
    """The largest primes below PRIME_LIMIT whose product exceeds four times the bound on absolute scores."""
    found, product = [], 1
    for p in range(PRIME_LIMIT - 1, 2, -1):
        if all(p % q for q in range(2, math.isqrt(p) + 1)):
            found.append(p)
            product *= p
            if product > 4 * bound:
                return found
    raise ValueError(f"scores of up to {bound} need more residues")


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p, nearest to zero."""
    r = x % p
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def product_modulo(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """The products of a's rows with b's modulo p, of residues in float32."""
    out = np.zeros((len(a), len(b)), np.int32)
    for at in range(0, a.shape[1], SLICE):
        out += (a[:, at : at + SLICE] @ b[:, at : at + SLICE].T).astype(np.int32)
        out %= p
    return out


def reconstructed(remainders: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The whole numbers with these remainders, nearest to zero, by mixed-radix digits.

    The primes' product exceeds four times any of them, so a rounded copy tells positive from negative; the number
    itself is summed modulo 2^64, in which it fits.
    """
    digits: list[np.ndarray] = []
    for r, p in zip(remainders, primes, strict=True):
        known, radix = np.zeros_like(r), 1
        for digit, q in zip(digits, primes):  # as many primes as there are digits yet
            known = (known + digit * np.int32(radix % p)) % p
            radix *= q
        digits.append((r - known) % p * np.int32(pow(radix, -1, p)) % p)
    exact, rounded, radix = np.zeros(digits[0].shape, np.uint64), np.zeros(digits[0].shape), 1
    for digit, q in zip(digits, primes, strict=True):
        exact += digit.astype(np.uint64) * np.uint64(radix % (1 << 64))
        rounded += digit * float(radix)
        radix *= q
    exact[rounded > radix / 2] -= np.uint64(radix % (1 << 64))
    return exact.view(np.int64)


class Side:
    """Rows of one side of a cell: ids, labels, and their components modulo each prime."""

    def __init__(self, rows: pa.Table, primes: list[int]) -> None:
        rows = rows.sort_by("vec_id").combine_chunks()
        self.rows, self.primes = rows, primes
        self.ids = rows["vec_id"].to_numpy()
        self.labels = rows["label"].to_numpy()
        lists = rows["vector"].combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        values = np.zeros((len(rows), max(int(lengths.max(initial=0)), 1)), np.int64)
        values[np.arange(values.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy()
        self.residues = [residues(values, p) for p in primes]

    def scores(self, which: np.ndarray, other: Side, others: np.ndarray) -> np.ndarray:
        parts = []
        for a, b, p in zip(self.residues, other.residues, self.primes, strict=True):
            width = max(a.shape[1], b.shape[1])
            a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a[which], b[others]))
            parts.append(product_modulo(a, b, p))
        return reconstructed(parts, self.primes)


def first_of(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k greatest allowed scores of each row, smaller columns first among equals; all, if fewer."""
    least = np.iinfo(np.int64).min
    scores = np.where(allowed, scores, least)
    if scores.shape[1] > k:
        bar = np.partition(scores, -k, axis=1)[:, -k, None]
        above, level = scores > bar, (scores == bar) & allowed
        allowed = above | level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True))
    return np.nonzero(allowed)


def tiles(which: np.ndarray, columns: int):
    step = max(1, SCORES // max(columns, 1))
    return (which[at : at + step] for at in range(0, len(which), step))


def _positives(primes: list[int], k: int, schema: pa.Schema):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = [schema.empty_table()]
        if len(rows) and len(anchors):
            rows, anchors = Side(rows, primes), Side(anchors, primes)
            keys = anchors.rows.select(["vec_id", "label", "vector_key"])
            for label in np.intersect1d(rows.labels, anchors.labels):
                mine = np.flatnonzero(rows.labels == label)
                for which in tiles(np.flatnonzero(anchors.labels == label), len(mine)):
                    scores = anchors.scores(which, rows, mine)
                    at, of = first_of(scores, rows.ids[mine] != anchors.ids[which, None], k)
                    found.append(pa.table([*keys.take(which[at]).columns, rows.ids[mine][of], scores[at, of]], schema=schema))
        return pa.concat_tables(found)

    return run


def _negatives(primes: list[int], k: int, low: int, high: int, schema: pa.Schema):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = [schema.empty_table()]
        if len(rows) and len(anchors):
            rows, anchors = Side(rows, primes), Side(anchors, primes)
            keys = anchors.rows.select(["vec_id", "label", "vector_key"])
            positives = anchors.rows["positives"].to_pylist()
            everyone = np.arange(len(rows.ids))
            for which in tiles(np.arange(len(positives)), len(rows.ids)):
                scores = anchors.scores(which, rows, everyone)
                other = rows.labels != anchors.labels[which, None]
                for rank in range(max(len(positives[i]) for i in which)):
                    has = np.flatnonzero([len(positives[i]) > rank for i in which])
                    theirs = [positives[i][rank] for i in which[has]]
                    # The scores s with low * positive <= 100 * s <= high * positive.
                    least = np.array([-(-low * p["score"] // 100) for p in theirs], np.int64)[:, None]
                    most = np.array([high * p["score"] // 100 for p in theirs], np.int64)[:, None]
                    mine = scores[has]
                    at, of = first_of(mine, other[has] & (mine >= least) & (mine <= most), k)
                    of_positive = [np.array([p[name] for p in theirs], np.int64)[at] for name in ("rank", "id", "score")]
                    columns = [*keys.take(which[has][at]).columns, *of_positive, rows.ids[of], mine[at, of]]
                    found.append(pa.table(columns, schema=schema))
        return pa.concat_tables(found)

    return run


def quantised(vectors: DataFrame, column: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, label, vector: each component x as floor(scale * x), x as double. Rows with a null id, label, vector or
    component, or one that is not finite, are left out; repeated rows count once. Other columns are not looked at."""
    x = F.transform(F.col(column), lambda v: v.cast("double"))
    whole = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), x.alias("vector"))
    rows = rows.dropna().filter(whole)
    return rows.withColumn("vector", F.transform("vector", lambda v: F.floor(v * scale))).dropDuplicates()


def _dealt(rows: DataFrame, parts: int, part: str, others: int, other: str) -> DataFrame:
    """rows by content into as many parts, each once for every part of the other side."""
    rows = rows.withColumn(part, F.pmod(F.xxhash64("vec_id", "vector"), F.lit(parts)).cast("int"))
    return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, of rows as quantised() gives them.

    An anchor's positives are its best rows of the same label, but for rows of its own id; for each, the best rows of other labels
    with low * positive_score <= 100 * score <= high * positive_score are its negatives. Scores are inner products, a
    shorter vector being filled with zeros; equal scores go by id. Rows that share an id and differ are rows, and anchors, of
    their own. A positive without negatives gives no row, nor does an empty table.

    Raises ValueError where scores might pass 2^62. Rows meet anchors in cells: rows travel once for every 16,384 anchors,
    anchors once for every 65,536 rows.
    """
    spark = rows.sparkSession
    norm = F.aggregate("vector", F.lit(0.0), lambda sum_, v: sum_ + v.cast("double") * v.cast("double"))
    known = rows.agg(
        F.max(norm).alias("norm"), F.max(F.array_max(F.transform("vector", F.abs))).alias("widest"),
        F.count(F.lit(1)).alias("rows"), F.count_if(is_anchor).alias("anchors"),
    ).first()
    bound = math.ceil((known["norm"] or 0) * (1 + 1e-9)) + 1
    if bound > LARGEST:
        raise ValueError(f"scores of up to {bound:.3g} do not fit")
    primes = primes_for(bound)
    if (known["widest"] or 0) < 1 << 31:
        rows = rows.withColumn("vector", F.col("vector").cast("array<int>"))

    slots = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchor_parts = max(1, math.ceil(known["anchors"] / ANCHORS))
    row_parts = max(1, math.ceil(known["rows"] / ROWS), min(slots, math.ceil(known["rows"] / 256)))
    cell = ["row_part", "anchor_part"]
    dealt = _dealt(rows, row_parts, "row_part", anchor_parts, "anchor_part").groupBy(*cell)
    # Columns of their own, so that the two sides of a cell are told apart.
    own = [F.col(name).alias(name) for name in ("vec_id", "label", "vector")]
    anchors = rows.filter(is_anchor).select(*own, F.xxhash64("vector").alias("vector_key"))
    anchor = ["vec_id", "label", "vector_key"]

    def meet(anchors: DataFrame, run, found: str) -> DataFrame:
        there = _dealt(anchors.select(*(F.col(name).alias(name) for name in anchors.columns)), anchor_parts, "anchor_part", row_parts, "row_part").groupBy(*cell)
        schema = f"vec_id long, label long, vector_key long, {found}"
        return dealt.cogroup(there).applyInArrow(run(to_arrow(schema)), schema)

    def to_arrow(schema: str) -> pa.Schema:
        return pa.schema([(column.split()[0], pa.int64()) for column in schema.split(", ")])

    best = meet(anchors, lambda schema: _positives(primes, positives, schema), "id long, score long")
    order = Window.partitionBy(*anchor).orderBy(F.desc("score"), "id")
    best = best.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= positives)
    best = best.groupBy(*anchor).agg(F.collect_list(F.struct("rank", "id", "score")).alias("positives"))
    anchors = anchors.join(best, anchor)

    hard = meet(
        anchors, lambda schema: _negatives(primes, negatives, low, high, schema),
        "positive_rank long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    order = Window.partitionBy(*anchor, "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return hard.select(F.col("vec_id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
