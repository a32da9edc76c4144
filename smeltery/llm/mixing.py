"""Mixing sources to target weights.

Each source's texts, one after another in an order drawn from their ids, are packed into blocks of a fixed number of
words. For each output shard a multinomial draw says how many of its slots each source fills. Slot j of a source takes
the block to which a pseudorandom permutation of the source's block numbers maps j, so that blocks are taken evenly;
slots and blocks meet in a join on the block number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.llm.shared import WORD, mixed, staged, text_or_empty

BLOCK = 64  # words
BUCKETS = 4096  # of a source's texts, for running totals that no task makes alone
SHARDS = 4096  # at most
SHARD_SLOTS = 4096  # at least, but for the last shard
SOURCES = 100_000  # the driver lists at most so many
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2  # of all words; of a source's own words
RUN = 8192  # slots in a row of the drawn plan
TASK_SLOTS = 500_000  # slots that a task permutes, about


@dataclass
class Mix:
    """sizes: a row per document (doc_id, source, size, start, rank); sources: a row per source (rank, source_size,
    target, blocks, slots); pieces: a row per document and block (rank, block, doc_id, row, first_word, words);
    slots: a row per slot of the mix (shard, slot, rank, block)."""

    sizes: DataFrame
    sources: DataFrame
    pieces: DataFrame
    slots: DataFrame

    def rows(self) -> DataFrame:
        """The mix: for each slot, the pieces of documents that fill it (shard, slot, rank, block, row, doc_id,
        first_word, words), joined by block number. Both sides are made from smaller tables and are larger than Spark
        takes them for, so that it must not broadcast either."""
        return self.slots.hint("merge").join(self.pieces, ["rank", "block"])

    def texts(self, docs: DataFrame) -> DataFrame:
        """rows() with the words themselves, joined by single spaces."""
        words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.col("first_word").cast("int") + 1, F.col("words").cast("int"))
        texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), "text").distinct()
        named = self.rows().join(self.sizes.select("row", "hash"), "row")
        found = named.join(texts, F.col("doc_id").eqNullSafe(F.col("id")) & (named["hash"] == texts["hash"]))
        return found.select("shard", "slot", "rank", "block", "doc_id", "first_word", F.array_join(words, " ").alias("text"))


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Words wanted of each source: by weight, never above most times its size; what is above goes to the others."""
    each, out = [weights[i % len(weights)] for i in range(len(sizes))], [0.0] * len(sizes)
    left, free = share * sum(sizes), [i for i, n in enumerate(sizes) if n]
    while free:
        unit = left / sum(each[i] for i in free)
        full = [i for i in free if unit * each[i] >= most * sizes[i]]
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
        if not full:
            for i in free:
                out[i] = unit * each[i]
            break
        free = [i for i in free if i not in set(full)]
    return out


def drawn(slots: list[int], seed: int, shards: int = SHARDS, least: int = SHARD_SLOTS) -> list[tuple[int, int, int, int]]:
    """(shard, source, first slot of the source, slots) of each shard. Each shard draws its sources' counts from a
    multinomial over what is left of each source's slots; a count beyond that is drawn again."""
    left, out = np.array(slots, np.int64), []
    per = max(least, -(-int(left.sum()) // shards))
    taken, shard = np.zeros(len(left), np.int64), 0
    while left.sum():
        rng, counts, want = np.random.default_rng([seed, shard]), np.zeros(len(left), np.int64), int(min(per, left.sum()))
        while want > counts.sum():
            rest = left - counts
            counts = np.minimum(counts + rng.multinomial(want - counts.sum(), rest / rest.sum()), left)
        out += [(shard, int(i), int(taken[i]), int(counts[i])) for i in np.flatnonzero(counts)]
        left, taken, shard = left - counts, taken + counts, shard + 1
    return out


def permuted(j: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Images of j under pseudorandom permutations of 0 to n - 1, one for each key: a Feistel network on the smallest
    even number of bits that holds n, walked on until it is inside."""
    half = (np.ceil(np.log2(np.maximum(n, 2)) / 2)).astype(np.uint64)
    mask, x = (np.uint64(1) << half) - np.uint64(1), j.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        h, m = half[todo], mask[todo]
        left, right = x[todo] >> h, x[todo] & m
        for turn in range(4):
            left, right = right, left ^ (mixed(right + mixed(key[todo] + np.uint64(turn))) & m)
        x[todo] = left << h | right
        todo = todo[x[todo] >= n[todo].astype(np.uint64)]
    return x.astype(np.int64)


def _blocks(seed: int) -> Column:
    @F.pandas_udf("long")
    def block(rank: pd.Series, j: pd.Series, blocks: pd.Series) -> pd.Series:
        n, j = blocks.to_numpy(np.int64), j.to_numpy(np.int64)
        key = mixed(mixed(rank.to_numpy(np.uint64) + np.uint64(seed)) + (j // n).astype(np.uint64))
        return pd.Series(permuted(j % n, n, key))

    return block(F.col("rank").cast("long"), "j", "blocks")


def sized(docs: DataFrame) -> DataFrame:
    """A row per document with its number of words, and the hash that orders rows of one doc_id."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("source").cast("string"),
        F.size(F.regexp_extract_all(text_or_empty(), F.lit(WORD), F.lit(0))).cast("long").alias("size"), F.xxhash64("text").alias("hash"),
    )


def mix(docs: DataFrame, seed: int = 17, block: int = BLOCK, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> Mix:
    """The plan of the mix, over all rows of docs.

    Sources rank by code point, null as a source of its own, last. Null and empty texts have no words and fill no slot;
    a source without words gets no target. Rows that share a doc_id, and repeated rows, are texts of their own. The
    same rows give the same mix, however they are dealt to tasks. An empty table gives an empty mix.
    A source gives whole blocks, so it may miss its target by half a block; each block is taken at most `most` times.
    """
    spark, sizes = docs.sparkSession, staged(sized(docs), "sizes")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("n")).limit(SOURCES + 1).collect()
    if len(totals) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources")
    totals = sorted(((r["source"], r["n"]) for r in totals), key=lambda s: (s[0] is None, s[0] or ""))
    wanted = targets([n for _, n in totals], weights, share, most)
    rows, slots = [], []
    for rank, ((name, n), target) in enumerate(zip(totals, wanted, strict=True)):
        blocks = -(-n // block)
        slots.append(min(most * blocks, round(target / n * blocks)) if n else 0)
        rows.append((rank, name, n, target, blocks))
    sources = spark.createDataFrame(rows, "rank int, source string, source_size long, target double, blocks long")
    plan = [(s, r, first + at, min(RUN, n - at), rows[r][4]) for s, r, first, n in drawn(slots, seed) for at in range(0, n, RUN)]
    plan = spark.createDataFrame(plan, "shard int, rank int, first long, n int, blocks long")
    tasks = 1 + sum(slots) // TASK_SLOTS
    runs = plan.repartition(tasks, "shard", "rank", "first").withColumn("j", F.explode(F.expr("sequence(first, first + n - 1)")))
    slots_ = runs.select("shard", F.col("j").alias("slot"), "rank", _blocks(seed).alias("block"))

    ranked = sizes.join(F.broadcast(sources.select("rank", F.col("source").alias("named"))), F.col("source").eqNullSafe(F.col("named"))).drop("named")
    ranked = ranked.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(BUCKETS)))
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranked.groupBy("rank", "bucket").agg(F.sum("size").alias("n")).select("rank", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("rank", "bucket").orderBy("doc_id", "hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranked.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["rank", "bucket"])
    placed = placed.withColumn("start", F.col("start") + F.col("offset"))
    end = F.col("start") + F.col("size")
    over = placed.filter("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))))
    low, high = F.greatest("start", F.col("block") * block), F.least(end, (F.col("block") + 1) * block)
    pieces = over.select("rank", "block", "doc_id", "row", (low - F.col("start")).alias("first_word"), (high - low).alias("words"))
    return Mix(ranked.drop("bucket"), sources, pieces, slots_)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, taken (its words in the mix, repeats counted)."""
    plan = mix(docs)
    taken = plan.rows().groupBy("row").agg(F.sum("words").alias("taken"))
    out = plan.sizes.join(F.broadcast(plan.sources.select("rank", "source_size", "target")), "rank").join(taken, "row", "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
