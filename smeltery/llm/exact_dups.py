"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of code points. The distinct blocks are sorted and named by integers; then
adjacent names are paired and the distinct pairs are named, until each document has one name. Two documents have the
same name just if their texts are equal: names stand for compared blocks, never for fingerprints alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm.shared import SPACE, fresh, staged, text_or_empty

BLOCK = 4096


def normalised(text: Column) -> Column:
    return F.translate(text, SPACE, "")


def _keys(block: Column, lanes: int) -> list[Column]:
    """Short keys of a block, by which rows find its name once the names have shown that no two blocks share them."""
    return [F.xxhash64(F.lit(lane), block).alias(f"key{lane}") for lane in range(lanes)]


def _named(parts: DataFrame, order: list[str], name: str) -> DataFrame:
    """Distinct rows, sorted within the tasks that their values are dealt to, with integer names.

    A name is the task's number and the row's rank in it, fixed by the values alone: a repeated task gives the same."""
    return staged(parts.distinct().sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id()).drop("block"), name)


def _block_names(blocks: DataFrame, lanes: int, keys=_keys) -> tuple[DataFrame, int]:
    """(keys, name) of each distinct block. While two blocks share all keys, which the names tell, there is a lane more."""
    while True:
        by = [f"key{lane}" for lane in range(lanes)]
        names = _named(blocks.select(*keys(F.col("block"), lanes), "block"), ["block"], "block-names")
        if names.groupBy(*by).count().filter("count > 1").isEmpty():
            return names, lanes
        lanes += 1


def document_names(docs: DataFrame, block: int = BLOCK, lanes: int = 2, keys=_keys) -> DataFrame:
    """One row per row of docs: doc_id, n_chars (code points), sha256 (of the normalised text), identity.

    identity is equal just for equal normalised texts. Null texts count as empty; all empty texts are equal. Repeated
    rows, and rows that share a doc_id (null too), are named each for itself. Other columns of docs are not read.
    """
    text = text_or_empty()
    row = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.length(text).cast("long").alias("n_chars"), normalised(text).alias("plain"))
    blocks = F.regexp_extract_all("plain", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    row = row.withColumn("blocks", F.when(F.col("plain") == "", F.array(F.lit(""))).otherwise(blocks))
    names, lanes = _block_names(row.select(F.explode("blocks").alias("block")), lanes, keys)
    row = row.withColumn("sha256", F.sha2("plain", 256)).withColumn("n_blocks", F.size("blocks"))
    at = row.select("row", F.struct("doc_id", "n_chars", "sha256", "n_blocks").alias("head"), F.posexplode("blocks").alias("pos", "block"))
    at = at.select("row", "pos", F.col("head.n_blocks").alias("n"), F.when(F.col("pos") == 0, F.col("head")).alias("head"), *keys(F.col("block"), lanes))
    level = staged(at.join(names, [f"key{lane}" for lane in range(lanes)]).select("row", "pos", "n", "head", "name"), "blocks")
    heads = level.filter("pos = 0").select("row", "head.*", "name")
    done = heads.filter("n_blocks = 1").withColumn("identity", F.shiftleft("name", 6))
    longest = heads.agg(F.max("n_blocks")).first()[0] or 1
    level = level.filter("n > 1").select("row", "pos", "n", "name")
    found, depth = None, 0
    while longest > 1:
        depth, longest = depth + 1, (longest + 1) // 2
        side = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
        pairs = level.groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(F.max("n").alias("n"), side(0).alias("left"), F.coalesce(side(1), F.lit(-1)).alias("right"))
        pairs = staged(pairs.withColumn("n", F.floor((F.col("n") + 1) / 2).cast("int")), "pairs")
        names = _named(pairs.select("left", "right"), ["left", "right"], "pair-names")
        level = staged(pairs.join(names, ["left", "right"]).select("row", "pos", "n", "name"), "level")
        ended = level.filter("n = 1").select("row", (F.shiftleft("name", 6) + depth).alias("identity"))
        found = ended if found is None else found.unionByName(ended)
        level = level.filter("n > 1")
    columns = ["doc_id", "n_chars", "sha256", "identity"]
    if found is None:
        return done.select(*columns)
    return done.select(*columns).unionByName(heads.filter("n_blocks > 1").join(found, "row").select(*columns))


def exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts (white space aside) the row with the most code points stays, then the smallest doc_id; a null doc_id
    stays only if it is alone. Rows that repeat a kept doc_id and its text are all marked kept. An empty table gives no
    rows.
    """
    named = staged(document_names(docs, block), "document-names")
    # ~ turns the order of ids round, without overflow.
    best = named.groupBy("identity").agg(F.max(F.struct(F.col("n_chars"), F.bitwise_not("doc_id").alias("id"))).alias("best"), F.count("*").alias("group_size"))
    out = named.join(best, "identity").withColumn("keep_id", F.bitwise_not("best.id"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha256").alias("text_sha256"))


def without_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row of docs, all columns, of each group of equal texts: one that exact_duplicates() marks kept.

    Where several are, as they repeat a doc_id or have none, the one with the most code points stays, of equally long ones any
    one by the hashes of all columns. Null and empty texts are one group; an empty table stays empty; columns may have any names.
    """
    of, found, digest = (fresh(docs, name) for name in ("dropped_id", "dropped_text", "digest"))
    marked = exact_duplicates(docs, block)
    dropped = marked.filter("NOT kept").select(F.col("doc_id").alias(of), F.col("text_sha256").alias(found)).distinct()
    own = F.sha2(normalised(text_or_empty()), 256)
    kept = docs.join(dropped, F.col("doc_id").eqNullSafe(F.col(of)) & (own == F.col(found)), "left_anti")
    repeated = marked.filter("kept").groupBy("text_sha256").count().filter("count > 1").select(F.col("text_sha256").alias(found))
    if repeated.isEmpty():
        return kept
    kept = kept.withColumn(digest, own)
    order = F.struct(F.length(text_or_empty()).alias("n"), F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)).alias("tie"))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    once = kept.join(repeated, F.col(digest) == F.col(found), "left_semi").groupBy(digest).agg(F.max_by(whole, order).alias("row"))
    return kept.join(repeated, F.col(digest) == F.col(found), "left_anti").drop(digest).unionByName(once.select("row.*"))
