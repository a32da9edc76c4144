"""Repeated passages by anchored windows, which stand in for prefix-partitioned suffix trees.

Every window of 13 words of every text is placed by its anchor, the run of 6 words in it whose hash is least, wherever in
the window it lies; the windows around one anchor travel together as one run of words. Windows whose anchor occurs in one
document only leave at once. Windows of frequent anchors are placed by all 13 words instead. The two lengths are fixed. In
a task the windows of a group are told apart in three rounds of hashes of 5, 5 and 3 words; windows that are equal to the
last are a repeat, and those of all but its smallest document are covered. That answers which words stand in a repeat of
13 words or more; longer repeats come out as overlapping windows, not as maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.shared import Hasher, chunks, lean, packed, staged, table, text_or_empty, unpacked, words_of

WINDOW = 13
ANCHOR = 6  # words
STEP = 5  # words of a round of hashes, the last one less
FREQUENT = 1000  # occurrences from which windows are placed by all their words, at least
FREQUENT_ANCHORS = 50_000  # at most so many: their occurrences exceed that share of all
HELD = 400_000  # words of groups held at once
LAST_ID = (1 << 63) - 1  # stands for a null doc_id, the largest


def anchors(words: np.ndarray, first: np.ndarray, window: int = WINDOW, size: int = ANCHOR):
    """(hashes, positions, first windows, last windows, texts) of the anchors of texts whose word hashes lie in a row,
    text i from first[i] to first[i + 1]. Each window of a text belongs to one anchor inside it, the leftmost least."""
    n = len(words) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return np.zeros(0, np.uint64), none, none, none, none
    grams = Hasher.runs(words, size)
    best, at = grams[:n].copy(), np.arange(n)
    for j in range(1, window - size + 1):
        there = grams[j : j + n]
        less = there < best
        best[less] = there[less]
        at[less] = np.flatnonzero(less) + j
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = np.flatnonzero(of[:n] == of[window - 1 :])
    if not len(whole):
        return np.zeros(0, np.uint64), none, none, none, none
    at = at[whole]
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([new[1:], [len(whole)]]) - 1
    return grams[at[new]], at[new], whole[new], whole[last], of[whole[new]]


def _anchors_of(hasher: Hasher, data: np.ndarray, at: np.ndarray):
    starts, ends, first = words_of(data, at, table("space"))
    return starts, ends, first, anchors(hasher.words(data, starts, ends), first)


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64) if len(hashes) else np.zeros(0, np.int64))


def frequent_anchors(docs: DataFrame) -> np.ndarray:
    """Hashes of the anchors that often meet in one task's batch: sums over the whole table, at most FREQUENT_ANCHORS."""

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            found = [a[0] for _, data, at in chunks(batch.column("text")) for *_, a in [_anchors_of(hasher, data, at)]]
            h, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([_signed(h[n > 1]), pa.array(n[n > 1].astype(np.int64))], ["h", "n"])

    sums = staged(docs.select("text").mapInArrow(lean(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") > FREQUENT), "frequent")
    least = max(FREQUENT, (sums.agg(F.sum("n")).first()[0] or 0) // FREQUENT_ANCHORS)
    rows = sums.filter(F.col("n") > least).select("h").toArrow()["h"].to_numpy()
    return np.sort(rows.astype(np.int64).view(np.uint64))


def shared_anchors(docs: DataFrame, frequent) -> DataFrame:
    """(doc_id, h): the anchors of each document, as _short() has them, that occur in a document with another id too,
    frequent ones left out."""

    def emit(batches):
        hasher, known = Hasher(), frequent.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, data, at in chunks(batch.column("text")):
                h, _, _, _, of = _anchors_of(hasher, data, at)[3]
                rare = ~np.isin(h, known)
                pairs = np.unique(np.stack([of[rare].astype(np.uint64), h[rare]]), axis=1) if rare.any() else np.zeros((2, 0), np.uint64)
                yield pa.RecordBatch.from_arrays([_signed(np.ascontiguousarray(pairs[1])), pa.array(ids[first + pairs[0].astype(np.int64)].astype(np.int64))], ["h", "doc_id"])

    def shared(h: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
        node, begin = np.cumsum(new) - 1, np.flatnonzero(new)
        keep = np.zeros(0, bool)
        if len(h):
            keep = (np.minimum.reduceat(ids, begin) != np.maximum.reduceat(ids, begin))[node]
        return pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(_short(h[keep].view(np.uint64)).view(np.int32))], ["doc_id", "h"])

    def match(batches):
        for rows in _whole_groups(batches, "h", 1_000_000):
            yield shared(rows["h"].to_numpy(), rows["doc_id"].to_numpy())

    dealt = docs.select("doc_id", "text").mapInArrow(emit, "h long, doc_id long").repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(match, "doc_id long, h int")


def _whole_groups(batches, key: str, limit: int) -> Iterator[pa.Table]:
    """Tables of about limit rows or more from batches sorted by key, no key in two of them."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= limit:
            joined = pa.Table.from_batches(held).combine_chunks()
            keys = joined[key].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            if cut:
                yield joined.slice(0, cut)
            held, rows = joined.slice(cut).to_batches(), len(joined) - cut
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


SUFFIXES = "key long, doc_id long, hash long, start int, words string"


def copies(docs: DataFrame) -> DataFrame:
    """(doc_id, hash) of the documents whose whole text a document with a smaller id has too: they share its leaves."""
    texts = docs.select("doc_id", "hash", F.xxhash64(F.lit(1), "text").alias("other_hash"))
    groups = texts.groupBy("hash", "other_hash").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    return texts.join(groups, ["hash", "other_hash"]).filter(F.col("doc_id") > F.col("first")).select("doc_id", "hash").distinct()


def _short(hashes: np.ndarray) -> np.ndarray:
    """32 bits of hashes: enough to say which anchors of a document to look at."""
    return (hashes >> np.uint64(32)).astype(np.uint32)


def placed_suffixes(blobs: DataFrame, shared: DataFrame, copied: DataFrame, frequent) -> DataFrame:
    """Runs of windows with shared anchors: the key of their group, their document, the number of the first window's
    first word, and the words. Windows of frequent anchors are keyed by all their words, others by the anchor.

    Whole copies send nothing. Of equal runs in one batch only those of the smallest document travel; the others are
    covered, which a row without words says, dealt by its document."""

    def run(batches):
        hasher, known = Hasher(), frequent.value
        for batch in batches:
            ids, hashes = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "hash"))
            wanted, rows, least = batch.column("hs"), [], {}
            looked = [h not in (c or ()) and (len(known) or n) for h, c, n in zip(hashes.tolist(), batch.column("copied").to_pylist(), pc.fill_null(pc.list_value_length(wanted), 0).to_pylist(), strict=True)]
            plain = pa.array([b" ".join(t.split()).decode() if look else "" for t, look in zip(unpacked(batch.column("text")), looked, strict=True)], pa.string())
            for first, data, at in chunks(plain):
                starts, ends, firsts, (h, _, low, high, of) = _anchors_of(hasher, data, at)
                if not len(h):
                    continue
                part = wanted.slice(first, len(at) - 1)
                known_h = pc.list_flatten(part).to_numpy(zero_copy_only=False).astype(np.int32).view(np.uint32)
                known_of = np.repeat(np.arange(len(part)), pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False))
                pair = lambda x, y: x.astype(np.int64) | y.astype(np.int64) << 32
                often = np.isin(h, known)
                keep = np.flatnonzero(often | np.isin(pair(_short(h), of), pair(known_h, known_of)))
                whole = data.tobytes()
                windows = Hasher.runs(hasher.words(data, starts, ends), WINDOW).view(np.int64)
                for i in keep.tolist():
                    d, base = first + int(of[i]), int(firsts[of[i]])
                    spans = [(w, w, int(windows[w])) for w in range(low[i], high[i] + 1)] if often[i] else [(int(low[i]), int(high[i]), int(h[i].astype(np.int64)))]
                    for a, b, key in spans:
                        words = whole[starts[a] : ends[b + WINDOW - 1]]
                        rows.append((key, d, a - base, words, b - a))
                        if least.setdefault(words, ids[d]) > ids[d]:
                            least[words] = ids[d]
            out = []
            for key, d, start, words, more in rows:
                mine = least[words] == ids[d]
                out.append((key if mine else int(hashes[d]), ids[d], hashes[d], start if mine else -1 - start, words.decode() if mine else str(more + WINDOW)))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "doc_id", "hash", "start", "words"])

    by = shared.groupBy("doc_id").agg(F.collect_list("h").alias("hs"))
    whole = copied.groupBy("doc_id").agg(F.collect_list("hash").alias("copied"))
    return blobs.join(by.join(whole, "doc_id", "full"), "doc_id", "left").select("doc_id", "hash", "text", "hs", "copied").mapInArrow(lean(run), SUFFIXES)


def covered_leaves(key: np.ndarray, ids: np.ndarray, words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For subtrees of suffixes, each grown from the root key along the words from first on: which leaves lie under a
    node of depth WINDOW whose smallest document is another. Each step joins a node with its next edge's words and
    leaves out nodes with one leaf."""
    covered, alive = np.zeros(len(key), bool), np.arange(len(key))
    _, node = np.unique(key, return_inverse=True)
    runs: dict[int, np.ndarray] = {}
    for depth in range(0, WINDOW, STEP):
        k = min(STEP, WINDOW - depth)
        if k not in runs:
            runs[k] = Hasher.runs(words, k)
        edge = runs[k][first[alive] + depth]
        order = np.lexsort((edge, node))
        alive, node, edge = alive[order], node[order], edge[order]
        new = np.concatenate([[True], (node[1:] != node[:-1]) | (edge[1:] != edge[:-1])]) if len(node) else np.zeros(0, bool)
        node = np.cumsum(new) - 1
        held = np.bincount(node)[node] > 1 if len(node) else np.zeros(0, bool)
        alive, node = alive[held], node[held]
    if len(alive):
        begin = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        smallest = np.repeat(np.minimum.reduceat(ids[alive], begin), np.diff(np.append(begin, len(node))))
        covered[alive] = ids[alive] > smallest
    return covered


def repeats(suffixes: DataFrame) -> DataFrame:
    """(doc_id, hash, a, b): ranges of words, from a to before b, that the subtrees' deep nodes cover."""

    def grown(rows: pa.Table) -> pa.RecordBatch:
        ids, hashes, start, key = (rows[c].to_numpy() for c in ("doc_id", "hash", "start", "key"))
        local = start < 0
        length = np.array([int(w.as_py()) for w, x in zip(rows["words"], local, strict=True) if x], np.int64)
        out = [np.stack([ids[local], hashes[local], -1 - start[local].astype(np.int64), -1 - start[local] + length])] if local.any() else []
        hasher, texts = Hasher(), rows["words"].combine_chunks() if isinstance(rows["words"], pa.ChunkedArray) else rows["words"]
        texts = texts.filter(pa.array(~local))
        ids, hashes, start, key = ids[~local], hashes[~local], start[~local], key[~local]
        words, firsts, base = [], [], 0
        for _, data, at in chunks(texts):
            s, e, first = words_of(data, at, table("space"))
            words.append(hasher.words(data, s, e))
            firsts.append(first[:-1] + base)
            base += len(s)
        if words:
            words, firsts = np.concatenate(words), np.concatenate(firsts)
            n = np.diff(np.append(firsts, base)) - WINDOW + 1
            of = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            hit = covered_leaves(key[of], ids[of], words, firsts[of] + step)
            begins = hit & np.concatenate([[True], ~hit[:-1] | (of[1:] != of[:-1])])
            stops = hit & np.concatenate([~hit[1:] | (of[1:] != of[:-1]), [True]])
            a, b, of = step[begins], step[stops] + WINDOW, of[begins]
            out.append(np.stack([ids[of], hashes[of], start[of] + a, start[of] + b]))
        out = np.concatenate(out, 1) if out else np.zeros((4, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in out.astype(np.int64)], ["doc_id", "hash", "a", "b"])

    def run(batches):
        for rows in _whole_groups(batches, "key", HELD // 16):
            yield grown(rows)

    return suffixes.repartition("key").sortWithinPartitions("key").mapInArrow(lean(run), "doc_id long, hash long, a long, b long")


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, text (the kept words, joined by single spaces).

    A word goes if a window of 13 words over it also starts in a document with a smaller doc_id. Windows are judged on
    the texts as given. Null texts have no words; texts of fewer than 13 words keep them. A null doc_id counts as larger
    than any; rows with one doc_id never cover each other, and each has its own result. An empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"), text_or_empty().alias("text"))
    texts = texts.withColumn("hash", F.xxhash64("text"))
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_anchors(texts))
    blobs, copied = packed(texts), staged(copies(texts), "copies")
    spans = repeats(placed_suffixes(blobs.drop("id"), shared_anchors(texts, frequent), copied, frequent))
    spans = spans.unionByName(copied.withColumns({"a": F.lit(0).cast("long"), "b": F.lit(LAST_ID)}))
    spans = spans.groupBy("doc_id", "hash").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def cut(batches):
        for batch in batches:
            n, gone, kept = [], [], []
            for text, spans in zip(unpacked(batch.column("text")), batch.column("spans"), strict=True):
                words = text.split()
                n.append(len(words))
                if not spans.is_valid or len(words) < WINDOW:
                    gone.append(0)
                else:
                    change = np.zeros(len(words) + 1, np.int64)
                    a = spans.values.field("a").to_numpy(zero_copy_only=False)
                    b = np.minimum(spans.values.field("b").to_numpy(zero_copy_only=False), len(words))
                    np.add.at(change, a, 1)
                    np.add.at(change, b, -1)
                    held = np.cumsum(change[:-1]) == 0
                    words = [w for w, keep in zip(words, held.tolist(), strict=True) if keep]
                    gone.append(n[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "text"])

    found = blobs.join(spans, ["doc_id", "hash"], "left").select("id", "text", "spans")
    return found.mapInArrow(cut, "doc_id long, n_words long, n_removed long, text string")
