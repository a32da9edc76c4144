"""Document fingerprints of improbable byte windows, in chains of Bloom filters.

Every window of a text has an entropy; how rare its entropy is among all windows of the corpus ranks it. A window is a feature
if it is the rarest of enough of the runs of neighbouring windows that it lies in. Features go, in the order of the text, into
a chain of Bloom filters of equal size. Two fingerprints are alike as far as the filters of the shorter chain share more
bits with their best partners than chance gives, of the most that they could share.

Short texts, in which few windows could win, and texts in which none does, as of one letter, have all their distinct smaller
windows as features, still shorter ones themselves. Null counts as empty; an empty text has an empty fingerprint, which is like no other but itself. Fingerprints compare only under the same ranks.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smeltery.llm.shared import chunks, lean, mixed, packed, slices, staged, unpacked

WIDTH = 16  # bytes of a window
RUN = 32  # windows that compete
POPULAR = 8  # runs that a feature must win
FEW, SHORT = 128, 6  # code points up to which every window of a text is a feature, and bytes of such a window
LEVELS = 1000  # of entropy
BITS, PER_FILTER, PROBES = 2048, 160, 5  # of a filter
CHANCE = 0.3  # share of the way from chance to the most possible that counts as chance
PIECE = 1 << 18  # window positions worked on at once
TEXT_BYTES = 1 << 20  # of texts worked on at once, or one longer text


def _steps(width: int) -> np.ndarray:
    """c * log2(c) of counts, in whole numbers, so that sums of any order agree."""
    c = np.arange(width + 2, dtype=np.float64)
    return np.rint(c * np.log2(np.maximum(c, 1)) * (1 << 16)).astype(np.int64)


def entropy_levels(data: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """0 to LEVELS for each window of `width` bytes: its entropy as a share of the most that so many bytes can have.

    From one window to the next one byte leaves and one comes, and the sum of c * log2(c) over byte counts c changes by what
    these two counts change it. Their counts come from comparing the data with itself at each distance.
    """
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    ahead = np.ones(len(data), np.uint8)  # bytes equal to this one among it and the width - 1 after it
    behind = np.ones(len(data), np.uint8)  # and before it
    for k in range(1, width):
        same = (data[:-k] == data[k:]).view(np.uint8)
        ahead[:-k] += same
        behind[k:] += same
    f = _steps(width)
    sums = np.empty(n, np.int64)
    sums[0] = f[np.bincount(data[:width], minlength=256)].sum()
    leaves, comes = ahead[: n - 1].astype(np.int64), behind[width:].astype(np.int64)
    np.cumsum((f[comes] - f[comes - 1]) - (f[leaves] - f[leaves - 1]), out=sums[1:])
    sums[1:] += sums[0]
    return (f[width] - sums) * LEVELS // f[width]


def whole_windows(start: int, n: int, length: int, at: np.ndarray) -> np.ndarray:
    """Which of the n positions from start on have `length` bytes within one text; at has the texts' limits."""
    here = np.arange(start, start + n)
    return here + length <= at[np.minimum(np.searchsorted(at, here, "right"), len(at) - 1)]


def histogram(data: np.ndarray, at: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Windows of whole texts by entropy level."""
    out = np.zeros(LEVELS + 1, np.int64)
    for start in range(0, len(data), PIECE):
        levels = entropy_levels(data[start : start + PIECE + width - 1], width)
        out += np.bincount(levels[whole_windows(start, len(levels), width, at)], minlength=LEVELS + 1)
    return out


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """0 for the rarest entropy level; levels never seen come last, equal counts by level."""
    order = np.lexsort((np.arange(len(counts)), np.where(counts == 0, np.iinfo(np.int64).max, counts)))
    ranks = np.empty(len(counts), np.int64)
    ranks[order] = np.arange(len(counts))
    return ranks


def _least_of_runs(keys: np.ndarray, run: int) -> np.ndarray:
    """The least of each run of keys, by doubling."""
    have = 1
    while have < run:
        step = min(have, run - have)
        keys = np.minimum(keys[:-step], keys[step:])
        have += step
    return keys


def features(data: np.ndarray, at: np.ndarray, ranks: np.ndarray, width: int = WIDTH, run: int = RUN, popular: int = POPULAR) -> np.ndarray:
    """Ascending positions of the features of texts that lie one after another; at has the texts' limits."""
    found, wins = [], []
    for start in range(0, len(data), PIECE):
        part = data[start : start + PIECE + width + run - 2]
        levels = entropy_levels(part, width)
        if len(levels) < run:
            continue
        keys = ranks[levels] << 40 | np.arange(start, start + len(levels))
        least = _least_of_runs(keys, run)
        least = least[whole_windows(start, len(least), width + run - 1, at)] & ((1 << 40) - 1)
        # Winners of later runs never lie before those of earlier ones: equal ones stand together.
        first = np.flatnonzero(np.diff(least, prepend=-1))
        found.append(least[first])
        wins.append(np.diff(np.append(first, len(least))))
    if not found:
        return np.zeros(0, np.int64)
    found, wins = np.concatenate(found), np.concatenate(wins)
    first = np.flatnonzero(np.diff(found, prepend=-1))
    return found[first][np.add.reduceat(wins, first) >= popular] if len(found) else found


def feature_hashes(data: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of the windows at these places."""
    out = np.full(len(places), width, np.uint64)
    for at in range(0, width, 8):
        word = np.zeros(len(places), np.uint64)
        for j in range(at, min(at + 8, width)):
            word = word << np.uint64(8) | data[places + j].astype(np.uint64)
        out = mixed(out ^ word) + np.uint64(at)
    return out


class Chain:
    """A fingerprint: Bloom filters of BITS bits, PER_FILTER features each, but for the last."""

    def __init__(self, counts: np.ndarray, filters: np.ndarray) -> None:
        self.counts, self.filters = counts, filters

    def text(self) -> str:
        """How many features the filters have, and their bits, in base 64."""
        if not len(self.counts):
            return ""
        return base64.b64encode(int(self.counts.sum()).to_bytes(8, "little") + self.filters.tobytes()).decode()

    @classmethod
    def of(cls, text: str) -> Chain:
        raw = base64.b64decode(text)
        n = int.from_bytes(raw[:8], "little")
        counts = np.full(-(-n // PER_FILTER), PER_FILTER, np.int64)
        counts[len(counts) - 1 :] = n - PER_FILTER * (len(counts) - 1)
        return cls(counts, np.frombuffer(raw[8:], np.uint8).reshape(len(counts), BITS // 8))


def _matched(a: Chain, b: Chain, block: int = 512) -> float:
    """How well a's filters are found among b's, by their features."""
    total, size_b = 0.0, np.bitwise_count(b.filters).sum(axis=1, dtype=np.int64).astype(np.float32)
    for at in range(0, len(a.filters), block):
        mine = np.unpackbits(a.filters[at : at + block], axis=1).astype(np.float32)
        size_a, best = mine.sum(axis=1, keepdims=True), np.zeros(len(mine), np.float32)
        for to in range(0, len(b.filters), block):
            shared, sizes = mine @ np.unpackbits(b.filters[to : to + block], axis=1).astype(np.float32).T, size_b[None, to : to + block]
            most, chance = np.minimum(size_a, sizes), size_a * sizes / BITS
            least = chance + CHANCE * (most - chance)
            best = np.maximum(best, ((shared - least) / np.maximum(most - least, 1e-6)).max(axis=1))
        total += float((best.clip(0, 1) * a.counts[at : at + block]).sum())
    return min(total / float(a.counts.sum()), 1.0)


def likeness(a: Chain, b: Chain) -> float:
    """0 to 1, the same either way round; 1 for equal fingerprints."""
    if not len(a.counts) or not len(b.counts):
        return float(len(a.counts) == len(b.counts))
    n, m = a.counts.sum(), b.counts.sum()
    if n == m:
        return max(_matched(a, b), _matched(b, a))
    return _matched(a, b) if n < m else _matched(b, a)


def chains(texts: list[bytes], ranks: np.ndarray) -> list[Chain]:
    """Fingerprints of UTF-8 texts under the ranks of entropy levels."""
    sizes = np.array([len(t) for t in texts], np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    points = np.diff(np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at])
    places = features(data, at, ranks)
    of = np.searchsorted(at, places, "right") - 1
    few = (points <= FEW) | (np.bincount(of, minlength=len(texts)) == 0)
    places, of = places[~few[of]], of[~few[of]]
    hashes = feature_hashes(data, places, WIDTH)
    for i in np.flatnonzero(few & (sizes > 0)):
        width = min(SHORT, int(sizes[i]))
        short = feature_hashes(data, np.arange(at[i], at[i + 1] - width + 1), width)
        short = short[np.sort(np.unique(short, return_index=True)[1])]
        hashes, of = np.append(hashes, short), np.append(of, np.full(len(short), i))
    order = np.argsort(of, kind="stable")
    hashes, of = hashes[order], of[order]
    first = np.searchsorted(of, np.arange(len(texts) + 1))
    counts = np.diff(first)
    filters = np.concatenate([[0], np.cumsum(-(-counts // PER_FILTER))])
    mine = filters[of] + (np.arange(len(of)) - first[of]) // PER_FILTER
    bits = np.zeros((filters[-1], BITS), bool)
    for k in range(PROBES):
        bits[mine, (hashes >> np.uint64(11 * k)) & np.uint64(BITS - 1)] = True
    bits, held = np.packbits(bits, axis=1), np.bincount(mine, minlength=filters[-1])
    return [Chain(held[a:b], bits[a:b]) for a, b in zip(filters[:-1], filters[1:], strict=True)]


def rarity(docs: DataFrame, column: str = "text") -> np.ndarray:
    """Ranks of the entropy levels, 0 for the rarest among all windows of all texts."""

    def run(batches):
        for batch in batches:
            counts = sum((histogram(data, at) for _, data, at in chunks(batch.column(0), TEXT_BYTES)), np.zeros(LEVELS + 1, np.int64))
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["level", "n"])

    texts = docs.select(F.col(column).cast("string").alias("text"))
    levels = texts.mapInArrow(lean(run), "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(LEVELS + 1, np.int64)
    counts[levels["level"].to_numpy()] = levels["n"].to_numpy()
    return ranks_of(counts)


def fingerprinted(docs: DataFrame, ranks: np.ndarray, column: str = "text", name: str = "fingerprint") -> DataFrame:
    """docs with the fingerprint of a column's texts; a column of that name is replaced."""
    docs = docs.drop(name)

    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                texts = batch.column(column).to_pylist()
                found = [c.text() for c in chains([(t or "").encode() for t in texts], ranks)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, name])

    return docs.mapInArrow(lean(run), docs.withColumn(name, F.lit("")).schema)


def edited(text: str, following: str) -> str:
    """text with its last quarter replaced by as much of the start of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _compared(ids: list, texts: list[str], mine: list[Chain], following: list[Chain], following_texts: list[str], ranks: np.ndarray) -> list[pa.Array]:
    changed = [edited(t, u).encode() for t, u in zip(texts, following_texts, strict=True)]
    theirs = chains(changed, ranks)
    columns = [
        ids, [len(t) for t in texts], [hashlib.sha256(t).hexdigest() for t in changed], [c.text() for c in mine], [c.text() for c in theirs],
        [likeness(a, b) for a, b in zip(mine, theirs, strict=True)], [likeness(a, b) for a, b in zip(mine, following, strict=True)],
    ]
    return [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)]


def _held(batches, bytes_: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of rows with zstd texts, about so many bytes at once."""
    for whole in batches:
        for batch in slices(whole, 100):
            ids, texts, size = [], [], 0
            for i, blob in zip(batch.column("doc_id").to_pylist(), (batch.slice(k, 1).column("text") for k in range(len(batch))), strict=True):
                text = unpacked(blob)[0].decode()
                ids.append(i)
                texts.append(text)
                size += len(text)
                if size >= bytes_:
                    yield ids, texts
                    ids, texts, size = [], [], 0
            if ids:
                yield ids, texts


# Rows that a task hands on: results, and its first and last document, whose neighbours other tasks have.
DONE, FIRST, LAST = 0, 1, 2


def _in_order(ranks: np.ndarray) -> Callable:
    """Compares each of a task's documents, in their order, with the next; two are held at a time."""

    def ends(kind: int, doc: int | None, text: str, chain: Chain) -> pa.RecordBatch:
        row = [[kind], [TaskContext.get().partitionId()], [text], [doc], [None], [None], [chain.text()], [None], [None], [None]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, [pa.int32(), pa.int32(), pa.string(), *_TYPES], strict=True)], names)

    names = ["kind", "part", "text", *(c.split()[0] for c in _RESULT.split(", "))]

    def run(batches):
        last = None
        for ids, texts in _held(batches, TEXT_BYTES):
            mine = chains([t.encode() for t in texts], ranks)
            if last is None:
                yield ends(FIRST, ids[0], texts[0], mine[0])
            else:
                ids, texts, mine = [last[0], *ids], [last[1], *texts], [last[2], *mine]
            n = len(ids) - 1
            if n:
                found = _compared(ids[:-1], texts[:-1], mine[:-1], mine[1:], texts[1:], ranks)
                none = [pa.array(np.full(n, DONE, np.int32)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())]
                yield pa.RecordBatch.from_arrays([*none, *found], names)
            last = ids[-1], texts[-1], mine[-1]
        if last is not None:
            yield ends(LAST, *last)

    return lean(run)


def _across(ranks: np.ndarray) -> Callable:
    """Compares the last documents of tasks with the first ones of the next tasks."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 1):
                row = batch.to_pylist()[0]
                chains_ = [Chain.of(row["fingerprint"])], [Chain.of(row["next_fingerprint"])]
                found = _compared([row["doc_id"]], [row["text"]], *chains_, [row["next_text"]], ranks)
                yield pa.RecordBatch.from_arrays(found, [c.split()[0] for c in _RESULT.split(", ")])

    return lean(run)


def compared_with_next(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """Each document's fingerprint, that of its text with the last quarter replaced by the start of the next document,
    and how like it is to that and to the next document's.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The next document is that with
    the next id, rows of one id following each other by text, null ids last; the last one's is the first. A lone document is its own
    next; an empty table gives no rows; other columns are not looked at.

    Texts are dealt out by ranges of ids, once, and read in order. Only the first and the last of each task's documents
    meet their neighbours of other tasks in a join, by the number of the task.
    """
    texts = packed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))).withColumn("tie", F.xxhash64("text"))
    order = [F.asc_nulls_last("doc_id"), F.asc("tie")]
    placed = texts.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    found = staged(placed.mapInArrow(_in_order(ranks), f"kind int, part int, text string, {_RESULT}"), "fingerprints")

    firsts = found.filter(F.col("kind") == FIRST).select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    # One row a task: the next one that had documents.
    tasks = Window.orderBy("part")
    after = firsts.select("part", F.lead("part").over(tasks).alias("next"), F.first("part").over(tasks).alias("start"))
    after = after.select(F.col("part").alias("from"), F.coalesce("next", "start").alias("to"))
    lasts = found.filter(F.col("kind") == LAST).select("part", "doc_id", "text", "fingerprint")
    pairs = lasts.join(after, F.col("part") == F.col("from")).drop("part").join(firsts, F.col("part") == F.col("to"))
    across = pairs.select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint").mapInArrow(_across(ranks), _RESULT)
    columns = [c.split()[0] for c in _RESULT.split(", ")]
    return found.filter(F.col("kind") == DONE).select(*columns).unionAll(across)
