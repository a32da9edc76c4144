"""Phrase collocations from count streams in prefix and in suffix order.

Counting goes by length, as a phrase is frequent only if the shorter ones inside it are: words first, then pairs of words
that may be frequent, then longer phrases whose pairs all may be. What may be frequent is told by a table of bits, of bounded
size, which never says no to a frequent phrase; a fuller table only lets more phrases be counted. Counts are of the
phrases themselves, never of hashes.

The counts of all lengths form one stream. Sorted with each phrase's cuts by first part and then by rest, it is walked in
lockstep with itself (sort-merge joins), which gives the left and the right count of each cut; the longest first parts and
rests give each phrase the counts of its extensions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smeltery.llm.shared import Hasher, chunks, lean, lowered, mixed, slices, staged, words_of

# What ends a piece, [.,;:!?\x0A-\x0D], and the blanks between its words, [\x20\x09].
STOPS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"

TEXT_BYTES = 1 << 22  # counted at once, or one longer text
MOST_BITS = 1 << 27  # of a table of what may be frequent: 16 MB
BITS_EACH = 16  # wanted for each frequent phrase
SALTS = 32  # parts of a language ranked on their own first


def _members(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


class Words:
    """The words of texts one after another: their codes, the texts behind these, and which go on the piece before them."""

    def __init__(self, data: np.ndarray, at: np.ndarray) -> None:
        stop = _members(STOPS)
        inside = ~(stop | _members(BLANKS))
        data = lowered()[data]
        starts, ends, first = words_of(data, at, inside)
        sizes = np.concatenate([[0], np.cumsum(ends - starts)])
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(sizes), pa.py_buffer(data[inside[data]])).dictionary_encode()
        self.codes, self.texts = words.indices.to_numpy().astype(np.int64), words.dictionary
        stops = np.concatenate([[0], np.cumsum(stop[data])])
        self.goes_on = np.zeros(len(starts), bool)
        self.goes_on[1:] = stops[starts[1:]] == stops[ends[:-1]]
        self.goes_on[first[first < len(starts)]] = False

    def hashes(self, lang: str) -> np.ndarray:
        """Of each word, by its text and language."""
        _, at, data = self.texts.buffers()
        at = np.frombuffer(at, np.int64)[: len(self.texts) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        name = np.frombuffer(lang.encode() + b"|", np.uint8)
        salt = Hasher().words(name, np.array([0]), np.array([len(name)]))
        return mixed(Hasher().words(data, at[:-1], at[1:]) ^ salt)[self.codes]


def _by_language(batch: pa.RecordBatch, column: str) -> Iterator[tuple[str, Words]]:
    for lang in pc.unique(batch["lang"]).to_pylist():
        texts = batch.filter(pc.equal(batch["lang"], lang))[column]
        for _, data, at in chunks(texts, TEXT_BYTES):
            yield lang, Words(data, at)


class Bits:
    """Which phrases of `order` words may be frequent: two bits a phrase in a table whose size is a power of two."""

    def __init__(self, cells: np.ndarray, order: int) -> None:
        self.cells, self.order = cells, order

    @staticmethod
    def places(hashes: np.ndarray, order: int, size: int) -> np.ndarray:
        """Two bits of each run of `order` words."""
        runs = Hasher.runs(hashes, order)
        return np.stack([runs, runs >> np.uint64(32)]) & np.uint64(size - 1)

    def may_be(self, hashes: np.ndarray) -> np.ndarray:
        """For each run of `order` words, whether it may be frequent."""
        at = self.places(hashes, self.order, 64 * len(self.cells))
        return ((self.cells[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def _phrases(words: Words, order: int, wanted: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct phrases of `order` words that start at wanted places, and how often they do."""
    key, v = words.codes[wanted], max(len(words.texts), 1)
    for j in range(1, order):
        # Renumbered before a product could pass 64 bits: both factors are below 2^31.
        key = pd.factorize(key)[0].astype(np.int64) * v + words.codes[wanted + j]
    number, distinct = pd.factorize(key)
    place = np.zeros(len(distinct), np.int64)
    place[number] = wanted
    texts = [words.texts.take(pa.array(words.codes[place + j])) for j in range(order)]
    return pc.binary_join_element_wise(*texts, pa.scalar(" ", pa.large_string())), np.bincount(number, minlength=len(distinct))


def _counter(orders: Sequence[int], bits):
    """Counts of phrases of these lengths within each run of texts; with length 1 also of all words, as length 0."""

    def run(batches):
        known = Bits(*bits.value) if bits is not None else None
        for whole in batches:
            for batch in slices(whole):
                for lang, words in _by_language(batch, "text"):
                    n = len(words.codes)
                    found = [(0, pa.array([""], pa.large_string()), np.array([n]))] if 1 in orders else []
                    may = known.may_be(words.hashes(lang)) if known is not None else None
                    for order in orders:
                        starts = np.ones(max(n - order + 1, 0), bool)
                        for j in range(1, order):
                            starts &= words.goes_on[j : j + len(starts)]
                        if may is not None:
                            for j in range(order - known.order + 1):
                                starts &= may[j : j + len(starts)]
                        found.append((order, *_phrases(words, order, np.flatnonzero(starts))))
                    for order, phrases, counts in found:
                        here = len(phrases)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * here, pa.string()), phrases.cast(pa.string()), pa.array(np.full(here, order, np.int32)), pa.array(counts, pa.int64())],
                            ["lang", "phrase", "order", "f"],
                        )

    return lean(run)


def _counted(docs: DataFrame, orders: Sequence[int], least: int, bits, name: str) -> DataFrame:
    seen = docs.mapInArrow(_counter(orders, bits), "lang string, phrase string, order int, f long")
    counts = seen.groupBy("lang", "phrase", "order").agg(F.sum("f").alias("f"))
    return staged(counts.filter((F.col("f") >= least) | (F.col("order") == 0)), name)


def _bits(counts: DataFrame, order: int):
    """The table of bits of the counted phrases of one length, as a broadcast of at most MOST_BITS.

    What is broadcast are the arguments of Bits: a broadcast's values are pickled by the names of their classes, which
    executors without this library do not know."""
    phrases = counts.filter(F.col("order") == order).select("lang", "phrase")
    size = min(1 << max(BITS_EACH * phrases.count() - 1, 1 << 9).bit_length(), MOST_BITS)

    def run(batches):
        for batch in batches:
            for lang, words in _by_language(batch, "phrase"):
                starts = np.flatnonzero(np.logical_and.reduce([words.goes_on[j : len(words.codes) - order + 1 + j] for j in range(1, order)] or [words.codes >= 0]))
                at = np.unique(Bits.places(words.hashes(lang), order, size)[:, starts])
                yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["cell", "bit"])

    cells = np.zeros(size // 64, np.int64)
    set_ = phrases.mapInArrow(lean(run), "cell long, bit long").groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    cells[set_["cell"].to_numpy()] = set_["bits"].to_numpy()
    return counts.sparkSession.sparkContext.broadcast((cells.view(np.uint64), order))


def phrase_counts(docs: DataFrame, longest: int = 4, least: int = 30) -> DataFrame:
    """lang, phrase (words joined by one space), order (its words) and f, of phrases of up to `longest` words that occur
    `least` times or more in a language; order 0 has the number of all its words. See collocations()."""
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string"))
    levels = [_counted(docs, [1], least, None, "collocations-words")]
    if longest > 1:
        levels.append(_counted(docs, [2], least, _bits(levels[0], 1), "collocations-pairs"))
    if longest > 2:
        levels.append(_counted(docs, range(3, longest + 1), least, _bits(levels[1], 2), "collocations-phrases"))
    return reduce(DataFrame.unionAll, levels)


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, order, a, its lowest-scoring cut (k, l, r, score) and `longer`, the most of any phrase with one word
    more on either side, of the counts of phrase_counts()."""
    phrases = counts.filter("order >= 2").withColumnRenamed("f", "a").withColumn("k", F.explode(F.expr("sequence(1, order - 1)")))
    cuts = phrases.withColumns({
        "head": F.expr("substring_index(phrase, ' ', k)"),
        "rest": F.expr("substring_index(phrase, ' ', k - order)"),
    })
    parts = counts.filter("order >= 1")
    heads = parts.select(F.col("lang").alias("head_lang"), F.col("phrase").alias("head_phrase"), F.col("f").alias("l"))
    rests = parts.select(F.col("lang").alias("rest_lang"), F.col("phrase").alias("rest_phrase"), F.col("f").alias("r"))
    joined = cuts.join(heads.hint("merge"), F.expr("head_lang = lang AND head_phrase = head"))
    joined = joined.join(rests.hint("merge"), F.expr("rest_lang = lang AND rest_phrase = rest"))
    score = F.expr("CAST((2000000BD * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0))) AS BIGINT)")
    best = joined.groupBy("lang", "phrase", "order", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = cuts.filter("order >= 3")
    longer = inner.filter("k = order - 1").select("lang", F.col("head").alias("phrase"), "a")
    longer = longer.unionAll(inner.filter("k = 1").select("lang", F.col("rest").alias("phrase"), "a"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    return best.join(longer.hint("merge"), ["lang", "phrase"], "left").select("lang", "phrase", "order", "a", "cut.*", "longer")


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, percent: int = 80, first: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first collocations of 2 to `longest` words.

    A-Z become lower case, texts are cut into pieces at [.,;:!?] and line ends, pieces into words at blanks. Null text
    holds nothing, null lang counts as `und`; repeated rows count each time; other columns are not looked at; an empty
    table gives no rows. A phrase counts with f >= least; its score is floor(2000000 a / (l + r)) at its lowest-scoring
    cut. Phrases inside a longer candidate with at least `percent` of their count are left out: if any
    longer one has that many, then so has one that is longer by a word. Equal scores go by count, then by the phrase's bytes.
    """
    counts = phrase_counts(docs, longest, least)
    words = counts.filter("order = 0").select("lang", F.col("f").alias("n"))
    covered = F.expr(f"100BD * CAST(longer AS DECIMAL(19,0)) >= {percent}BD * CAST(a AS DECIMAL(19,0))")
    kept = scored(counts).filter(~F.coalesce(covered, F.lit(False)))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # A language's rows are ranked in parts before they meet in one task, so that this gets at most SALTS * first of them.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    kept = kept.withColumn("at", F.row_number().over(part)).filter(F.col("at") <= first)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= first)
    return kept.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
