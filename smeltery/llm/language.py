"""Language identification by a bidirectional gated recurrent network over bytes.

A text is a row of segments: its words, longer ones cut between characters. The network reads each segment from both ends and labels every
byte; a document's probabilities are the means over its letters. Equal segments get equal labels, so a task runs the
network once for each distinct segment it holds.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.shared import Hasher, chunks, fresh, lean, slices, table, text_or_empty, words_of
from smeltery.llm.toxicity import held_out

HIDDEN = 8
LONGEST = 24  # bytes of a segment
PER_LANGUAGE = 250  # training texts, about
TRAINING_SEGMENTS = 60_000  # of them
STEPS, BATCH, RATE = 700, 384, 0.02
HELD_WORDS = 800_000  # words whose distinct segments are looked for at once
SEGMENTS = 8_192  # that the network reads at once


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


class Direction:
    """A gated recurrent layer over bytes: gates r and z, then the candidate n, side by side in its weights."""

    def __init__(self, rng: np.random.Generator, hidden: int) -> None:
        self.h = hidden
        self.weights = [
            rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32),  # of the byte
            rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32),  # of the state
            np.zeros(3 * hidden, np.float32),
        ]

    def forward(self, x: np.ndarray, active: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each byte, (longest, segments, hidden). Segments are sorted by length, active[t] have a byte t."""
        w, u, b = self.weights
        h, H = np.zeros((x.shape[1], self.h), np.float32), self.h
        out = np.zeros((len(x), x.shape[1], H), np.float32)
        w = w + b
        for t, k in enumerate(active):
            before, a = h[:k], w[x[t, :k]]
            s = before @ u
            gates = _sigmoid(a[:, : 2 * H] + s[:, : 2 * H])
            r, z = gates[:, :H], gates[:, H:]
            n = np.tanh(a[:, 2 * H :] + r * s[:, 2 * H :])
            after = n + z * (before - n)
            if keep is not None:
                keep.append((before.copy(), r, z, n, s[:, 2 * H :]))
            h[:k] = after
            out[t, :k] = after
        return out

    def backward(self, x: np.ndarray, active: np.ndarray, kept: list, given: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weights by backpropagation through time; given: those of the states."""
        w, u, b = self.weights
        H = self.h
        dw, du, db = np.zeros_like(w), np.zeros_like(u), np.zeros_like(b)
        dh = np.zeros(given.shape[1:], np.float32)
        for t in range(len(active) - 1, -1, -1):
            k = active[t]
            before, r, z, n, sn = kept[t]
            d = dh[:k] + given[t, :k]
            dn = d * (1 - z) * (1 - n * n)
            dz = d * (before - n) * z * (1 - z)
            dr = dn * sn * r * (1 - r)
            da = np.concatenate([dr, dz, dn], 1)
            ds = np.concatenate([dr, dz, dn * r], 1)
            np.add.at(dw, x[t, :k], da)
            db += da.sum(0)
            du += before.T @ ds
            dh[:k] = d * z + ds @ u.T
        return [dw, du, db]


@dataclass
class Model:
    languages: list[str]
    ahead: Direction | None = None
    back: Direction | None = None
    out: list[np.ndarray] = field(default_factory=list)  # weights and biases of the labels

    def all_weights(self) -> list[np.ndarray]:
        return [*self.ahead.weights, *self.back.weights, *self.out]

    def labelled(self, x: np.ndarray, y: np.ndarray, lengths: np.ndarray, keep: tuple[list, list] | None = None):
        """Probabilities of the languages at each byte, (longest, segments, languages), and the states they come from.
        x: bytes of segments, (longest, segments), sorted by falling length; y: the same from the end."""
        T = len(x)
        active = np.searchsorted(-lengths, -np.arange(T), "left")
        f = self.ahead.forward(x, active, keep and keep[0])
        g = self.back.forward(y, active, keep and keep[1])
        at = np.maximum(lengths[None, :] - 1 - np.arange(T)[:, None], 0)
        states = np.concatenate([f, np.take_along_axis(g, at[:, :, None], 0)], 2)
        logits = states @ self.out[0] + self.out[1]
        logits -= logits.max(2, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(2, keepdims=True), states, active, at


def segments(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, texts' numbers): words at white space, cut every LONGEST bytes or at the start of the character there."""
    starts, ends, first = words_of(data, at, table("space"))
    of = np.repeat(np.arange(len(at) - 1), np.diff(first))
    long = ends - starts > LONGEST
    if long.any():
        pieces = -(-(ends - starts) // LONGEST)
        which = np.repeat(np.arange(len(starts)), pieces)
        step = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        cuts = starts[which] + step * LONGEST
        for _ in range(3):
            cuts -= (step > 0) & ((data[cuts] & 0xC0) == 0x80)
        ends = np.where(np.append(step[1:], 0) > 0, np.append(cuts[1:], 0), ends[which])
        starts, of = cuts, of[which]
    return starts, ends, of


def matrix(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments sorted by falling length as columns of bytes, the same from the end, and lengths. Zero fills up."""
    lengths = ends - starts
    step = np.arange(int(lengths.max()))[:, None]
    inside = step < lengths[None, :]
    top = len(data) - 1
    x = np.where(inside, data[np.minimum(starts[None, :] + step, top)], 0)
    y = np.where(inside, data[np.clip(ends[None, :] - 1 - step, 0, top)], 0)
    return x, y, lengths


def _letter_edges() -> np.ndarray:
    """Code points at which runs of letters (general categories L*) start and, in turn, end."""
    letter = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), np.int8, sys.maxunicode + 1)
    return np.flatnonzero(np.diff(letter, prepend=0, append=0))


# Tasks get it with the functions that use it; a cached function would be looked up by name, where the library is missing.
LETTER_EDGES = _letter_edges()


def is_letter(data: np.ndarray) -> np.ndarray:
    """Bytes that belong to letters, of UTF-8 texts one after another."""
    out = ((data | 32) >= 97) & ((data | 32) <= 122)
    lead = np.flatnonzero(data >= 0xC2)
    if not len(lead):
        return out
    first = data[lead].astype(np.int64)
    more = 1 + (first >= 0xE0) + (first >= 0xF0)
    point, whole = first & (0x3F >> more), first < 0xF5
    for k in (1, 2, 3):
        has, at = more >= k, lead + k
        byte = data[np.minimum(at, len(data) - 1)].astype(np.int64)
        whole &= ~has | (at < len(data)) & ((byte & 0xC0) == 0x80)
        point = np.where(has, point << 6 | byte & 0x3F, point)
    letter = whole & (np.searchsorted(LETTER_EDGES, point, "right") % 2 == 1)
    for k in (0, 1, 2, 3):
        out[lead[letter & (more >= k)] + k] = True
    return out


def fitted(texts: pa.Array, languages: list[str], seed: int = 5, hidden: int = HIDDEN, steps: int = STEPS) -> Model:
    """Trains the network by backpropagation through time on segments drawn evenly from the languages. With no language
    it stays empty; with one, that is always the label."""
    names = sorted(set(languages))
    model = Model(names)
    if not names:
        return model
    rng = np.random.default_rng(seed)
    model.ahead, model.back = Direction(rng, hidden), Direction(rng, hidden)
    model.out = [rng.normal(0, 0.3, (2 * hidden, len(names))).astype(np.float32), np.zeros(len(names), np.float32)]
    label = np.array([names.index(x) for x in languages])
    data, found = np.zeros(0, np.uint8), [np.zeros((0, 3), np.int64)]
    for first, part, at in chunks(texts):
        s, e, of = segments(part, at)
        found.append(np.stack([s + len(data), e + len(data), label[first + of]], 1))
        data = np.concatenate([data, part])
    found = np.concatenate(found)
    by = [rows for i in range(len(names)) if len(rows := found[found[:, 2] == i])]
    if not by:
        return model
    by = [rows[rng.integers(0, len(rows), -(-TRAINING_SEGMENTS // len(by)))] for rows in by]
    found = rng.permutation(np.concatenate(by))
    weights = model.all_weights()
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        rows = found[rng.integers(0, len(found), BATCH)]
        rows = rows[np.argsort(rows[:, 0] - rows[:, 1], kind="stable")]
        x, y, lengths = matrix(data, rows[:, 0], rows[:, 1])
        keep: tuple[list, list] = ([], [])
        p, states, active, at = model.labelled(x, y, lengths, keep)
        d = p.copy()
        d[:, np.arange(len(rows)), rows[:, 2]] -= 1
        d *= (np.arange(len(x))[:, None] < lengths[None, :])[:, :, None] / np.float32(lengths.sum())
        d = d.astype(np.float32)
        flat, given = states.reshape(-1, 2 * hidden), d @ model.out[0].T
        back = np.zeros_like(given[:, :, hidden:])
        np.put_along_axis(back, at[:, :, None], given[:, :, hidden:], 0)
        # Past a segment's end, at is 0 and d is 0; write the real gradient of the first step last.
        back[0] = np.take_along_axis(given[:, :, hidden:], (lengths - 1)[None, :, None], 0)[0]
        grads = [
            *model.ahead.backward(x, active, keep[0], given[:, :, :hidden]), *model.back.backward(y, active, keep[1], back),
            flat.T @ d.reshape(-1, d.shape[2]), d.sum((0, 1)),
        ]
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for i, g in enumerate(grads):
            np.clip(g, -1, 1, out=g)
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            weights[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
    return model


def _pooled(model: Model, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each segment the sums over its letters of the languages' probabilities."""
    out = np.zeros((len(starts), len(model.languages)))
    order, letters = np.argsort(starts - ends, kind="stable"), is_letter(data)
    for a in range(0, len(order), SEGMENTS):
        rows = order[a : a + SEGMENTS]
        x, y, lengths = matrix(data, starts[rows], ends[rows])
        p = model.labelled(x, y, lengths)[0]
        step = np.arange(len(x))[:, None]
        pooled = letters[np.minimum(starts[rows] + step, len(data) - 1)] & (step < lengths)
        out[rows] = np.einsum("tnl,tn->nl", p, pooled.astype(np.float32))
    return out


class Reader:
    """Pools the labels of documents; texts are added in parts, and distinct segments are read once for all of them."""

    def __init__(self, model: Model, n: int) -> None:
        self.model, self.hasher = model, Hasher()
        self.sums, self.letters = np.zeros((n, len(model.languages))), np.zeros(n)
        self.parts, self.held = [], 0

    def add(self, first: int, data: np.ndarray, at: np.ndarray) -> None:
        letters = np.concatenate([[0], np.cumsum(is_letter(data))])
        self.letters[first : first + len(at) - 1] = np.diff(letters[at])
        if not self.model.out:
            return
        starts, ends, of = segments(data, at)
        lettered = letters[ends] > letters[starts]
        starts, ends, of = starts[lettered], ends[lettered], of[lettered] + first
        hashes, where, which = np.unique(self.hasher.words(data, starts, ends), return_index=True, return_inverse=True)
        self.parts.append((hashes, data, starts[where], ends[where], which.astype(np.int32), of.astype(np.int32)))
        self.held += len(of)
        if self.held > HELD_WORDS:
            self.read()

    def read(self) -> None:
        if not self.parts:
            return
        bases = np.cumsum([0, *(len(p[1]) for p in self.parts)])
        starts = np.concatenate([p[2] + b for p, b in zip(self.parts, bases, strict=False)])
        ends = np.concatenate([p[3] + b for p, b in zip(self.parts, bases, strict=False)])
        data = np.concatenate([p[1] for p in self.parts])
        _, where, which = np.unique(np.concatenate([p[0] for p in self.parts]), return_index=True, return_inverse=True)
        pooled = _pooled(self.model, data, starts[where], ends[where])
        at = 0
        for hashes, _, _, _, inverse, of in self.parts:
            own = pooled[which[at : at + len(hashes)]]
            at += len(hashes)
            for i in range(pooled.shape[1]):
                self.sums[:, i] += np.bincount(of, own[inverse, i], len(self.sums))
        self.parts, self.held = [], 0

    def result(self) -> tuple[list[str], np.ndarray]:
        """Languages, and the means over letters of the probabilities; `und` with 0 for texts without letters."""
        self.read()
        if not len(self.letters) or not self.model.languages:
            return ["und"] * len(self.letters), np.zeros(len(self.letters))
        p = self.sums / np.maximum(self.letters, 1)[:, None]
        best = p.argmax(1)
        score = np.clip(p[np.arange(len(best)), best], 0, 1)
        return [self.model.languages[b] if n else "und" for b, n in zip(best, self.letters, strict=True)], np.where(self.letters > 0, score, 0.0)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learns from about per_language texts of each non-null lang, drawn by the hashes of their ids, none held out."""
    usable = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), text_or_empty().alias("text")).filter("lang IS NOT NULL").filter(~held_out(4, 2))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return Model([])
    shares = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, per_language / n))])
    drawn = usable.filter(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 30)) < shares[F.col("lang")] * (1 << 30))
    rows = drawn.limit(2 * per_language * len(counts)).toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
    if not len(rows):
        return Model([])
    return fitted(rows["text"].chunk(0), rows["lang"].to_pylist())


def labelled(docs: DataFrame, model: Model, keep: list[str], label: str, score: str) -> DataFrame:
    """The columns keep of docs, with the predicted language and its pooled probability. Null texts and texts without
    letters are `und` with score 0. Repeated rows are labelled each."""
    text = "text" if "text" in keep else fresh(docs, "whole_text")

    def run(batches):
        for batch in batches:
            reader = Reader(model, len(batch))
            for part in chunks(batch.column(text)):
                reader.add(*part)
            names, scores = reader.result()
            columns = [batch.column(c) for c in keep]
            yield from slices(pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*keep, label, score]))

    schema = docs.select(*keep).withColumn(label, F.lit("")).withColumn(score, F.lit(0.0)).schema
    whole = [] if text in keep else [text_or_empty().alias(text)]
    return docs.select(*keep, *whole).mapInArrow(lean(run), schema)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score."""
    out = labelled(docs, model, ["doc_id"], "lang_pred", "score")
    return out.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


def identified(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, whose text has a language, however sure the network is of it: one without letters,
    null and empty ones too, has none. Repeated rows are judged each; an empty table stays empty."""
    label, score = fresh(docs, "label"), fresh(docs, "score")
    found = labelled(docs, train(docs), docs.columns, label, score)
    return found.filter(F.col(label) != "und").drop(label, score)
