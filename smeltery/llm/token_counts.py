"""Token counts that follow edits.

A text is kept as a tree: its leaves are runs of whole pre-tokens, cut where no pre-token can reach across, whatever
stands on both sides; inner nodes hold the sums of tokens and of code points below them. An edit re-encodes the leaves it
touches, and a neighbour where the edit took the cut between them away, and updates the sums above these. A leaf that
edits have made large is cut again. A single pre-token, such as letters without anything between them, is never cut.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Sequence

import pyarrow as pa
import regex
import tiktoken
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.shared import fresh, text_or_empty

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Where such texts can be cut: between letters, digits, white space and other signs, but not after white space, which may belong to
# what follows, nor between an apostrophe and a letter. Signs that tables of letters may not agree on cut nothing.
CUTS = (
    r"(?<=\p{L})(?=[^\p{L}\p{Cn}\x1c-\x1f])|(?<=\p{N})(?=[^\p{N}\p{Cn}\x1c-\x1f])"
    r"|(?<=[^\s\p{L}\p{N}\p{Cn}\x1c-\x1f'])(?=[\s\p{L}\p{N}--[\x1c-\x1f]])|(?<=')(?=[\s\p{N}--[\x1c-\x1f]])"
)
# Of other patterns it is only taken for granted that a space after text begins a pre-token.
SPACES = r"(?<=[^\s\x1c-\x1f])(?= )"
LEAF = 512  # code points, at least
EDITS = "array<struct<start: bigint, end: bigint, text: string>>"


class TokenTree:
    """Leaves of a text under sums of their tokens and code points, kept in arrays: node i has the children 2i, 2i + 1."""

    def __init__(self, text: str, count: Callable[[str], int], leaf: int = LEAF, cuts: str = CUTS) -> None:
        self.count, self.leaf, self.cuts = count, leaf, regex.compile(cuts, regex.V1)
        leaves = self._parts(text)
        self._plant(leaves, [count(part) if part else 0 for part in leaves])

    def _parts(self, text: str) -> list[str]:
        """Leaves of a text, at least one."""
        parts, at = [], 0
        while len(text) - at > self.leaf and (cut := self.cuts.search(text, at + self.leaf)):
            parts.append(text[at : cut.start()])
            at = cut.start()
        return [*parts, text[at:]]

    def _plant(self, leaves: list[str], tokens: list[int]) -> None:
        """The tree above leaves and their tokens."""
        self.leaves, self.size = leaves, 1 << (len(leaves) - 1).bit_length()
        blank = [0] * (self.size - len(leaves))
        self.tokens, self.points = [0] * self.size + tokens + blank, [0] * self.size + [len(part) for part in leaves] + blank
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _apart(self, left: str, right: str) -> bool:
        """Whether the place between two texts is a cut."""
        return self.cuts.match(left[-1] + right[0], 1) is not None

    def _sum(self, i: int) -> None:
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
        self.points[i] = self.points[2 * i] + self.points[2 * i + 1]

    def text(self) -> str:
        return "".join(self.leaves)

    def _leaf_at(self, point: int) -> tuple[int, int]:
        """(leaf, offset in it) of a code point; the text's end belongs to the last leaf."""
        i = 1
        while i < self.size:
            i *= 2
            if point >= self.points[i] and self.points[i + 1]:
                point -= self.points[i]
                i += 1
        return i - self.size, point

    def _beside(self, i: int, step: int) -> int | None:
        """The next leaf with text in a direction."""
        i += step
        while 0 <= i < len(self.leaves) and not self.leaves[i]:
            i += step
        return i if 0 <= i < len(self.leaves) else None

    def edit(self, start: int, end: int, text: str) -> int:
        """Replaces the code points from start to before end, both cut to the text's length; returns the code points that
        were encoded anew."""
        start = min(max(start, 0), self.points[1])
        end = min(max(end, start), self.points[1])
        (low, a), (high, b) = self._leaf_at(start), self._leaf_at(end)
        new = self.leaves[low][:a] + text + self.leaves[high][b:]
        left, right = self._beside(low, -1), self._beside(high, 1)
        if not new and left is not None and right is not None and not self._apart(self.leaves[left], self.leaves[right]):
            new, low, left = self.leaves[left], left, self._beside(left, -1)
        while left is not None and new and not self._apart(self.leaves[left], new):
            new, low, left = self.leaves[left] + new, left, self._beside(left, -1)
        while right is not None and new and not self._apart(new, self.leaves[right]):
            new, high, right = new + self.leaves[right], right, self._beside(right, 1)
        parts = self._parts(new) if len(new) > 2 * self.leaf else [new]
        if len(parts) > high - low + 1:
            self._widen(low, high, parts)
            return len(new)
        touched = set()
        for i in range(low, high + 1):
            part = parts[i - low] if i - low < len(parts) else ""
            if part or self.leaves[i]:
                self.leaves[i] = part
                self.tokens[self.size + i], self.points[self.size + i] = self.count(part) if part else 0, len(part)
                touched.add((self.size + i) // 2)
        while touched:
            above = set()
            for i in touched:
                if i:
                    self._sum(i)
                    above.add(i // 2)
            touched = above
        return len(new)

    def _widen(self, low: int, high: int, parts: list[str]) -> None:
        """Puts parts in the place of fewer leaves. Empty leaves go; the others keep their counts."""
        kept = [(part, self.tokens[self.size + i]) for i, part in enumerate(self.leaves) if part and not low <= i <= high]
        before = sum(1 for part in self.leaves[:low] if part)
        kept[before:before] = [(part, self.count(part)) for part in parts]
        self._plant([part for part, _ in kept], [n for _, n in kept])

    @property
    def total(self) -> int:
        return self.tokens[1]


def vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    """Ranks of byte pairs; a vocabulary file has a fixed, small size."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encoding_of(shared: Broadcast, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a broadcast vocabulary. A worker builds it once and keeps it with the broadcast."""
    if not hasattr(shared, "encoding"):
        shared.encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
    return shared.encoding


def with_edits(docs: DataFrame, edits: DataFrame, column: str = "edits") -> DataFrame:
    """docs with a column of their edits in the order of seq. edits: doc_id, seq, start, end, text; null ids find no document."""
    made = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "start", "end", "text"))).alias(column))
    made = made.withColumn(column, F.transform(column, lambda e: F.struct(e["start"].cast("long").alias("start"), e["end"].cast("long").alias("end"), e["text"].alias("text"))))
    return docs.join(made, "doc_id", "left")


def counted(
    docs: DataFrame, edits: str = "edits", path: str = VOCABULARY, pattern: str = PATTERN, keep: Sequence[str] = ("doc_id",),
    cuts: str | None = None,
) -> DataFrame:
    """The columns keep of docs, and: n_tokens, n_tokens_edited, n_chars_edited, n_chars_encoded (code points that the
    edits encoded anew), edited (the text after them).

    edits is a column of start, end, text; each edit is of the text that the ones before it left. Null texts count as
    empty, null edits as none; cuts says where texts of a pattern can be cut, by the sign on each side; in an edit a null start is 0, a null end its start, a null text empty. Repeated rows are
    counted each.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    cuts = cuts or (CUTS if pattern == PATTERN else SPACES)
    whole, made = fresh(docs, "whole_text"), fresh(docs, "edits_made")

    def run(batches):
        encode = encoding_of(ranks, pattern).encode_ordinary
        count = lambda part: len(encode(part))
        for batch in batches:
            rows = []
            for text, todo in zip(batch.column(whole), batch.column(made), strict=True):
                tree = TokenTree(text.as_py(), count, cuts=cuts)
                before, anew = tree.total, 0
                for e in todo.as_py() or ():
                    if e is not None:
                        start = e["start"] or 0
                        anew += tree.edit(start, e["end"] if e["end"] is not None else start, e["text"] or "")
                rows.append((before, tree.total, tree.points[1], anew, tree.text()))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.string()]
            names = ["n_tokens", "n_tokens_edited", "n_chars_edited", "n_chars_encoded", "edited"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [*keep, *names])

    schema = docs.select(*keep).withColumns({c: F.lit(0).cast("long") for c in ("n_tokens", "n_tokens_edited", "n_chars_edited", "n_chars_encoded")}).withColumn("edited", F.lit("")).schema
    return docs.select(*keep, text_or_empty().alias(whole), F.col(edits).cast(EDITS).alias(made)).mapInArrow(run, schema)
