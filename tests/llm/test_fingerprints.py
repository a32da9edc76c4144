"""Fingerprints against plain versions of each step, and the order of documents over many tasks."""

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from smeltery.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, kind int, fingerprint string, part int, n_chars string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 5, "x", 1, "y") for r in rows], SCHEMA)


def joined(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def plain_level(window, width):
    h = sum(c / width * math.log2(width / c) for c in Counter(window).values())
    return h / math.log2(width) * fp.LEVELS


def plain_features(text, ranks, width, run, popular):
    levels = [int(x) for x in fp.entropy_levels(np.frombuffer(text, np.uint8), width)]
    wins = Counter(min(range(i, i + run), key=lambda j: (ranks[levels[j]], j)) for i in range(len(levels) - run + 1))
    return sorted(j for j, n in wins.items() if n >= popular)


def texts(seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aabcdeé日 ") for _ in range(rng.randint(1, 9)))
    out = ["", "a", "abc", "a" * 500, " ", "é" * 60, "x" * 46, "x" * 47, "x" * 129]
    return out + [" ".join(word() for _ in range(n)) for n in (3, 10, 20, 21, 22, 40, 80, 200, 900, 3000)]


@pytest.mark.parametrize("width", [4, 16, 64])
def test_entropy_levels_of_sliding_windows(width):
    for text in texts():
        data = text.encode()
        got = fp.entropy_levels(np.frombuffer(data, np.uint8), width)
        want = [plain_level(data[i : i + width], width) for i in range(len(data) - width + 1)]
        assert len(got) == len(want) and all(abs(a - b) < 1.01 for a, b in zip(got, want, strict=True))
        assert got.min(initial=0) >= 0 and got.max(initial=0) <= fp.LEVELS


@pytest.mark.parametrize("piece", [1 << 18, 100, 7])
def test_features_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(fp, "PIECE", piece)
    ranks = np.array(random.Random(1).sample(range(fp.LEVELS + 1), fp.LEVELS + 1))
    data = [t.encode() for t in texts()]
    for width, run, popular in ((16, 32, 8), (8, 5, 2)):
        got = fp.features(*joined(data), ranks, width, run, popular).tolist()
        start, want = 0, []
        for t in data:
            want += [start + j for j in plain_features(t, ranks, width, run, popular)]
            start += len(t)
        assert got == want


def test_histogram_counts_windows_of_one_text_only(monkeypatch):
    data = [t.encode() for t in texts()]
    want = Counter(x for t in data for x in fp.entropy_levels(np.frombuffer(t, np.uint8)).tolist())
    for piece in (1 << 18, 50):
        monkeypatch.setattr(fp, "PIECE", piece)
        got = fp.histogram(*joined(data))
        assert {i: int(n) for i, n in enumerate(got) if n} == dict(want)
    ranks = fp.ranks_of(got)
    seen = [i for i in np.argsort(ranks) if got[i]]
    assert [int(got[i]) for i in seen] == sorted(int(n) for n in got if n) and ranks[seen[0]] == 0


def test_chains_and_likeness():
    ranks = np.arange(fp.LEVELS + 1)
    data = [t.encode() for t in texts()]
    together = fp.chains(data, ranks)
    for t, chain in zip(data, together, strict=True):
        alone = fp.chains([t], ranks)[0].text()
        assert chain.text() == alone and fp.likeness(fp.Chain.of(alone), chain) == 1.0
        assert (chain.counts == fp.Chain.of(alone).counts).all()
        assert len(chain.filters) == -(-chain.counts.sum() // fp.PER_FILTER)
        assert (len(chain.filters) == 0) == (t == b"")
    for a in together:
        for b in together:
            assert 0 <= fp.likeness(a, b) <= 1 and fp.likeness(a, b) == fp.likeness(b, a)
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(4000)]
    long, other = " ".join(words[:2000]), " ".join(words[2000:])
    half = " ".join(words[:1000] + words[3000:])
    a, b, c = fp.chains([long.encode(), other.encode(), half.encode()], ranks)
    assert fp.likeness(a, b) < 0.02 and 0.3 < fp.likeness(a, c) < 0.7


def plain_result(rows, ranks):
    """Documents in order, each with the next."""
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for k, (i, t) in enumerate(order):
        u = order[(k + 1) % len(order)][1]
        n = len(t) // 4
        e = t[: len(t) - n] + u[:n]
        a, b, c = fp.chains([t.encode(), e.encode(), u.encode()], ranks)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), a.text(), b.text(), fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(map(repr, out))


def numbered():
    rows = [(i * 7 % 101 - 20, t) for i, t in enumerate(texts(3) * 3)]
    return rows + [(500, None), (501, "last " * 40), (-1000, "first " * 40), (None, "no id " * 30)]


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_documents_meet_the_next_in_order(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rows = numbered()
        docs = table(spark, rows)
        ranks = fp.rarity(docs)
        got = fp.compared_with_next(docs, ranks)
        assert sorted(repr(tuple(r)) for r in got.collect()) == plain_result(rows, ranks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_repeated_ids_lone_and_no_documents(spark):
    rows = [(1, "same text " * 30)] * 5 + [(1, "another text " * 20), (2, "x")]
    ranks = fp.rarity(table(spark, rows))
    got = fp.compared_with_next(table(spark, rows), ranks).collect()
    assert len(got) == 7 and len({r["fingerprint"] for r in got}) == 3
    lone = fp.compared_with_next(table(spark, [(9, "lone words " * 40)]), ranks).collect()
    assert len(lone) == 1 and lone[0]["near_next"] == 1.0
    assert fp.compared_with_next(table(spark, []), fp.rarity(table(spark, []))).count() == 0


def test_fingerprinted_replaces_a_clashing_column(spark):
    docs = table(spark, [(1, None), (2, "words " * 50), (3, "words " * 50)])
    ranks = fp.rarity(docs)
    got = {r["doc_id"]: r for r in fp.fingerprinted(docs, ranks).collect()}
    assert got[1]["fingerprint"] == "" and got[2]["fingerprint"] == got[3]["fingerprint"] != "" and got[3]["n_chars"] == "y"
    assert base64.b64decode(got[2]["fingerprint"])
