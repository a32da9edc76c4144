"""Collocations against plain counting of phrases."""

import random
import re
from collections import Counter

import pytest

from smeltery.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, n long, phrase string, f long"


def table(spark, rows):
    return spark.createDataFrame([(i, text, lang, 1, "x", 2) for i, (text, lang) in enumerate(rows)], SCHEMA)


def counted(rows, longest):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return f, n


def wanted(rows, longest=4, least=30, percent=80, first=2000):
    f, n = counted(rows, longest)
    f = Counter({p: c for p, c in f.items() if c >= least})
    out = []
    for lang in n:
        mine = []
        for (there, p), a in f.items():
            if there != lang or len(p) < 2:
                continue
            inside = (q for (x, q) in f if x == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * f[lang, q] >= percent * a for q in inside):
                continue
            cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            mine.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(mine)[:first])]
    return sorted(out)


def odd_rows():
    """Null and empty texts, null lang, repeated rows, repeated words, line ends, signs beyond ASCII, a hot phrase."""
    rng = random.Random(5)
    words = ["the", "The", "of", "é", "É", "x\x01", "x", "日本", "a-b", "\x00", "new", "york", "city", "\xa0"]
    ends = [" ", "  ", "\t", ". ", "\n", "\x0b", "!", " ", " ", " "]
    text = lambda n: "".join(rng.choice(words) + rng.choice(ends) for _ in range(n))
    rows = [(text(rng.randint(0, 60)), rng.choice(["en", "en", "fr", None, "und", ""])) for _ in range(90)]
    rows += [(None, "en"), ("", "fr"), (" \t\n", None), ("...", "xx"), ("one", "only")]
    rows += [("new york city hall " * 40, "en"), ("go " * 100, "en"), ("New York\tCity hall, new york", "en")] * 3
    return rows + [("of the of the. " * 500, "de"), (text(3000), "en")]


@pytest.mark.parametrize("settings", [{}, {"least": 3, "longest": 5, "percent": 60}, {"least": 2, "longest": 2, "first": 7}])
def test_collocations_against_plain_counting(spark, settings):
    rows = odd_rows()
    assert sorted(map(tuple, co.collocations(table(spark, rows), **settings).collect())) == wanted(rows, **settings)


def test_full_tables_of_bits_and_small_runs_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(co, "MOST_BITS", 64)
    monkeypatch.setattr(co, "TEXT_BYTES", 50)
    monkeypatch.setattr(co, "SALTS", 3)
    rows = odd_rows()
    assert sorted(map(tuple, co.collocations(table(spark, rows), least=4).collect())) == wanted(rows, least=4)


def test_no_rows(spark):
    assert co.collocations(table(spark, [])).count() == 0
    assert co.collocations(table(spark, [(None, None), ("a b", "en")])).count() == 0


def test_bits_never_say_no_to_a_frequent_phrase(spark):
    counts = co.phrase_counts(table(spark, odd_rows()), 2, 5)
    for order in (1, 2):
        bits = co.Bits(*co._bits(counts, order).value)
        frequent = [r for r in counts.collect() if r["order"] == order]
        assert frequent
        for r in frequent:
            data = co.np.frombuffer(r["phrase"].encode(), co.np.uint8)
            assert bits.may_be(co.Words(data, co.np.array([0, len(data)])).hashes(r["lang"])).all()


def test_counts_beyond_64_bits_of_product(spark):
    """The score's product passes 2^63; its cut and the share of a longer phrase are exact."""
    big = 9_000_000_000_000_000
    rows = [("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "c", 1, big), ("en", "a b", 2, big - 1), ("en", "b c", 2, big - 3), ("en", "a b c", 3, big // 10 * 8)]
    found = {r["phrase"]: r for r in co.scored(spark.createDataFrame(rows, "lang string, phrase string, order int, f long")).collect()}
    assert found["a b"]["score"] == 2000000 * (big - 1) // (2 * big + 1)
    cuts = {1: (big, big - 3), 2: (big - 1, big)}
    k, (l, r) = min(cuts.items(), key=lambda c: (2000000 * (big // 10 * 8) // sum(c[1]), c[0]))
    assert (found["a b c"]["k"], found["a b c"]["l"], found["a b c"]["r"]) == (k, l, r)
    assert found["a b"]["longer"] == found["b c"]["longer"] == big // 10 * 8
