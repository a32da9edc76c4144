"""Letters of texts beyond ASCII, and words that are cut."""

import random
import re
import unicodedata

import numpy as np
from pyspark.sql import functions as F

from smeltery.llm import language


def test_texts_without_letters_are_und(spark):
    kinds = {"xx": ["aba", "bab", "abab", "baa"], "yy": ["çéc", "céé", "écc", "ééç"]}
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(kinds[k]) for _ in range(20)), k) for i in range(200) for k in [sorted(kinds)[i % 2]]]
    signs = ["123 — 456 …", "😀 🎉👍🏽", "“ ” ‘’ «»", "、。「」！", "1 2", "٣٤٥ १२३ １２", "́", "€ ² ½ ×"]
    letters = ["aba — 456 …", "😀çéc", "日本", "ª"]
    docs = spark.createDataFrame([*rows, *((1000 + i, t, None) for i, t in enumerate(signs + letters))], "doc_id long, text string, lang string")
    model = language.train(docs)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predicted(docs, model).filter("doc_id >= 1000").collect()}
    assert [found[1000 + i] for i in range(len(signs))] == [("und", 0.0)] * len(signs)
    assert all(found[1000 + len(signs) + i][0] != "und" for i in range(len(letters)))
    kept = {r["doc_id"] for r in language.labelled(docs, model, ["doc_id"], "label", "score").filter(F.col("label") != "und").collect()}
    assert kept.isdisjoint(range(1000, 1000 + len(signs)))
    plain, signed = (language.Reader(model, 1) for _ in range(2))
    for reader, text in ((plain, "aba bab"), (signed, "aba — bab … 😀")):  # signs are not pooled
        data = np.frombuffer(text.encode(), np.uint8)
        reader.add(0, data, np.array([0, len(data)]))
    assert plain.result()[0] == signed.result()[0] and np.allclose(plain.result()[1], signed.result()[1])


def test_letters_and_cuts_follow_characters():
    rng = random.Random(1)
    given = "aZ19 é—日、😀𐐀٣“ʼª́ "
    for _ in range(100):
        text = "".join(rng.choice(given) if rng.random() < 0.8 else chr(rng.randrange(0x80, 0xD800)) for _ in range(rng.randrange(1, 200)))
        data = np.frombuffer(text.encode(), np.uint8)
        assert language.is_letter(data).tolist() == [unicodedata.category(c)[0] == "L" for c in text for _ in c.encode()]
        starts, ends, _ = language.segments(data, np.array([0, len(data)]))
        pieces = [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
        assert "".join(pieces) == re.sub(r"[\x20\x09-\x0D]", "", text) and all(len(p.encode()) < language.LONGEST + 4 for p in pieces)


def test_documents_with_a_language_stay(spark):
    """Short clean documents whose words many languages share; no label gets a large share of them."""
    rows = [(i, ["aba", "bab aba"][i % 5 % 2], f"l{i % 6}") for i in range(240)] + [(900, "12 — 3", None), (901, None, "l1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    scores = language.predicted(docs, language.train(docs)).filter("doc_id < 900 AND score < 0.35").count()
    assert scores == 240
    assert sorted(r["doc_id"] for r in language.identified(docs).collect()) == list(range(240))
