"""Leaves of token trees: cut at any safe place, again when edits have made them large, right after any edit."""

import random

import pytest
import tiktoken

from smeltery.llm import token_counts
from smeltery.llm.token_counts import LEAF, TokenTree

SIGNS = ["a", "Zq", "ß", "字", "词语", "1", "²", "٣", " ", "  ", "\n", "\t", "　", "\x1c", "\x85", "'", "'s", "'ll", "'RE", "!", "，", "。", "{", '":', "́", "\U0001f600", "͸", "_"]


@pytest.fixture(scope="module")
def count():
    encoding = tiktoken.Encoding("t", pat_str=token_counts.PATTERN, mergeable_ranks=token_counts.vocabulary(), special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


@pytest.mark.parametrize("cuts", [token_counts.CUTS, token_counts.SPACES])
def test_any_edits_of_any_signs(count, cuts):
    rng = random.Random(5)
    drawn = lambda n: "".join(rng.choices(SIGNS, k=rng.randint(0, n)))
    for _ in range(400):
        text = drawn(60)
        tree = TokenTree(text, count, rng.choice([1, 2, 5, 20]), cuts)
        assert (tree.text(), tree.total) == (text, count(text))
        for _ in range(12):
            a, b = sorted((rng.randint(0, len(text)), rng.randint(0, len(text))))
            b = min(b, a + rng.choice([0, 1, 3, 60]))
            new = drawn(rng.choice([0, 2, 25]))
            text = text[:a] + new + text[b:]
            tree.edit(a, b, new)
            assert (tree.text(), tree.total, tree.points[1]) == (text, count(text), len(text))


@pytest.mark.parametrize("unit", ["汉字写成的句子，没有空格。", '{"key":[1,22,"x"],', "one\n", "word ", "a1"])
def test_an_edit_encodes_little_without_spaces(count, unit):
    text = unit * (90_000 // len(unit))
    tree = TokenTree(text, count)
    assert tree.edit(45_000, 45_010, "new 文字") < 3 * LEAF
    edited = text[:45_000] + "new 文字" + text[45_010:]
    assert (tree.text(), tree.total) == (edited, count(edited))


def test_leaves_that_grow_are_cut_again(count):
    text = "some words, " * 200
    tree = TokenTree(text, count)
    for i in range(2000):
        assert tree.edit(1000, 1000, f"word{i}, ") <= 2 * LEAF + 20
        text = f"{text[:1000]}word{i}, {text[1000:]}"
    assert tree.edit(1000, 1000, text) == pytest.approx(len(text), abs=2 * LEAF)
    assert max(map(len, tree.leaves)) <= 2 * LEAF + 20
    text = text[:1000] + text + text[1000:]
    assert (tree.text(), tree.total) == (text, count(text))


def test_one_pre_token_is_one_leaf(count):
    tree = TokenTree("字" * 3000, count)
    assert len(tree.leaves) == 1 and tree.edit(1500, 1500, "，") == 3001 and len(tree.leaves) == 2
    assert tree.total == count("字" * 1500 + "，" + "字" * 1500)


def test_everything_can_go(count):
    tree = TokenTree("a1" * 2000, count)
    tree.edit(0, 4000, "")
    assert (tree.text(), tree.total, tree.edit(0, 9, "x y"), tree.total) == ("", 0, 3, 2)
