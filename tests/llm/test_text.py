from __future__ import annotations

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from terraloom.llm import neardup, text

ALPHABET = st.text(alphabet="aAbZ é\t\n\r\x0b\x0c \x1cß", max_size=60)


def fold(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


@given(ALPHABET, ALPHABET)
@settings(max_examples=200, deadline=None)
def test_words_are_runs_without_the_six_spaces(a, b):
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", fold(t))
    both = dict(zip(split(a) + split(b), np.concatenate([text.word_hashes(a), text.word_hashes(b)]).tolist(), strict=True))
    assert len(set(both.values())) == len(both)
    assert text.word_hashes(a).tolist() == [both[w] for w in split(a)]


def test_long_texts_are_hashed_whole():
    t = " ".join(f"word{i}" for i in range(120_000)) + " " + "x" * 400_000 + " end"
    assert len(text.word_hashes(t)) == 120_002
    assert text.word_hashes(t)[-1] == text.word_hashes("end")[0]
    _, start, end = text.tokens(t)
    assert t[start[-1] : end[-1]] == "end"


def test_shingles():
    assert len(text.shingle_set("a b a b a", 2)) == 2
    assert len(text.shingle_set("one", 2)) == 1
    assert len(text.shingle_set(" \n", 2)) == len(text.shingle_set(None, 2)) == 0
    assert text.shingle_set("A b", 2).tolist() == text.shingle_set("a\tB", 2).tolist()


def test_sketch_fills_and_concentrates():
    rng = np.random.default_rng(1)
    assert (neardup.sketch(np.array([7], np.uint64), 240) != neardup.EMPTY).all()
    for n, common in ((5, 4), (300, 200), (3000, 2400)):
        x = rng.integers(0, 2**63, 2 * n - common, dtype=np.uint64)
        est = np.mean([(neardup.sketch(text.mix64(x[:n] + np.uint64(k)), 240) == neardup.sketch(text.mix64(x[n - common :] + np.uint64(k)), 240)).mean() for k in range(8)])
        assert abs(est - common / (2 * n - common)) < 0.08
