"""Ratcliff-Obershelp similarity: the same as difflib's, also for long texts, where difflib's search is quadratic."""

import difflib
import random
import time

import pytest

from textflow.functions.matching import ratio


@pytest.mark.parametrize("letters", ["a", "ab", "abcde", "abcdefghijklmnopqrstuvwxyz .", "aé日😀"])
def test_ratio_is_difflibs(letters):
    rng = random.Random(letters)
    for n in (0, 1, 2, 7, 60, 199, 200, 201, 500):
        for power in (1, 6):
            a = "".join(rng.choices(letters, [rng.random() ** power for _ in letters], k=n))
            parts = [a[i : i + rng.randrange(1, 40)] for i in rng.choices(range(n or 1), k=6)]
            for b in (a, a[::-1], "".join(parts), "".join(rng.choices(letters, k=n)), ""):
                assert ratio(a, b) == (difflib.SequenceMatcher(None, a, b).ratio()), (a, b)


def test_long_texts_are_not_compared_pair_by_pair():
    """A hundred kinds of characters, each 1 in 100: 36 million pairs for difflib, in each of many regions."""
    rng = random.Random(5)
    kinds = [chr(200 + i) for i in range(110)]
    text = "".join(rng.choices(kinds, k=60_000))
    began = time.process_time()
    assert 0 < ratio(text, text[::-1]) < 1
    assert time.process_time() - began < 20
