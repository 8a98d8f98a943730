"""Word hashes, and the operators on words whose bytes repeat in patterns (Thue-Morse) that fool hashes linear in the bytes."""

import numpy as np
import pyarrow as pa

from textflow.llm import neardup, quality
from textflow.llm._words import texts, word_hashes, words

from .helpers import prose


def thue_morse(n, a, b):
    s = [a]
    while len(s) < n:
        s += [b if x == a else a for x in s]
    return "".join(s[:n])


MORSE = [thue_morse(n, a, b) for n in (1024, 2048) for a, b in ("ab", "ba", "xy", "yx")]


def test_equal_hashes_are_equal_words():
    made = prose(3, 5000).split() + MORSE + ["a" * i for i in range(1, 40)] + ["a" * 15 + "b", "b" + "a" * 15, "ä" * 9, "a" * 7 + "b" + "a" * 8]
    for t in texts(pa.array([" ".join(made), None, "", "x " * 3, " ".join(reversed(made))])):
        w = words(t)
        h = word_hashes(t.data, w.start, w.end)
        raw = [t.data[i:j].tobytes() for i, j in zip(w.start, w.end, strict=True)]
        assert len(set(raw)) == len(set(h.tolist())) == len(set(zip(raw, h.tolist(), strict=True)))
    assert len(word_hashes(np.zeros(0, np.uint8), np.zeros(0, int), np.zeros(0, int))) == 0


def test_patterned_words_are_told_apart(spark):
    """Ten common words, then patterned ones: two texts share 16 of 26 shingles, and none has a repeated window."""
    head = prose(7, 20).split()
    one, two = [" ".join([*head, *tail]) for tail in (MORSE[:2] + head[:3], MORSE[1::-1] + head[:3])]
    df = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (one.split(), two.split())]
    assert len(sets[0] & sets[1]) < 0.75 * len(sets[0] | sets[1])
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(df).collect()} == {(1, len(sets[0]), 1), (2, len(sets[1]), 2)}
    window = MORSE[0:2] + head[:3]
    text = " ".join([*window, *head[3:15], *MORSE[1::-1], *head[:3], *head[15:]])
    plain = text.split()
    assert len({tuple(plain[i : i + 5]) for i in range(len(plain) - 4)}) == len(plain) - 4
    got = quality.quality(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")).first()
    assert got.n_repeat_words == 0 and not got.base_failed
