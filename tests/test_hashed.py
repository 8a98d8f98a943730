"""The hashed encoder: as hashing each trigram by itself, but each distinct one once."""

import hashlib
import random

import numpy as np
import pytest

from textflow.operators import encoders


def _plain(texts, size):
    out = np.zeros((len(texts), size))
    for row, text in zip(out, texts, strict=True):
        for i in range(max(1, len(text) - 2)):
            row[int.from_bytes(hashlib.blake2b(text[i : i + 3].lower().encode(), digest_size=4).digest(), "little") % size] += 1
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


@pytest.mark.parametrize("size", [7, 64])
def test_as_each_trigram_by_itself(size):
    rng = random.Random(size)
    texts = ["", "a", "ab", "İ", "ΑΣ", "ΑΣΑ", "a\0b"] + ["".join(rng.choices("abXY \nÉßİΣσ日😀\0", k=rng.randrange(200))) for _ in range(200)]
    encoder = encoders.Hashed(size)
    assert (encoder.encode(texts) == _plain(texts, size)).all() and (encoder.encode(texts) == _plain(texts, size)).all()


def test_a_trigram_is_hashed_once(monkeypatch):
    calls, real = [], hashlib.blake2b
    monkeypatch.setattr(hashlib, "blake2b", lambda *a, **b: calls.append(1) or real(*a, **b))
    encoders.Hashed().encode(["abc" * 2000, "ßéz" * 2000, "abcab"])
    assert len(calls) == 6
