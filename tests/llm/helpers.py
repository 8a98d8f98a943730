"""Awkward rows, and plain versions of what the operators compute."""

import random

WORDS = "the of and to in is that it for was with on as be at by this are from or have an they which one you were all her she there".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    made = ["".join(r.choice(["th", "er", "on", "an", "re", "ha", "st", "io", "le", "ou"]) for _ in range(r.randint(1, 4))) for _ in range(n)]
    return " ".join(w if r.random() < 0.6 else r.choice(WORDS) for w in made)


def awkward() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, n_words): nulls, empties, equal rows, near copies, a long text, odd characters."""
    base = prose(1, 120)
    changed = base.split()
    changed[60] = "changed"
    rows = [
        (0, base, "en", "a"), (1, " ".join(changed), "en", "a"), (2, base, "en", "b"), (2, base, "en", "b"), (3, None, "en", None), (4, "", None, "b"), (5, " \n\t ", "en", "b"), (6, "one two", "en", "b"),
        (7, "ONE two", "en", "c"), (None, base, None, None), (8, prose(2, 9000), "en", "a"), (9, "naïve 日本語 ＡＢＣ\u00a0x\u2003y \x85 z " * 20, "fr", "c"), (10, prose(3, 200) + " " + base, "en", "c"), (11, "a" * 700, "de", "c"),
        (12, prose(4, 80), "en", "a"), (13, prose(5, 80), "en", "a"), (-5, prose(6, 60), "en", "c"),
    ]
    return [(i, t, lang, s, len(t or ""), 7) for i, t, lang, s in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long"
