"""Quality rules: fixed statistics of a text, and divergence of its histograms from references of the languages.

A document has two histograms: character classes (each code point is of one class) and common words (how many of its
words are each of a language's common words; the rest is one bin more). The reference of a language holds the same
histograms over all documents of that language. The Jensen-Shannon distance (base 2, from 0 to 1) to a reference is
compared with a limit for each histogram; a document is rejected if no reference is near enough in both. A text can't vouch
for itself: its own counts are taken out of the reference of its language, and a reference only counts for a text if LEAST_MASS
words of other texts are behind it. So junk that is alone in a made-up language has no reference there and lets no other junk
through. A document whose own language has no such reference (no lang, too few other words, or one that given references
lack) can't be rejected for being far from those of others: it has no verdict, and says so. Histograms of short texts are
mostly noise, so texts under a minimum of words are exempt, and the limit of a longer one allows for the noise that so many
words have.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.llm._shared import cut
from textflow.llm._words import LOWER, SPACE, shingles, texts, word_hashes, words

#: Character classes: lower and upper case ASCII letters, code points above ASCII, digits, white space, sentence marks,
#: other ASCII marks, controls.
CLASSES = 8
_CLASS = np.full(256, 7, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[0x20:0x7F][_CLASS[0x20:0x7F] == 7] = 0, 1, 3, 6
_CLASS[SPACE], _CLASS[[ord(c) for c in ".,;:'\"?!-()"]] = 4, 5
_CLASS[0xC0:], _CLASS[0x80:0xC0] = 2, 255
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
#: A word is common in a language if it is this share of its words at least.
COMMON = 0.004
#: Limits of the distances, and the words a text needs to be judged by them.
CHAR_LIMIT, WORD_LIMIT, LEAST_WORDS = 0.27, 0.33, 40
#: Words of other texts of a language that its reference needs to count.
LEAST_MASS = 2000
#: Entries of the table of texts by common words of all languages that judge() fills at once.
CELLS = 1 << 22


def base_statistics(t, raw: list[bytes]) -> dict[str, np.ndarray]:
    """Of each text of a piece: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(t)
    n = len(t)
    solid = ~SPACE[t.data]

    def per_row(flags):
        sums = np.r_[0, np.cumsum(flags)]
        return sums[t.ends] - sums[t.starts]

    out = {"n_words": w.count, "word_chars": per_row(solid & ((t.data & 0xC0) != 0x80)), "n_symbols": per_row(_SYMBOL[t.data])}
    h = word_hashes(t.data, w.start, w.end)
    repeat = np.zeros(n, np.int64)
    rows, values = shingles(w, h, 5, short=False)
    if len(rows):
        order = np.lexsort((values, rows))
        same = (rows[order][1:] == rows[order][:-1]) & (values[order][1:] == values[order][:-1])
        twice = np.zeros(len(rows), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        begin = (np.cumsum(w.count) - w.count)[rows] + np.arange(len(rows)) - np.searchsorted(rows, rows)
        edge = np.zeros(len(h) + 6, np.int64)
        np.add.at(edge, begin[twice], 1)
        np.add.at(edge, begin[twice] + 5, -1)
        covered = np.cumsum(edge)[: len(h)] > 0
        repeat = np.bincount(w.row[covered], minlength=n)
    out["n_repeat_words"] = repeat
    lines = np.zeros(n, np.int64)
    many = np.flatnonzero(per_row(t.data == 10) > 0)
    for i in many:
        solid_lines = [x for x in raw[i].split(b"\n") if x.split()]
        lines[i] = len(solid_lines) - len(set(solid_lines))
    out["n_dup_lines"] = lines
    return out


def class_counts(t) -> np.ndarray:
    """Code points of each class, a row for each text of a piece."""
    kind = _CLASS[t.data]
    row = np.repeat(np.arange(len(t)), t.ends - t.starts)
    first = kind != 255
    return np.bincount(row[first] * CLASSES + kind[first], minlength=len(t) * CLASSES).reshape(len(t), CLASSES)


_PUNCTUATION = b".,;:'\"?!-()"


def _folded(raw: bytes) -> list[bytes]:
    """The words of a text in ASCII lower case, without punctuation."""
    return raw.translate(LOWER.tobytes(), _PUNCTUATION).split()


def _raw(t) -> list[bytes]:
    data = t.data.tobytes()
    return [data[i:j] for i, j in zip(t.starts, t.ends, strict=True)]


class Frequent:
    """Lossy counting: words with a share of at least `share` are kept, with a count that is too small by half of that
    share at most; memory is bounded by entries + 2 / share * log(words)."""

    def __init__(self, share: float, entries: int = 300_000):
        self.loss, self.entries, self.counts, self.missed, self.total, self.last = share / 2, entries, Counter(), {}, 0, 0.0

    def update(self, words: list[bytes]) -> None:
        self.counts.update(words)
        self.total += len(words)
        if len(self.counts) > self.entries:
            least = self.loss * self.total
            self.missed = {w: self.missed.get(w, self.last) for w, n in self.counts.items() if n + self.missed.get(w, self.last) > least}
            self.counts, self.last = Counter({w: self.counts[w] for w in self.missed}), least

    def found(self, share: float | None = None) -> dict[bytes, int]:
        """Words with a count of at least `share` (or half of the share to be kept) of all words."""
        least = (self.loss if share is None else share) * self.total
        return {w: n for w, n in self.counts.items() if n >= least}


def references(docs: DataFrame, common: float = COMMON) -> dict[str, dict]:
    """docs (text, lang) -> language: {"classes": counts, "words": {word: count}, "total": number of words}, from every document, for
    every language; the words are the common ones.

    The first pass gives each partition's words with a count of common / 4 of its words or more. What it leaves out of a
    word is under 3 / 4 of common (common / 2 by lossy counting), so the counts of a word that is common in its language
    add up to common / 4 of all words of the language at least; only such words, at most 4 / common for each language, come
    to the driver, and the second pass counts just these, over all documents. The result is bounded by languages / common."""

    def tally(batches, wanted):
        seen = defaultdict(lambda: Frequent(common) if wanted is None else Counter())
        chars, total = defaultdict(lambda: np.zeros(CLASSES, np.int64)), Counter()
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for t in texts(batch.column(0)):
                kinds = class_counts(t) if wanted is None else None
                for i, raw in enumerate(_raw(t)):
                    lang = langs[t.first + i]
                    if lang is None or wanted is not None and lang not in wanted:
                        continue
                    found = _folded(raw)
                    if wanted is None:
                        seen[lang].update(found)
                        total[lang] += len(found)
                        chars[lang] += kinds[i]
                    else:
                        seen[lang].update(filter(wanted[lang].__contains__, found))
        rows = [(lang, "w", w, n) for lang, x in seen.items() for w, n in (x.found(common / 4) if wanted is None else x).items()]
        rows += [(lang, "c", b"%d" % k, int(n)) for lang, v in chars.items() for k, n in enumerate(v)]
        rows += [(lang, "n", b"", n) for lang, n in total.items()]
        if rows:
            kinds = (pa.string(), pa.string(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], ["lang", "kind", "name", "n"])

    def gather(wanted):
        rows = docs.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(lambda b: tally(b, wanted), "lang string, kind string, name binary, n long")
        return rows.groupBy("lang", "kind", "name").agg(F.sum("n").alias("n"))

    first = cut(gather(None), "words")
    sizes = first.where("kind = 'n'").select("lang", F.col("n").alias("total"))
    words_of = {r.lang: r.total for r in sizes.toLocalIterator()}
    names, sums = sorted(words_of), defaultdict(lambda: defaultdict(dict))
    for r in first.join(F.broadcast(sizes), "lang").where(f"kind <> 'w' or n >= {common / 4!r} * total").toLocalIterator():
        sums[r.lang][r.kind][bytes(r.name)] = r.n
    counts = defaultdict(dict)
    for r in gather({lang: frozenset(sums[lang]["w"]) for lang in names}).toLocalIterator():
        counts[r.lang][bytes(r.name)] = r.n
    out = {}
    for lang in names:
        classes = [sums[lang]["c"].get(b"%d" % k, 0) for k in range(CLASSES)]
        usual = {w: c for w, c in counts[lang].items() if c >= common * words_of[lang]}
        out[lang] = {"classes": classes, "words": dict(sorted(usual.items())), "total": words_of[lang]}
    return out


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (root of the divergence to base 2) between rows of p and q."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        part = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return np.sqrt(np.maximum(part.sum(-1) / 2, 0))


_STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


#: What is said of a document: of too few words, without a reference of its own language, near one, far from all.
SHORT, WITHOUT, NEAR, FAR = "short", "no reference", "near", "far"


def judge(refs: dict[str, dict], char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT, least_words: int = LEAST_WORDS, least_mass: int = LEAST_MASS, included: bool = True):
    """A function of columns text and lang -> arrays: the statistics, base_failed, char_distance, word_distance, kept, verdict.
    included: texts are among those that the references were counted on, so each is taken out of its language's."""
    names = sorted(refs)
    every = sorted({w for x in names for w in refs[x]["words"]})
    place = {w: i for i, w in enumerate(every)}
    bins = [np.array([place[w] for w in refs[x]["words"]], int) for x in names]
    counts = [np.array([*refs[x]["words"].values()], float) for x in names]
    total = np.array([refs[x]["total"] for x in names], float)
    classes = [np.array(refs[x]["classes"], float) for x in names]
    number = {x: i for i, x in enumerate(names)}

    rows = max(1, CELLS // max(1, len(every)))

    def judged(column: pa.Array, langs: pa.Array) -> list[np.ndarray]:
        parts, of = [], np.array([number.get(x, -1) for x in langs.cast(pa.string()).to_pylist()], int)
        for t in texts(column):
            raw = _raw(t)
            s = base_statistics(t, raw)
            failed = (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])
            far, verdict = np.full((2, len(t)), np.nan), np.full(len(t), SHORT, object)
            every_long = np.flatnonzero(s["n_words"] >= least_words)
            kinds_of = class_counts(t) if len(every_long) else None
            for long in (every_long[i : i + rows] for i in range(0, len(every_long), rows)):
                hist, size = np.zeros((len(long), len(every))), np.zeros(len(long))
                for i, k in enumerate(long):
                    found = _folded(raw[k])
                    size[i] = len(found)
                    for word, m in Counter(filter(place.__contains__, found)).items():
                        hist[i, place[word]] = m
                n = s["n_words"][long]
                own, kinds = of[t.first + long], kinds_of[long].astype(float)
                d_char, d_word = np.full((2, len(names), len(long)), np.inf)
                for k in range(len(names)):
                    mine = (own == k) & included
                    mass = total[k] - size * mine
                    ok = np.flatnonzero(mass >= least_mass)
                    if not len(ok):
                        continue
                    h = hist[np.ix_(ok, bins[k])]
                    q = (counts[k] - h * mine[ok, None]) / mass[ok, None]
                    q = np.c_[q, np.maximum(1 - q.sum(1), 0)]
                    h = np.c_[h, np.maximum(n[ok] - h.sum(1), 0)] / n[ok, None]
                    c = classes[k] - kinds[ok] * mine[ok, None]
                    d_char[k, ok] = js_distance(kinds[ok] / kinds[ok].sum(1, keepdims=True), c / np.maximum(c.sum(1, keepdims=True), 1))
                    d_word[k, ok] = np.maximum(js_distance(h, q) - np.sqrt(h.shape[1] / (8 * n[ok])), 0)
                has = np.isfinite(d_char[np.maximum(own, 0), np.arange(len(long))]) & (own >= 0) if names else np.zeros(len(long), bool)
                verdict[long] = np.where(has, FAR, WITHOUT)
                some = np.flatnonzero(np.isfinite(d_char).any(0)) if names else np.empty(0, int)
                if len(some):
                    excess = np.maximum(d_char - char_limit, d_word - word_limit)[:, some]
                    best = excess.argmin(0)
                    far[:, long[some]] = d_char[best, some], d_word[best, some]
                    verdict[long[some][(excess.min(0) <= 0)]] = NEAR
            parts.append((*(s[x] for x in _STATISTICS), failed, far[0], far[1], ~failed & (verdict != FAR), verdict))
        return [np.concatenate(x) for x in zip(*parts, strict=True)]

    return judged


def quality(docs: DataFrame, refs: dict[str, dict] | None = None, char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT, least_words: int = LEAST_WORDS, least_mass: int = LEAST_MASS) -> DataFrame:
    """docs (doc_id, text, lang, ...) -> a row for each row: doc_id, the statistics, base_failed, char_distance,
    word_distance, kept, verdict.

    base_failed: fewer than 10 words, or over a fifth of the words in repeated windows of five. The method's verdict holds
    for texts of least_words words or more ("short" if fewer): the nearest reference must be within char_limit and, with an
    allowance of the root of bins / (8 * words) for noise, within word_limit ("near", else "far"). References made here leave out
    the text's own counts, and count for it with least_mass words of other texts or more; given ones are taken as counted
    on others. References of all languages count for a text; but if that of its own lang doesn't (a null lang has none), being far
    from the others doesn't reject it ("no reference"). kept: not base_failed, and not "far". Distances are of the nearest
    reference, null for short texts and where no reference counts. A null text has no words. An empty table gives an empty one."""
    made = refs is None
    refs = references(docs) if made else refs

    def run(batches):
        judged = judge(refs, char_limit, word_limit, least_words, least_mass, made)
        for batch in batches:
            if batch.num_rows:
                cols = judged(batch.column(1), batch.column(2))
                arrays = [pa.array(x.astype(np.int64)) for x in cols[:5]] + [pa.array(cols[5])] + [pa.array(x, mask=np.isnan(x)) for x in cols[6:8]] + [pa.array(cols[8].astype(bool)), pa.array(cols[9], pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *_STATISTICS, "base_failed", "char_distance", "word_distance", "kept", "verdict"])

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, char_distance double, word_distance double, kept boolean, verdict string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")).mapInArrow(run, schema)


def accepted(docs: DataFrame, refs: dict[str, dict] | None = None) -> DataFrame:
    """The rows of docs (text, lang, ...) that quality() keeps, with all their columns."""
    made = refs is None
    refs = references(docs) if made else refs

    def run(batches):
        judged = judge(refs, included=made)
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(judged(batch.column("text"), batch.column("lang"))[-2].astype(bool)))

    return docs.mapInArrow(run, docs.schema)
