"""op11 to op13 against plain versions over whole tables, and their operators on edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textflow.llm import importance, jaccard, periods
from textflow.llm._words import texts
from textflow.llm.queries import QUERIES

from .helpers import SCHEMA, awkward, prose
from .test_queries import folder, rows  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(t, least=24, times=3):
    out = set()
    for q in range(1, len(t) // times + 1):
        i = 0
        while i + q < len(t):
            j = i
            while j + q < len(t) and t[j] == t[j + q]:
                j += 1
            n = j + q - i
            if j > i and n >= max(least, times * q) and not any(all(t[i + k] == t[i + k + d] for k in range(n - d)) for d in range(1, q)):
                out.add((i, n, q))
            i = max(j, i + 1)
    return sorted(out)


def odd_words(r):
    k, n = r.choice([1, 2, 2, 3, 5]), r.randrange(90)
    t = [r.randrange(k) for _ in range(n)]
    if n and r.random() < 0.6:
        p = r.randrange(1, 9)
        t = (t[:p] * 60)[: r.randrange(60)] + t + t[-r.randrange(1, 20) :] * r.randrange(4)
    return t


@pytest.mark.parametrize(("least", "times"), [(24, 3), (1, 2), (6, 3), (5, 4), (1, 3)])
def test_runs(least, times):
    r = random.Random(least * 10 + times)
    for _ in range(400):
        t = odd_words(r)
        want = plain_runs(t, least, times)
        assert periods.runs_of(t, least, times) == want
        assert periods.word_runs([f"w{x}" for x in t], least, times) == want


def test_few_words_are_compared():
    """Fibonacci, Thue-Morse, periodic and random sequences: no more than three comparisons a word, in either order."""
    fib, other = [0], [0, 1]
    while len(other) < 20_000:
        fib, other = other, other + fib
    r = random.Random(4)
    made = [other[:20_000], [bin(i).count("1") & 1 for i in range(20_000)], [0] * 20_000, [0, 1, 0] * 6_000, [r.randrange(2) for _ in range(20_000)], ([0] * 99 + [1]) * 200, list(range(140)) * 140, (([0] * 9 + [1]) * 9 + [2]) * 220]
    for t in made:
        for order in (t, [-x for x in t]):
            work = []
            assert sum(1 for _ in periods.lyndon_edges(order, work)) < len(t)
            assert work[0] <= 3 * len(t)


def test_runs_of_a_very_long_text():
    words = prose(5, 30).split() * 20_000
    assert periods.word_runs(words) == [(0, 600_000, 30)]
    assert periods.collapsed(words, [(0, 600_000, 30)]) == words[:30]


def test_periodic_runs_query(spark, folder, rows):  # noqa: F811
    def plain(doc, text):
        w = WORD.findall(text or "")
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        found = []
        for q in range(1, len(w) // 3 + 1):  # stretches of equal words q apart
            same = np.flatnonzero(np.array(w[:-q], object) != np.array(w[q:], object))
            edges = np.r_[-1, same, len(w) - q]
            for a, b in zip(edges[:-1] + 1, edges[1:], strict=True):
                n = int(b - a) + q
                if b > a and n >= max(24, 3 * q) and not any(q % d == 0 and all(w[a + k] == w[a + k + d] for k in range(n - d)) for d in range(1, q)):
                    found.append((int(a), n, q))
        found.sort()
        gone = {i for a, n, q in found for i in range(a + q, a + n)}
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if found else (None, None, None)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        return (doc, len(found), *best, 1000 * best[1] // best[2] if found else None, digest("".join(f"{a},{n},{q}\n" for a, n, q in found)), digest(" ".join(x for i, x in enumerate(w) if i not in gone)))

    got = Counter(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, folder).where("doc_id is not null").collect())
    want = Counter(plain(doc, text) for doc, text, *_ in rows if doc is not None)
    assert got == want and sum(1 for r in want if r[1]) > 5


def test_runs_of_awkward_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, "a " * 24), (4, "a " * 24), (None, "x y " * 12), (5, "a " * 23), (6, "b " * 5_000)], "doc_id long, text string").withColumns({c: F.lit(1) for c in ("words", "runs", "n_runs")})
    got = sorted(((r.doc_id or 0, r.n_runs, r.start, r.length, r.period, r.exponent_milli, bytes(r.words)) for r in periods.periodic_runs(df).collect()), key=str)
    none = (None, None, None, None)
    assert got == [(0, 1, 0, 24, 2, 12000, b"x y"), (1, 0, *none, b""), (2, 0, *none, b""), (3, 0, *none, b""), (4, 1, 0, 24, 1, 24000, b"a"), (4, 1, 0, 24, 1, 24000, b"a"), (5, 0, *none, b" ".join([b"a"] * 23)), (6, 1, 0, 5000, 1, 5_000_000, b"b")]
    assert periods.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.periodic_runs(df, periods=1)


def plain_buckets(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def test_feature_hashes():
    made = [None, "", "One two", "a1 b_c", "naïve 日本語 ＡＢＣ y z \x85q", prose(8, 300), "-".join(["ab" * n for n in (1, 20, 23, 24, 25, 26, 40, 3000, 7)]), "z" * 48 + " " + "z" * 49 + " q " + "z" * 47, " . "]
    for t in texts(pa.array(made)):
        w, at, found = importance.features(t)
        for i, text in enumerate(made):
            n, want = plain_buckets(text)
            assert w.count[i] == n and sorted(found[at == i].tolist()) == sorted(want), text


def test_importance_query(spark, folder, rows, tmp_path):  # noqa: F811
    target = ["the " + prose(3, 60), None, "", prose(21, 40) + " TION the of"]
    spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet", mode="overwrite")
    s, t = Counter(), Counter()
    docs = [(doc, *plain_buckets(text)) for doc, text, *_ in rows]
    for _, _, found in docs:
        s.update(found)
    for text in target:
        t.update(plain_buckets(text)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000)))) for b in range(10_000)}
    want = []
    for doc, n, found in docs:
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{doc}".encode()).hexdigest()[:8], 16)
        want.append((doc, n, len(found), weight, None if doc is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((-score, doc) for doc, n, _, _, score in want if n >= 20 and doc is not None)
    rank = {(doc, -score): i + 1 for i, (score, doc) in reversed(list(enumerate(fit[: 5 * len(fit) // 100])))}
    got = QUERIES["op12_importance_resampling"](spark, folder).collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter((doc, n, weight, score) for doc, _, n, weight, score in want)
    assert {(r.doc_id, r.score): r["rank"] for r in got if r["rank"]} == rank and len(rank) >= 5
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(rank) + 1))


def test_importance_of_awkward_rows(spark):
    base = spark.createDataFrame([(1, None), (None, "a b " * 20), (2, "a b " * 20), (2, "a b " * 20), (3, "a b " * 20), (4, "few")], "doc_id long, text string").withColumns({c: F.lit("x") for c in ("score", "rank", "__place")})
    none = base.limit(0)
    got = importance.resample(base, base.where("doc_id = 4"), percent=100).collect()
    assert len(got) == 6 and sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3]
    assert all(r.score is None and r["rank"] is None and r.weight != 0 for r in got if r.doc_id is None)
    assert [(r.n_features, r.weight) for r in got if r.doc_id == 1] == [(0, 0)]
    assert importance.resample(none, base).count() == 0
    assert importance.resample(base, none).count() == 6
    assert {r["rank"] for r in importance.resample(base, base, percent=5).collect()} == {None}


def test_ranks_are_exact_over_many_ranges(spark):
    df = spark.range(5_000).withColumn("score", F.col("id") * 7919 % 641).repartition(13)
    got = importance.ranked(df, [F.desc("score"), F.col("id")], 3_000).collect()
    want = sorted(range(5_000), key=lambda i: (-(i * 7919 % 641), i))
    assert {r["rank"]: r.id for r in got if r["rank"]} == dict(enumerate(want[:3_000], 1)) and len(got) == 5_000


def shingles(text, size=3):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def plain_components(rows, percent=90):  # noqa: F811
    """(doc, size of its set, component) of each row: all pairs that share a shingle, then merging."""
    sets = [shingles(text) for _, text in rows]
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (doc, _) in enumerate(rows):
        for j, n in Counter(j for x in sets[i] for j in where[x] if j < i).items():
            if doc is not None and rows[j][0] is not None and (100 * n >= percent * (len(sets[i]) + len(sets[j]) - n) or doc == rows[j][0]):
                top[root(i)] = root(j)
        for j in range(i):
            if doc is not None and doc == rows[j][0] and sets[i] and sets[j]:
                top[root(i)] = root(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[root(i)] = min(low.get(root(i), doc), doc)
    return Counter((doc, len(sets[i]), None if doc is None else low[root(i)] if sets[i] else doc) for i, (doc, _) in enumerate(rows))


def test_jaccard_query(spark, folder, rows):  # noqa: F811
    got = Counter(tuple(r) for r in QUERIES["op13_ngram_jaccard_join"](spark, folder).collect())
    assert got == plain_components([r[:2] for r in rows])


@pytest.mark.parametrize(("small", "length", "counters"), [(64, 16_384, 1 << 18), (1, 7, 4), (9, 5, 64)])
def test_jaccard_of_groups(spark, monkeypatch, small, length, counters):
    """Chains, large groups of near copies at and under the threshold, a passage in every text; small lists and parts."""
    monkeypatch.setattr(jaccard, "SMALL", small), monkeypatch.setattr(jaccard, "LIST", length)
    r, made = random.Random(13), []
    passage = prose(99, 30).split()
    for g in range(4):
        base = prose(100 + g, r.choice([60, 120, 200])).split()
        for k in range(40):
            w = list(base) if g < 3 else list(made[-1]) if k else list(base)  # the last group is a chain
            for _ in range(r.randrange(0, max(2, len(w) // 25)) if g < 3 else 2):
                w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
            if r.random() < 0.3:
                del w[: r.randrange(4)]
            made.append(w)
    made += [[*prose(500 + i, r.randrange(40)).split(), *passage] for i in range(40)]
    docs = [(i * 3 % 1000, " ".join(w)) for i, w in enumerate(made)]
    docs += [(docs[5][0], docs[90][1]), (7777, None), (7778, "one two"), (7779, "ONE  two"), (None, docs[0][1]), (7780, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"n": F.lit("x"), "node": F.lit(1), "hashes": F.lit(2)}).repartition(5)
    monkeypatch.setattr(jaccard.shingle_levels, "__defaults__", (counters,))
    got = Counter(tuple(x) for x in jaccard.jaccard_groups(df).collect())
    assert got == plain_components(docs)


def test_jaccard_of_awkward_rows(spark):
    df = spark.createDataFrame(awkward(), SCHEMA)
    got = Counter(tuple(r) for r in jaccard.jaccard_groups(df).collect())
    assert got == plain_components([x[:2] for x in awkward()])
    assert jaccard.jaccard_groups(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        jaccard.jaccard_groups(df, percent=50)


def test_blocks_that_are_left():
    """Rows that are skipped can't reach the similarity, whatever the rest of both sets."""
    r = random.Random(2)
    for _ in range(300):
        n, percent = r.randrange(1, 60), r.choice([80, 90])
        p = r.randrange(jaccard.prefix_length(n, 90))
        rest = sorted((m := r.randrange(1, 70), r.randrange(jaccard.prefix_length(m, 90))) for _ in range(30))
        size, at = np.array(rest).T
        begin = np.r_[np.flatnonzero(np.r_[True, size[1:] != size[:-1]]), len(size)]
        left = set(jaccard.unskipped(n, p, size[begin[:-1]], begin, at, percent).tolist())
        for i, (m, q) in enumerate(rest):
            most = min(n - p, m - q)
            assert (i in left) == (100 * most >= percent * (n + m - most))
