"""Dictionaries: the automaton against plain search, masking against a fold of regular expressions, one plan for 100,000 names."""

import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textflow.functions import automaton
from textflow.functions import text as T
from textflow.functions.automaton import Automaton
from textflow.operators import dictionary, rules
from textflow.operators.rules import Rules

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def plain_find(words, texts, fold):
    change = (lambda x: x.encode().translate(_LOWER)) if fold else str.encode
    return {(i, m.start(), k) for i, t in enumerate(texts) for k, w in enumerate(words) if w for m in re.finditer(b"(?=" + re.escape(change(w)) + b")", change(t or ""))}


def found(words, texts, fold):
    a, out = Automaton(words, fold), set()
    for first, _, begin, row, start, word in a.find(pa.array(texts, pa.string())):
        out |= {(first + int(r), int(s - begin[r]), k) for r, s, w in zip(row, start, word, strict=True) for k in a.members[w]}
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abAé日 ", max_size=5), max_size=9), st.lists(st.one_of(st.none(), st.text("abAé日 ", max_size=70)), max_size=6), st.booleans(), st.sampled_from([4, 512]))
def test_automaton(words, texts, fold, chunk):
    old, automaton.CHUNK = automaton.CHUNK, chunk
    try:
        assert found(words, texts, fold) == plain_find(words, texts, fold)
    finally:
        automaton.CHUNK = old


def test_pieces_and_long_words(monkeypatch):
    monkeypatch.setattr(automaton, "PIECE", 50)
    texts = ["x" * 200 + "needle", None, "", "a needle", "nee", "dle"] * 3
    assert found(["needle", "x" * 150, "e"], texts, False) == plain_find(["needle", "x" * 150, "e"], texts, False)
    monkeypatch.setattr(automaton, "MOST_BYTES", 10)
    with pytest.raises(ValueError):
        Automaton(["longer than ten"])


def plain_mask(text, names):
    """The fold: names in order, each replaced wherever it stands in the text as masked so far; marks themselves are left alone."""
    parts, out = [text], []  # every second part is a mark
    for i, name in enumerate(names):
        body = re.escape(name)
        pattern = f"(?ai:(?<![A-Za-z]){body}(?![A-Za-z]))" if dictionary.needs_edges(name) else f"(?ai:{body})"
        new, hit = [], False
        for k, part in enumerate(parts):
            if k % 2:
                new.append(part)
                continue
            pieces = re.split(pattern, part)
            hit |= len(pieces) > 1
            for j, piece in enumerate(pieces):
                new += [f"<ENT_{i:02d}>", piece] if j else [piece]
        parts = new
        if hit:
            out.append(name)
    return "".join(parts), out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("aBc +", min_size=1, max_size=6), max_size=8), st.lists(st.text("aAbBcC +é", max_size=50), max_size=5))
def test_masking(names, texts):
    names = dictionary.masking_order(names)
    got = dictionary.Mask(names)(pa.array(texts, pa.string())).to_pylist()
    assert [(r["masked"], r["found"]) for r in got] == [plain_mask(t, names) for t in texts]


def test_a_hundred_thousand_names(spark):
    """The plan has one projection and the rows are those of the fold over the names that are there."""
    r = random.Random(5)
    syllables = ["ka", "lo", "mi", "ter", "an", "du", "sor", "Pe", "qui", "VEX"]
    names = list({"".join(r.choice(syllables) for _ in range(r.randrange(3, 7))) + (" Group" if r.random() < 0.3 else "") for _ in range(130_000)})[:100_000]
    texts = [" ".join(r.choice(names) if r.random() < 0.1 else "".join(r.choice(syllables) for _ in range(r.randrange(1, 4))) for _ in range(60)) for _ in range(40)] + [None, "", "none"]
    pack = Rules(entities=tuple(names))
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    out = rules.mask_entities(df, "t", pack)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and len(plan) < 5_000
    rows = {x.id: x for x in out.withColumn("back", rules.restore_entities(F.col("masked"), pack)).collect()}
    for i, t in enumerate(texts):
        low = (t or "").lower()
        there = [n for n in pack.longest_first if n.lower() in low]
        number = {n: k for k, n in enumerate(pack.longest_first)}
        masked, some = plain_mask(t or "", there)
        masked = re.sub(r"<ENT_(\d+)>", lambda m, there=there: f"<ENT_{number[there[int(m[1])]]:02d}>", masked)
        assert (rows[i].masked, rows[i].entities) == (masked, some)
        assert rows[i].back.lower() == low


def test_groups_and_lost_names(spark):
    groups = {"one": ["abc", "x"], "two": ["abc", "bcd"], "none": [""], "edge": ["of"]}
    df = spark.createDataFrame([("abcd",), ("often of",), ("often",), (None,), ("x",)], "t string").coalesce(1)
    got = [r[0] for r in df.select(dictionary.groups_in(F.col("t"), groups, edges=lambda w: w == "of")).collect()]
    assert got == [["one", "two"], ["edge"], [], [], ["one"]]
    assert [r[0] for r in df.select(dictionary.groups_in(F.col("t"), {})).collect()] == [[]] * 5
    wanted = spark.createDataFrame([(["B", "A", "Z"], "a here"), (["B", "A"], "zet"), (None, "x"), (["A"], None)], "w array<string>, t string").coalesce(1)
    got = [tuple(r[0]) for r in wanted.select(dictionary.lost_names(F.col("w"), F.col("t"), ["A", "B"], {"B": ["zet"]})).collect()]
    assert got == [(["B"], []), (["A"], ["B"]), ([], []), (["A"], [])]


def test_names_from_a_table(spark, monkeypatch):
    df = spark.createDataFrame([("bb",), ("a",), ("bb",), (None,), ("",), ("ccc",)], "name string")
    assert dictionary.names_of(df) == ["ccc", "bb", "a"]
    monkeypatch.setattr(automaton, "MOST_BYTES", 3)
    with pytest.raises(ValueError):
        dictionary.names_of(df)


def test_lexicons_are_one_word_list_for_the_expression_and_the_automaton(spark):
    """word_pattern(), which single names still use, and the automaton agree on what counts as a name."""
    names = ["GNU", "BSD license", "MIT", "Apache"]
    texts = ["GNU GNUs (gnu) aGNU", "bsd LICENSEs", "MITx MIT", "apacheX", "ΜΙΤ"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    want = {r.id: [n for n, x in zip(names, r[1:], strict=True) if x] for r in df.select("id", *(F.col("t").rlike(T.word_pattern(n)) for n in names)).collect()}
    got = {r.id: sorted(r.found, key=names.index) for r in df.select("id", dictionary.masked(F.col("t"), names)["found"].alias("found")).collect()}
    assert got == want
