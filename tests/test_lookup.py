"""Lookups in caches that have a source several times."""

from textflow.operators import lookup


def test_a_doubled_source_multiplies_nothing(spark):
    cache = spark.createDataFrame([("a", "A1", 1), ("a", "A2", 3), ("a", "A0", 2), ("b", "B", 1)], "source string, target string, seq long")
    rows = spark.createDataFrame([(1, "b", ["a", "a"]), (2, "a", []), (3, "z", ["a"])], "id long, q string, l array<string>")
    got = {r.id: (r.q, r.l) for r in lookup.all_or_nothing(rows, "id", ["q"], ["l"], cache).collect()}
    assert got == {1: ("B", ["A2", "A2"]), 2: ("A2", [])}
    got = {r.id: (r.q, r.l) for r in lookup.all_or_nothing(rows, "id", ["q"], ["l"], cache.drop("seq")).collect()}
    assert got == {1: ("B", ["A2", "A2"]), 2: ("A2", [])}
    texts = spark.createDataFrame([("a",), ("b",), ("a",), ("z",)], "source string")
    none = texts.limit(0)
    log = spark.createDataFrame([], "source string, target string, status string, seq long")
    got = sorted(tuple(r) for r in lookup.translation_map(texts, none, cache, log).collect())
    assert got == [("a", "A2", "cache"), ("b", "B", "cache"), ("z", None, "missing")]
    assert sorted((r.source, r.target) for r in lookup.cached(texts, cache).collect()) == [("a", "A2"), ("a", "A2"), ("b", "B"), ("z", None)]
