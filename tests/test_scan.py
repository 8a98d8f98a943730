"""Scans in two phases against the window by key."""

import random

import pytest
from pyspark.sql import functions as F

from textflow.operators import scan


@pytest.fixture(scope="module")
def turns(spark):
    r = random.Random(6)
    rows = [(7, t, f"a{t}") for t in range(0, 9000) if r.random() < 0.6] + [(d, t, "b") for d in range(40) for t in range(r.randrange(30)) if d != 7 and r.random() < 0.7]
    rows += [(None, t, "n") for t in (1, 2, 9)] + [(8, 3, "twice"), (8, 3, "twice")]
    return spark.createDataFrame(rows, "dialogue_id long, turn long, x string").repartition(5).persist()


def spread(df, key):
    rows = df.select("dialogue_id", "n", F.spark_partition_id().alias("p")).collect()
    return len({r.p for r in rows if r.dialogue_id == key})


def test_numbers(spark, turns):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        window, scanned = (scan.numbered(turns, ["dialogue_id"], ["turn"], "n", long) for long in (1 << 40, 100))
        key = lambda df: sorted(map(str, df.collect()))
        assert key(window) == key(scanned) and scanned.columns == [*turns.columns, "n"]
        assert spread(window, 7) == 1 < spread(scanned, 7)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("gap", [0, 1, 2, 50])
def test_groups_by_gaps(turns, gap):
    window, scanned = (scan.gap_groups(turns, ["dialogue_id"], "turn", gap, "g", long) for long in (1 << 40, 100))
    assert sorted(map(str, window.collect())) == sorted(map(str, scanned.collect()))
    assert dict(scanned.dtypes) == dict(window.dtypes)


def test_nothing(turns):
    none = turns.limit(0)
    assert scan.numbered(none, ["dialogue_id"], ["turn"], "n", -1).count() == 0 and scan.gap_groups(none, ["dialogue_id"], "turn", 1, "g", -1).count() == 0
