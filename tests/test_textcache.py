"""Lookups in a bucketed cache: no exchange on its side, frequent texts split, texts compared where digests collide."""

import re

import pytest
from pyspark.sql import functions as F

from textflow.operators import lookup, textcache


@pytest.fixture
def table(spark):
    cache = spark.createDataFrame([(f"t{i}", f"T{i}", 1) for i in range(300)] + [("t1", "newer", 2), ("ok", "OK", 1), (None, "x", 1), ("none", None, 1)], "source string, target string, seq int")
    textcache.save(cache, "cache_by_text", 8)
    yield cache
    spark.sql("DROP TABLE cache_by_text")


def test_rows_are_those_of_the_plain_join(spark, table):
    items = spark.createDataFrame([(i, f"t{i % 400}") for i in range(900)] + [(-i, "ok") for i in range(5000)] + [(7, None), (8, ""), (9, "none")], "id long, source string").withColumns({"target": F.lit("old"), "hit": F.lit(1)}).repartition(6)
    want = sorted(map(str, lookup.cached(items.drop("target", "hit"), table).select("id", "source", "target", "hit").collect()))
    for least in (1000, 1, 1 << 40):  # one frequent text, many, none
        got = textcache.looked_up(items, "cache_by_text", parts=200, least=least)
        assert sorted(map(str, got.select("id", "source", "target", "hit").collect())) == want
    assert {r.source for r in textcache.missed(items, "cache_by_text").collect()} == {f"t{i}" for i in range(300, 400)} | {None, "", "none"}


def test_plan_and_spread(spark, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1"), spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        items = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, "ok").otherwise(F.concat(F.lit("t"), F.col("id") % 300)).alias("source"))
        found = textcache.looked_up(items, "cache_by_text")
        plan = found._jdf.queryExecution().executedPlan().toString()
        merge = plan[plan.index("SortMergeJoin") :]
        cache_side = re.split(r"\n\s*[:+ ]*\+- ", merge)
        scan = next(i for i, line in enumerate(cache_side) if "FileScan parquet" in line and "Bucketed: true" in line)
        above = [line.split(" ")[0] for line in cache_side[max(0, scan - 4) : scan]]
        assert not any("Exchange" in x for x in above), above
        assert "SelectedBucketsCount: 8 out of 8" in plan
        most = found.where("source = 'ok'").select("id", "target", F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(most) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"), spark.conf.unset("spark.sql.adaptive.enabled")


def test_colliding_digests(spark, monkeypatch):
    monkeypatch.setattr(textcache, "digest", lambda c: F.when(c.isNotNull(), F.lit(b"\1" * 16)))
    cache = spark.createDataFrame([("a", "A"), ("b", "B")], "source string, target string")
    textcache.save(cache, "cache_collisions", 2)
    try:
        items = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("a",)], "source string")
        for least in (0, 1000):
            got = sorted((str(r.source), r.target) for r in textcache.looked_up(items, "cache_collisions", least=least).collect())
            assert got == [("None", None), ("a", "A"), ("a", "A"), ("b", "B"), ("c", None)]
    finally:
        spark.sql("DROP TABLE cache_collisions")
    with pytest.raises(ValueError):
        spark.range(1).write.saveAsTable("plain_table")
        try:
            textcache.bucket_count(spark, "plain_table")
        finally:
            spark.sql("DROP TABLE plain_table")
