"""A keyed cache as state: restarts, replays, expiry, and what a batch costs."""

import shutil
from datetime import datetime

from pyspark.sql import functions as F

from textflow.streaming import cache

SCHEMA = "source string, seq int, target string, ts timestamp"


def at(minute):
    return datetime(2024, 1, 1, 0, minute)


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, **kw):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    cache.follow(stream, str(tmp_path / "out"), str(tmp_path / "progress"), ["source"], "seq", **kw).awaitTermination()
    found = cache.current(spark, str(tmp_path / "out"), ["source"])
    return {(r.source, r.target) for r in found.collect()}


def test_state_over_restarts_and_replays(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    assert cache.current(spark, out, ["source"]) is None
    put(spark, folder, [("a", 1, "x", at(0)), ("b", 1, "y", at(0)), ("a", 0, "old", at(0)), (None, 1, "n", at(0)), ("q", None, "none", at(0))])
    assert run(spark, tmp_path) == {("a", "x"), ("b", "y"), (None, "n")}
    put(spark, folder, [("a", 2, "z", at(1)), ("b", 0, "late", at(1)), ("b", 1, "same", at(1))])
    assert run(spark, tmp_path) == {("a", "z"), ("b", "y"), (None, "n")}  # another query, from the checkpoint
    second = spark.read.parquet(f"{out}/version={cache.versions(spark, out)[-1]}")
    assert [(r.source, r.target) for r in second.collect()] == [("a", "z")]  # a batch writes its own changes
    # the last batch is lost after its state was kept: its commit goes, it runs again from the state before it
    last = cache.versions(spark, out)[-1]
    shutil.rmtree(f"{out}/version={last}")
    for name in (str(last), f".{last}.crc"):
        (tmp_path / "progress" / "commits" / name).unlink()
    put(spark, folder, [("c", 1, "w", at(2))])
    assert run(spark, tmp_path) == {("a", "z"), ("b", "y"), ("c", "w"), (None, "n")}
    cache.compact(spark, out, ["source"])
    assert len(cache.versions(spark, out)) == 2
    assert {(r.source, r.target) for r in cache.current(spark, out, ["source"]).collect()} == {("a", "z"), ("b", "y"), ("c", "w"), (None, "n")}
    put(spark, folder, [("a", 1, "older", at(3)), ("c", 5, "new", at(3))])
    assert run(spark, tmp_path) == {("a", "z"), ("b", "y"), ("c", "new"), (None, "n")}


def test_keys_expire_by_the_watermark(spark, tmp_path):
    folder = str(tmp_path / "in")
    expire = {"ts": "ts", "expire": 10 * 60_000}
    put(spark, folder, [("a", 1, "x", at(0)), ("b", 1, "y", at(0))])
    run(spark, tmp_path, **expire)
    put(spark, folder, [("a", 2, "x2", at(8))])  # a's time starts again
    assert run(spark, tmp_path, **expire) == {("a", "x2"), ("b", "y")}
    put(spark, folder, [("c", 1, "z", at(15))])
    put(spark, folder, [("d", 1, "w", at(16))])
    assert run(spark, tmp_path, **expire) == {("a", "x2"), ("c", "z"), ("d", "w")}
    put(spark, folder, [("b", 1, "again", at(17))])  # a key that was forgotten is new
    assert ("b", "again") in run(spark, tmp_path, **expire)
    told = spark.read.parquet(str(tmp_path / "out")).where(F.col("expired")).collect()
    assert ("b", "y") in {(r.source, r.target) for r in told}
