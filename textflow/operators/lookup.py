"""Lookups, caches and logs: first-wins and last-wins by an explicit sequence, and calls made once for each distinct text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row for each key, the first by seq. Partial aggregation: a frequent key is combined before the shuffle."""
    return _pick(df, keys, seq, F.min_by)


def last_wins(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    return _pick(df, keys, seq, F.max_by)


def _pick(df: DataFrame, keys: list[str], seq: str, by: Callable) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(by(F.struct(*rest), F.col(seq)).alias("row")).select(*keys, "row.*")


def latest(cache: DataFrame) -> DataFrame:
    """One row (source, target) for each source of a cache that may have it several times: by seq, where there is such a column,
    the last wins; without it the largest target does."""
    if "seq" in cache.columns:
        return last_wins(cache.select("source", "target", "seq"), ["source"], "seq").select("source", "target")
    return cache.groupBy("source").agg(F.max("target").alias("target"))


def cached(items: DataFrame, cache: DataFrame, key: str = "source") -> DataFrame:
    """items with target and hit from the latest() of cache."""
    found = items.join(latest(cache).select(F.col("source").alias(key), "target"), key, "left")
    return found.withColumn("hit", F.col("target").isNotNull())


def pending(items: DataFrame, *done: DataFrame, key: str = "source") -> DataFrame:
    """Distinct keys of items that are in none of the tables done."""
    out = items.select(key).where(F.col(key).isNotNull()).distinct()
    for other in done:
        out = out.join(other.select(key), key, "left_anti")
    return out


def translation_map(texts: DataFrame, skipped: DataFrame, cache: DataFrame, log: DataFrame) -> DataFrame:
    """texts (source) -> source, target, origin: skipped texts keep themselves, then the latest() of cache counts, then the log's last
    row (source, target, status, seq) if it was accepted; origin is failed if that was all there is, else missing."""
    last = last_wins(log, ["source"], "seq").select("source", F.col("target").alias("log_target"), "status")
    out = texts.select("source").distinct().join(skipped.select("source").distinct().withColumn("skip", F.lit(True)), "source", "left")
    out = out.join(latest(cache).withColumnRenamed("target", "cache_target"), "source", "left").join(last, "source", "left")
    skip, accepted = F.coalesce("skip", F.lit(False)), F.when(F.col("status") == "accepted", F.col("log_target"))
    target = F.coalesce(F.when(skip, F.col("source")), "cache_target", accepted)
    origin = F.when(skip, "skip").when(F.col("cache_target").isNotNull(), "cache").when(accepted.isNotNull(), "log").when(F.col("status") == "failed", "failed").otherwise("missing")
    return out.select("source", target.alias("target"), origin.alias("origin"))


def overlay(*layers: DataFrame) -> DataFrame:
    """(source, target) tables over each other, later ones on top."""
    rows = layers[0].select("source", "target", F.lit(0).alias("layer"))
    for i, layer in enumerate(layers[1:], 1):
        rows = rows.unionByName(layer.select("source", "target", F.lit(i).alias("layer")))
    return rows.groupBy("source").agg(F.max_by("target", "layer").alias("target"))


def backfill(cache: DataFrame, log: DataFrame) -> DataFrame:
    """cache (source, target), its gaps filled with the log's last non-empty target whatever its status."""
    last = last_wins(log.where("trim(coalesce(target, '')) <> ''").select("source", "target", "seq"), ["source"], "seq").select("source", "target")
    return cache.select("source", "target").unionByName(last.join(cache.select("source"), "source", "left_anti"))


def misses(items: DataFrame, cache: DataFrame) -> DataFrame:
    return items.join(cache.select("source"), "source", "left_anti")


def all_or_nothing(rows: DataFrame, key: str, fields: list[str], lists: list[str], cache: DataFrame) -> DataFrame:
    """rows with every field and every list element replaced by its target in the latest() of cache; a row with a miss is left out.
    Empty cells translate to themselves."""
    cells = [F.struct(F.lit(f).alias("field"), F.lit(0).alias("pos"), F.coalesce(f, F.lit("")).alias("source")) for f in fields]

    def elements(name: str) -> Column:
        return F.transform(F.coalesce(name, F.array().cast("array<string>")), lambda x, i: F.struct(F.lit(name).alias("field"), i.alias("pos"), F.coalesce(x, F.lit("")).alias("source")))

    parts = [F.array(*cells), *map(elements, lists)]
    flat = rows.select(key, F.explode(F.concat(*parts)).alias("c")).select(key, "c.*")
    found = flat.join(latest(cache), "source", "left").withColumn("target", F.when(F.col("source") == "", "").otherwise(F.col("target")))
    values = [F.max(F.when(F.col("field") == f, F.col("target"))).alias(f) for f in fields]
    values += [F.transform(F.array_sort(F.collect_list(F.when(F.col("field") == c, F.struct("pos", "target")))), lambda x: x["target"]).alias(c) for c in lists]
    return found.groupBy(key).agg(F.bool_and(F.col("target").isNotNull()).alias("whole"), *values).where("whole").drop("whole")


def append_new(base: DataFrame, new: DataFrame, key: str = "text") -> DataFrame:
    """base and those distinct keys of new that it doesn't have."""
    return base.select(key).unionByName(new.select(key).where(F.col(key).isNotNull()).distinct().join(base.select(key), key, "left_anti"))


def once_for_each(items: DataFrame, key: str, call: Callable[[DataFrame], DataFrame], done: DataFrame | None = None) -> DataFrame:
    """items with the columns that `call` adds, called on the distinct keys only, without those of `done` (same columns)."""
    todo = items.select(key).where(F.col(key).isNotNull()).distinct()
    results = call(todo if done is None else todo.join(done.select(key), key, "left_anti"))
    results = results if done is None else done.select(*results.columns).unionByName(results)
    return items.join(results, key, "left")


def zipped(a: DataFrame, b: DataFrame, keys: list[str], left: str, right: str) -> DataFrame:
    """Elements of two array columns by position, to the shorter length: keys, pos, left, right."""
    one = a.select(*keys, F.posexplode(left).alias("pos", "left"))
    return one.join(b.select(*keys, F.posexplode(right).alias("pos", "right")), [*keys, "pos"])


def failed_sources(log: DataFrame, key: str = "source") -> DataFrame:
    """The distinct keys with any row of the log (status) that wasn't accepted; a row without a status counts as such."""
    return log.where(F.coalesce(F.col("status") != "accepted", F.lit(True))).select(key).distinct()
