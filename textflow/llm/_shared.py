"""Shared folders and cut tables (from textflow.sources.shared), and joins with hot groups."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.sources.shared import cut, new_path, qualified, remove, shared_dir, small_side

__all__ = ["cut", "new_path", "qualified", "remove", "rows_a_batch", "shared_dir", "small_side", "with_group"]


@contextmanager
def rows_a_batch(spark: SparkSession, n: int) -> Iterator[None]:
    """Arrow batches of up to n rows for what is executed inside: for rows of many bytes, of which Spark's 10,000 don't fit."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(n, int(before)) if int(before) > 0 else n)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def with_group(rows: DataFrame, groups: DataFrame, keys: list[str], spread: Column, values: list[str], parts: int = 200) -> DataFrame:
    """rows with the values of their group, null where there is none; groups (keys, values, n) has one row for each, n being
    its number of rows. Groups with more than 1 / parts of all rows (so fewer than `parts`) come by broadcast, and their rows
    get keys of their own, by `spread`, for the shuffled join with the others: no key burdens a task."""
    limit = max(1000, rows.count() // parts)
    key = F.concat_ws("|", *keys)
    hot = groups.where(F.col("n") > limit).select(key.alias("__group_key"), F.struct(*values).alias("__group_hot"))
    cold = groups.where(F.col("n") <= limit).select(key.alias("__group_key"), F.struct(*values).alias("__group_cold"))
    near = rows.withColumn("__group_key", key).join(F.broadcast(hot), "__group_key", "left")
    near = near.withColumn("__group_key", F.when(F.col("__group_hot").isNull(), F.col("__group_key")).otherwise(F.concat(F.lit("#"), F.coalesce(spread.cast("string"), F.lit("")))))
    found = F.coalesce("__group_hot", "__group_cold")
    return near.join(cold, "__group_key", "left").select(*(near[c] for c in rows.columns), *(found[v].alias(v) for v in values))
