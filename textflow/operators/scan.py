"""Running numbers along keys of any length, as a scan in two phases.

A window by key puts all rows of a key into one task. Here rows are sorted by ranges of key and order, and each range is numbered
by itself; a key that goes on from range to range, of which a range has two at most, gets what the ranges before it add up to.
These sums are a row or two for each range. Keys of up to LONG rows (counted) take the window, which gives the same rows.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textflow.sources.shared import cut

#: Rows of a key up to which one task numbers them.
LONG = 1_000_000


def longest(df: DataFrame, keys: list[str]) -> int:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def _ranges(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """df written by ranges of key and order, with __part, the number of its range. Rows that are equal in both are in one."""
    return cut(df.repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id()), "ranges")


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return functools.reduce(operator.and_, (a[k].eqNullSafe(b[f"__{k}"]) for k in keys)) & (a["__part"] == b["__p"])


def _carried(placed: DataFrame, sums: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """placed with `values`, made over the pieces (key, __part, ...) of each key that has several, in order."""
    several = sums.withColumn("__pieces", F.count("*").over(Window.partitionBy(*keys))).where("__pieces > 1")  # two rows a range at most
    carry = several.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__part").alias("__p"), *(c.alias(n) for n, c in values.items()))
    carry = F.broadcast(cut(carry, "carry"))
    return placed.join(carry, _same(placed, carry, keys), "left").drop("__p", *(f"__{k}" for k in keys))


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str, long: int | None = None) -> DataFrame:
    """df with `name`: the row's number in its key by order, from 1. Rows that are equal in both have any order."""
    if longest(df, keys) <= (LONG if long is None else long):
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    placed = _ranges(df, keys, order)
    sums = placed.groupBy(*keys, "__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    out = _carried(placed, sums, keys, {"__before": before})
    own = F.row_number().over(Window.partitionBy("__part", *keys).orderBy(*order))
    return out.withColumn(name, (own + F.coalesce("__before", F.lit(0))).cast("long")).drop("__part", "__before")


def gap_groups(df: DataFrame, keys: list[str], order: str, gap: int, name: str, long: int | None = None) -> DataFrame:
    """df with `name`: the number, from 0, of the row's group in its key; a row no more than `gap` after the one before it in order
    is in the same group."""
    if longest(df, keys) <= (LONG if long is None else long):
        w = Window.partitionBy(*keys).orderBy(order)
        new = F.when(F.col(order) - F.lag(order).over(w) <= gap, 0).otherwise(1)
        return df.withColumn("__new", new).withColumn(name, (F.sum("__new").over(w) - 1).cast("int")).drop("__new")
    placed = _ranges(df, keys, [order])
    w = Window.partitionBy("__part", *keys).orderBy(order)
    last = F.lag(order).over(w)
    placed = placed.withColumn("__new", F.when(last.isNull(), 0).when(F.col(order) - last <= gap, 0).otherwise(1))  # of a piece's first row: to come
    sums = placed.groupBy(*keys, "__part").agg(F.sum("__new").alias("__n"), F.min(order).alias("__first"), F.max(order).alias("__last"))
    pieces = Window.partitionBy(*keys).orderBy("__part")
    starts = F.when(F.col("__first") - F.lag("__last").over(pieces) <= gap, 0).otherwise(1)
    sums = sums.withColumn("__starts", starts)
    before = F.sum(F.col("__n") + F.col("__starts")).over(pieces.rowsBetween(Window.unboundedPreceding, -1))
    out = _carried(placed, sums, keys, {"__before": F.coalesce(before, F.lit(0)) + F.col("__starts") - 1})
    number = F.sum("__new").over(w) + F.coalesce("__before", F.lit(0))
    return out.withColumn(name, number.cast("int")).drop("__part", "__new", "__before")
