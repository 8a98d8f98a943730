"""What goes to a model and what comes back: payloads as JSON, answers aligned with what was asked, styles of queries."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textflow.functions import text
from textflow.sources import shared


def batches(items: DataFrame, key: str, order: str, size: int, fields: list[str]) -> DataFrame:
    """items in batches of `size` by order within each key -> key, batch, n, payload (a JSON array in that order)."""
    numbered = items.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    rows = numbered.groupBy(key, F.floor((F.col("_n") - 1) / size).cast("int").alias("batch")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("_n", F.struct(*fields).alias("item")))).alias("x"))
    return rows.select(key, "batch", "n", F.to_json(F.transform("x", lambda x: x["item"])).alias("payload"))


def aligned(asked: DataFrame, answers: DataFrame, key: str = "item_id") -> DataFrame:
    """asked with the answers' target by key (the first of several by seq), and missing where there is none."""
    one = answers.groupBy(key).agg(F.min_by("target", "seq").alias("target"))
    return asked.join(one, key, "left").withColumn("missing", text.blank(F.col("target")))


def filled_turns(expected: DataFrame, response: DataFrame) -> DataFrame:
    """Turns to fill (cluster_id, turn, content) against a response (cluster_id, turn, filled) -> one row a cluster: turns
    (turn, content, filled) in order without empty ones, and error where a turn has no answer."""
    good = response.where(~text.blank(F.col("filled"))).groupBy("cluster_id", "turn").agg(F.max("filled").alias("filled"))
    rows = expected.join(good, ["cluster_id", "turn"], "left")
    turns = F.array_sort(F.collect_list(F.when(F.col("filled").isNotNull(), F.struct("turn", "content", "filled"))))
    lost = F.array_sort(F.collect_list(F.when(F.col("filled").isNull(), F.col("turn"))))
    out = rows.groupBy("cluster_id").agg(turns.alias("turns"), lost.alias("lost"))
    return out.select("cluster_id", "turns", F.when(F.size("lost") > 0, F.concat(F.lit("missing_turns:"), F.concat_ws(",", F.transform("lost", lambda x: x.cast("string"))))).alias("error"))


def valid_fill(original: Column, filled: Column) -> Column:
    """Why a fill can't count, null if it can: it is empty, or has as many redactions as before."""
    return F.when(text.blank(filled), "empty").when(text.redacted_count(filled) >= text.redacted_count(original), "not_reduced")


def styled(query: Column, style: Column, task: Column) -> Column:
    """A query as a model of a style wants it: instruct, prefix or task; plain otherwise."""
    return (
        F.when(style == "instruct", F.concat(F.lit("Instruct: "), task, F.lit("\nQuery: "), query))
        .when(style == "prefix", F.concat(F.lit("query: "), query))
        .when(style == "task", F.concat(F.lit("task: "), task, F.lit(" | query: "), query))
        .otherwise(query)
    )


def run_tag(spark: SparkSession, *paths: str, **config) -> str:
    """12 hex digits over the inputs' paths, times and sizes, wherever Spark finds them, and everything that a score depends on."""
    seen = []
    for name in paths:
        system, path = shared.hadoop_path(spark, name)
        status = system.getFileStatus(path)
        seen.append([name, status.getModificationTime(), system.getContentSummary(path).getLength()])
    return hashlib.sha1(json.dumps([seen, sorted(config.items())], default=str).encode()).hexdigest()[:12]


def to_fill(turns: DataFrame, source: str, target: str) -> DataFrame:
    """The turns whose redactions can be filled: text on both sides and a token at least in the target."""
    return turns.where(~text.blank(F.col(source)) & ~text.blank(F.col(target)) & (text.redacted_count(F.col(target)) > 0))


def sample(df: DataFrame, keys: list[str], value: str, n: int, seed: str = "0") -> DataFrame:
    """n rows of each key, in the order of a seeded hash of the value: equal on every run."""
    w = Window.partitionBy(*keys).orderBy(F.sha1(F.concat_ws("|", F.lit(seed), F.col(value))), value)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def capped(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """Each key's count, and its n smallest values."""
    w = Window.partitionBy(*keys).orderBy(value)
    few = df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("samples"))
    return df.groupBy(*keys).agg(F.count("*").alias("n")).join(few, keys)


def by_priority(triaged: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows to repair (P0, P1), rows that a rule change settles, rows to drop."""
    p = F.col("repair_priority")
    return triaged.where(p.isin("P0", "P1")), triaged.where(p == "RULE"), triaged.where(p == "P2_DROP")


def dropped(triaged: DataFrame, repaired: DataFrame) -> DataFrame:
    """What is given up: rows to drop, and negatives whose repair failed, with the reason."""
    lost = repaired.where("repair_status = 'failed' and role = 'negative'").select("item_id", F.lit("repair_failed").alias("reason"))
    return by_priority(triaged)[2].select("item_id", F.lit("low_value").alias("reason")).unionByName(lost)


def repair_summary(triaged: DataFrame, repaired: DataFrame) -> DataFrame:
    """One row over triaged items and repaired ones (repair_status): failed before, settled by a rule change, sent to repair,
    accepted, failed again, dropped."""
    p = F.col("repair_priority")
    n = lambda c: F.count_if(c)
    before = triaged.agg(F.count("*").alias("failed_before"), n(p == "RULE").alias("rule_false_positive"), n(p.isin("P0", "P1")).alias("sent_to_repair"), n(p == "P2_DROP").alias("low_value"))
    after = repaired.agg(n(F.col("repair_status") == "accepted").alias("repair_accepted"), n(F.col("repair_status") != "accepted").alias("repair_failed"), n((F.col("repair_status") == "failed") & (F.col("role") == "negative")).alias("lost"))
    return before.crossJoin(after).withColumn("dropped", F.col("low_value") + F.col("lost")).drop("low_value", "lost")  # one row each


def placeholder_summary(rows: DataFrame, before: str, after: str, failed: Column) -> DataFrame:
    """One row over texts before and after their placeholders were restored: fixed, still with one, still failing, all."""
    mark = lambda c: F.coalesce(F.col(c).rlike("(?i)<ENT[^>]*>"), F.lit(False))
    return rows.agg(F.count_if(mark(before) & ~F.col(before).eqNullSafe(F.col(after))).alias("fixed_items"), F.count_if(mark(after)).alias("still_with_placeholder"), F.count_if(failed).alias("still_bad"), F.count("*").alias("total_items"))
