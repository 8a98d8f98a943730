"""Turns of dialogues: clusters of nearby turns with redacted slots, slots within them, context around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textflow.functions import synth, text
from textflow.operators import scan

GAP = 3


def clusters(turns: DataFrame, has: Column, gap: int = GAP) -> DataFrame:
    """The turns that meet `has`, with cluster_idx (from 0 in each dialogue_id): a turn no more than `gap` after the one
    before is in the same cluster. Long dialogues are scanned by several tasks."""
    rows = scan.gap_groups(turns.where(has), ["dialogue_id"], "turn", gap, "cluster_idx")
    return rows.withColumn("cluster_id", F.concat_ws("", F.col("dialogue_id").cast("string"), F.lit("_c"), F.col("cluster_idx").cast("string")))


def cluster_bounds(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("dialogue_id", "cluster_idx").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("*").alias("n_turns"))


def context(turns: DataFrame, clustered: DataFrame, window: int = 3) -> DataFrame:
    """Turns within `window` before a cluster's first or after its last turn: dialogue_id, cluster_idx, turn, side. Joined by
    turn numbers, so that a long dialogue's turns don't meet all its clusters."""
    around = F.concat(F.sequence(F.col("low") - window, F.col("low") - 1), F.sequence(F.col("high") + 1, F.col("high") + window))
    b = cluster_bounds(clustered).withColumn("turn", F.explode(around))
    near = turns.join(b, ["dialogue_id", "turn"])
    return near.select("dialogue_id", "cluster_idx", "turn", F.when(F.col("turn") < F.col("low"), "before").otherwise("after").alias("side"))


def slots(clustered: DataFrame, tokens: Column) -> DataFrame:
    """A row for each token of a clustered turn, with its number in the cluster (from 1) across turns."""
    rows = clustered.select("dialogue_id", "cluster_idx", "cluster_id", "turn", F.posexplode(tokens).alias("pos", "token"))
    return scan.numbered(rows, ["dialogue_id", "cluster_idx"], ["turn", "pos"], "token_index").withColumn("token_index", F.col("token_index").cast("int"))


def slot_hints(slots_: DataFrame, hint: Column) -> DataFrame:
    """slots with hint_type and a suggested synthetic value."""
    s = synth.seed(F.col("cluster_id"), F.col("turn"), F.col("token_index"), F.col("token"), F.col("hint_type"))
    rows = slots_.withColumn("hint_type", hint)
    return rows.withColumn("suggestion", synth.suggestion(F.col("token"), F.col("hint_type"), s)).select("*", "suggestion.policy", "suggestion.suggested_value").drop("suggestion")


def topic(clustered: DataFrame, hint: str = "hint_type") -> DataFrame:
    """The most frequent hint of each cluster; of equals the one seen first."""
    n = clustered.groupBy("dialogue_id", "cluster_idx", hint).agg(F.count("*").alias("n"), F.min("turn").alias("first"))
    return n.groupBy("dialogue_id", "cluster_idx").agg(F.max_by(hint, F.struct(F.col("n"), -F.col("first"))).alias("topic"))


def worst_status(rows: DataFrame, keys: list[str]) -> DataFrame:
    """failed over warning over accepted."""
    level = F.when(F.col("status") == "failed", 2).when(F.col("status") == "warning", 1).otherwise(0)
    return rows.groupBy(*keys).agg(F.element_at(F.array(F.lit("accepted"), F.lit("warning"), F.lit("failed")), F.max(level) + 1).alias("status"))


def scan_report(clustered: DataFrame, tokens: Column) -> DataFrame:
    """One row: clusters, turns, tokens, least, largest and mean cluster size."""
    each = clustered.groupBy("dialogue_id", "cluster_idx").agg(F.count("*").alias("n"), F.sum(F.size(tokens)).alias("t"))
    return each.agg(F.count("*").alias("clusters"), F.sum("n").alias("turns"), F.sum("t").alias("tokens"), F.min("n").alias("least"), F.max("n").alias("largest"), text.rounded(F.avg("n"), 2).alias("mean"))


def heaviest(clustered: DataFrame, tokens: Column, k: int = 20) -> DataFrame:
    return clustered.groupBy("dialogue_id").agg(F.sum(F.size(tokens)).cast("long").alias("tokens")).orderBy(F.desc("tokens"), "dialogue_id").limit(k)


def merge_back(turns: DataFrame, fills: DataFrame, tokens: Column) -> DataFrame:
    """turns with fills (dialogue_id, turn, filled, status): a fill counts if it was accepted or has a warning; turns with
    tokens but without a fill have failed, turns without tokens have no status."""
    rows = turns.join(fills.select("dialogue_id", "turn", "filled", F.col("status").alias("fill_status")), ["dialogue_id", "turn"], "left")
    status = F.when(F.size(tokens) > 0, F.coalesce("fill_status", F.lit("failed")))
    return rows.withColumn("fill_status", status).withColumn("filled", F.when(F.col("fill_status").isin("accepted", "warning"), F.col("filled")))


def chunked(df: DataFrame, keys: list[str], order: list[str], size: int) -> DataFrame:
    """df with batch: rows of each key in order, `size` to a batch, from 0."""
    rows = scan.numbered(df, keys, order, "__number")
    return rows.withColumn("batch", F.floor((F.col("__number") - 1) / size).cast("int")).drop("__number")


def skip_reason(content: Column, exact: list[str], patterns: list[str]) -> Column:
    """Why a turn isn't translated, null if it is: the first of empty, an exact entry, redactions only, a whole pattern."""
    bare = text.collapse(content)
    out = F.when(bare == "", "empty_content").when(F.upper(bare).isin([x.upper() for x in exact]), "exact_skip").when(text.redacted_only(content), "pattern_skip:sensitive_only_tokens")
    for p in patterns:
        out = out.when(bare.rlike(f"(?iU)^(?:{p})$"), f"pattern_skip:{p}")
    return out


def chosen(clustered: DataFrame, dialogue: int | None = None, most: int | None = None) -> DataFrame:
    """Clusters of one dialogue only, or the first `most` by dialogue and place."""
    rows = clustered if dialogue is None else clustered.where(F.col("dialogue_id") == dialogue)
    if most is None:
        return rows
    few = rows.select("dialogue_id", "cluster_idx").distinct().orderBy("dialogue_id", "cluster_idx").limit(most)
    return rows.join(F.broadcast(few), ["dialogue_id", "cluster_idx"], "left_semi")


def sampled_relations(items: DataFrame, limit: int = 20) -> DataFrame:
    """Candidates of groups (group_idx, role, idx) with skipped: a negative whose place among its group's candidates, positives
    first, is `limit` or later; 0 skips none."""
    w = Window.partitionBy("group_idx").orderBy(F.when(F.col("role") == "positive", 0).otherwise(1), "idx")
    place = F.row_number().over(w) - 1
    skipped = (F.lit(limit) > 0) & (F.col("place") >= limit) & (F.col("role") == "negative")
    return items.where("role <> 'query'").withColumn("place", place).withColumn("skipped", skipped).drop("place")


def fill_report(turns: DataFrame, fills: DataFrame, tokens: Column) -> DataFrame:
    """One row over turns and the fills of their redactions (status, filled, errors): how many turns have tokens, fills by
    status, accepted or with a warning, fills with tokens left, errors of personal shapes."""
    n = lambda s: F.count_if(F.col("status") == s)
    shapes = F.size(F.filter(F.coalesce("errors", F.array().cast("array<string>")), lambda x: x.startswith("pii_shape")))
    out = fills.agg(
        n("accepted").alias("accepted"), n("warning").alias("warning"), n("failed").alias("failed"), F.count_if(F.col("status").isin("accepted", "warning")).alias("filled"),
        F.count_if(text.redacted_count(F.col("filled")) > 0).alias("tokens_left"), F.coalesce(F.sum(shapes), F.lit(0)).cast("long").alias("personal_shapes"),
    )
    return turns.agg(F.count_if(F.size(tokens) > 0).alias("turns_with_tokens")).crossJoin(out)  # one row each


def cluster_tokens(clustered: DataFrame, tokens: Column) -> DataFrame:
    """Turns and tokens of each cluster."""
    return clustered.groupBy("dialogue_id", "cluster_idx").agg(F.count("*").alias("turns"), F.sum(F.size(tokens)).cast("long").alias("tokens"))


def hint_histogram(clustered: DataFrame, hint: Column) -> DataFrame:
    """How many clustered turns have each hint."""
    return clustered.groupBy(hint.alias("hint")).agg(F.count("*").alias("n"))
