"""Reports of evaluation runs in long form: leaderboards, merges, regressions and cases that every run misses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten(reports: DataFrame) -> DataFrame:
    """Nested reports (ordinal, models map of struct(modes map of struct(summary))) -> ordinal, alias, mode, summary."""
    models = reports.select("ordinal", F.explode("models").alias("alias", "model"))
    return models.select("ordinal", "alias", F.explode("model.modes").alias("mode", "body")).select("ordinal", "alias", "mode", "body.summary", "body.eval_sec")


def merge(rows: DataFrame) -> DataFrame:
    """Partial reports (ordinal, alias, mode, ...): the last report wins for each alias and mode."""
    rest = [c for c in rows.columns if c not in ("alias", "mode")]
    return rows.groupBy("alias", "mode").agg(F.max_by(F.struct(*rest), "ordinal").alias("row")).select("alias", "mode", "row.*")


def summary(per_query: DataFrame, keys: list[str]) -> DataFrame:
    """Mean recall by run."""
    return per_query.groupBy(*keys).agg(*(F.avg(f"recall_{k}").alias(f"recall_{k}") for k in (1, 3, 5)), F.count("*").alias("queries"))


def leaderboard(summaries: DataFrame, keys: list[str]) -> DataFrame:
    """Runs by recall@1, then recall@3 (nulls as 0), then name."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return summaries.orderBy(F.desc(zero("recall_1")), F.desc(zero("recall_3")), *keys)


def against_reference(per_query: DataFrame, run: str, reference: str) -> DataFrame:
    """Queries whose hit at 1 differs from the reference run: query_id, run, change (gain or regression)."""
    ref = per_query.where(F.col(run) == reference).select("query_id", F.col("hit_1").alias("ref_hit"))
    other = per_query.where(F.col(run) != reference).join(ref, "query_id").where(F.col("hit_1") != F.col("ref_hit"))
    return other.select("query_id", run, F.when(F.col("hit_1"), "gain").otherwise("regression").alias("change"))


def universal_misses(per_query: DataFrame, run: str) -> DataFrame:
    """Queries that every run misses at 1 (compared with the number of runs)."""
    runs = per_query.select(run).distinct().agg(F.count("*").alias("runs"))
    hits = per_query.groupBy("query_id").agg(F.count_if(~F.col("hit_1")).alias("misses"), F.count_if("hit_1").alias("hits"))
    return hits.crossJoin(F.broadcast(runs)).select("query_id", "hits", "misses", (F.col("misses") == F.col("runs")).alias("universal_miss"))
