"""Judges: a client's verdicts on meaning and relation, and translations back. All are asked in batches within tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.operators import external, qa, sessions
from textflow.operators.external import Client
from textflow.sources.shared import small_side

MEANING = "score double, meaning_preserved boolean, critical_errors array<string>, minor_errors array<string>, entity_errors array<string>, term_errors array<string>"
RELATION = "relation_preserved boolean, risk_level string, reason string"
#: Queries up to which they go to all tasks.
QUERIES = 1_000_000


def meaning(items: DataFrame, client: Client) -> DataFrame:
    """items (source, target, and entities, terms, actions, role if there) with score, semantic_errors and semantic_pass: a score
    of 4 or more, the meaning preserved, no critical and no entity error. What the client leaves out counts against it."""
    payload = [c for c in ("source", "target", "entities", "terms", "actions", "role") if c in items.columns]
    v = external.ask(items, client, payload).withColumn("verdict", F.from_json("answer", MEANING)).drop("answer")
    none = F.array().cast("array<string>")
    errors = F.concat(*(F.coalesce(f"verdict.{c}_errors", none) for c in ("critical", "entity", "term")))
    score = F.coalesce("verdict.score", F.lit(0.0)).cast("int")
    passed = qa.semantic_pass(score, F.col("verdict.meaning_preserved"), F.col("verdict.critical_errors"), F.col("verdict.entity_errors"))
    out = v.withColumns({"score": score, "semantic_pass": passed, "semantic_errors": errors})
    failed = F.when(~F.col("semantic_pass") & (F.size("semantic_errors") == 0), F.array(F.lit("semantic_check_failed"))).otherwise(F.col("semantic_errors"))
    return out.withColumn("semantic_errors", failed).drop("verdict")


def relation(items: DataFrame, client: Client, limit: int = 20) -> DataFrame:
    """Items of groups (group_idx, role, idx, source, target) with relation_preserved and relation_skipped: whether a candidate
    still stands to its group's query as before. Negatives from place `limit` on (0: none) aren't asked and pass; queries have
    neither value."""
    queries = items.where("role = 'query'").select("group_idx", F.col("source").alias("query_source"), F.col("target").alias("query_target"))
    rows = sessions.sampled_relations(items, limit)
    asked = rows.where("not skipped").join(small_side(queries, QUERIES), "group_idx", "left").withColumn("label", F.col("role"))
    told = external.ask(asked, client, ["label", "query_source", "source", "query_target", "target"])
    told = told.withColumn("relation_preserved", F.coalesce(F.from_json("answer", RELATION)["relation_preserved"], F.lit(True)))
    names = [*items.columns, "relation_preserved", F.col("skipped").alias("relation_skipped")]
    out = told.select(*names).unionByName(rows.where("skipped").withColumn("relation_preserved", F.lit(True)).select(*names))
    none = F.lit(None).cast("boolean")
    return out.unionByName(items.where("role = 'query'").select(*items.columns, none.alias("relation_preserved"), none.alias("relation_skipped")))


def back_translated(items: DataFrame, client: Client) -> DataFrame:
    """items (target, ...) with back, the translation of their target into the source language; empty if there is none."""
    told = external.ask(items, client, ["target"])
    return told.withColumn("back", F.coalesce(F.from_json("answer", "back string")["back"], F.lit(""))).drop("answer")


def gate(items: DataFrame) -> DataFrame:
    """Items whose relation isn't preserved have failed, and their semantic_pass is false."""
    lost = F.coalesce(~F.col("relation_preserved"), F.lit(False))
    return items.withColumn("status", F.when(lost, "failed").otherwise(F.col("status"))).withColumn("semantic_pass", F.when(lost, F.lit(False)).otherwise(F.col("semantic_pass")))


class StubJudge:
    """A deterministic judge for tests and dry runs, by the lengths of source and target."""

    def answer(self, payloads: list[dict]) -> list[dict]:
        def one(p):
            n, m = len(p.get("source") or ""), len(p.get("target") or "")
            if "label" in p:
                return {"relation_preserved": (n + m + len(p["label"])) % 9 != 0}
            if "source" not in p:
                return {"back": (p.get("target") or "")[::-1]}
            return {"score": 2 + n % 5, "meaning_preserved": m % 7 != 0, "critical_errors": ["lost"] if n % 11 == 0 else [], "entity_errors": ["name"] if n % 13 == 0 else []}

        return [one(p) for p in payloads]
