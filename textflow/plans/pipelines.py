"""Whole flows over the operators: groups, FAQ tables and dialogues translated and checked, redactions filled, repairs merged.

Each calls the model once for each distinct text that no cache has, restores names before it checks, and keeps every
accepted text for the next run's cache."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.functions import text
from textflow.operators import dense, encoders, external, judges, lookup, payloads, qa, reports, reshape, restore, retrieval, rules, sessions
from textflow.operators.external import Client
from textflow.operators.rules import Rules
from textflow.sources import shared

Cut = Callable[[DataFrame], DataFrame]


def translate_texts(texts: DataFrame, pack: Rules, client: Client, cache: DataFrame | None = None, rounds: int = 3, cut: Cut = shared.cut, meaning: Client | None = None) -> DataFrame:
    """Distinct texts (source) -> source, target, status, hard_errors, semantic_pass, retry_rounds, origin (cache or model).

    meaning: a judge, whom a text has to satisfy as well; without one semantic_pass is null, as it is for cached texts."""
    todo = texts.select("source").where(~text.blank(F.col("source"))).distinct()
    if cache is not None:
        todo = todo.join(cache.select("source"), "source", "left_anti")
    asked = rules.annotate(todo, "source", pack).select(text.short_hash(F.col("source")).alias("item_id"), "source", "entities", "actions")

    def check(df: DataFrame) -> DataFrame:
        out = qa.hard_qa(restore.restore_placeholders(df, "source", "target", pack.entities, "target", pack.residue), pack)
        if meaning is None:
            return out.withColumn("semantic_pass", F.lit(None).cast("boolean")).withColumn("semantic_errors", F.array().cast("array<string>"))
        return judges.meaning(out, meaning).withColumn("hard_pass", F.col("hard_pass") & F.col("semantic_pass"))

    made = external.repair_loop(asked, client, check, rounds, cut, ("semantic_pass", "semantic_errors"))
    made = made.select("source", "target", "status", "hard_errors", "semantic_pass", "retry_rounds", F.lit("model").alias("origin"))
    if cache is None:
        return made
    none = F.array().cast("array<string>")
    hits = lookup.cached(texts.select("source").distinct(), cache).where("hit")
    hits = hits.select("source", "target", F.lit("accepted").alias("status"), none.alias("hard_errors"), F.lit(None).cast("boolean").alias("semantic_pass"), F.lit(0).alias("retry_rounds"), F.lit("cache").alias("origin"))
    return made.unionByName(hits)


def translate_groups(groups: DataFrame, pack: Rules, client: Client, cache: DataFrame | None = None, rounds: int = 3, cut: Cut = shared.cut, meaning: Client | None = None, relation: Client | None = None, back: Client | None = None, relation_limit: int = 20) -> dict[str, DataFrame]:
    """groups (group_idx, query, positive, negative) -> strict and partial groups of targets, debug (one row a group), report
    (one row), items, rejected groups with their errors, and accepted pairs for the cache.

    meaning, relation and back are judges, each asked if there is one: of a text's meaning in every round of repair, of a
    candidate's relation to its query (negatives from place relation_limit on aside; 0: all), and for a translation back, kept
    in the column back. Without them semantic_pass and relation_preserved are null, which counts as passed."""
    checked = reshape.precheck(groups)
    fatal = F.size(F.array_except("errors", F.array(F.lit("duplicate_positive")))) > 0
    items = reshape.expand(checked.where(~fatal))
    done = translate_texts(items, pack, client, cache, rounds, cut, meaning)
    if back is not None:
        done = cut(judges.back_translated(done, back))
    rows = items.join(done, "source", "left").withColumn("status", F.coalesce("status", F.lit("failed"))).withColumn("hard_pass", F.coalesce(F.size("hard_errors") == 0, F.lit(False)))
    if relation is None:
        rows = rows.withColumn("relation_preserved", F.lit(None).cast("boolean"))
    else:
        rows = judges.gate(cut(judges.relation(rows, relation, relation_limit).drop("relation_skipped")))
    debug = reshape.group_summary(rows)
    complete = debug.where("hard_pass and semantic_pass and relation_preserved and size(failed_items) = 0").select("group_idx")
    return {
        "items": rows, "debug": debug, "report": reshape.qa_report(debug), "rejected": checked.where(fatal).select("group_idx", "errors"),
        "strict": reshape.renest(rows, "target").join(complete, "group_idx", "left_semi"), "partial": reshape.renest_accepted(rows, "target"),
        "accepted": done.where("status = 'accepted'").select("source", "target"),
    }


def preflight(failed: DataFrame, pack: Rules, exact: list[str], patterns: list[str]) -> DataFrame:
    """Texts that failed before (source, target, ...) with outcome, before any model is called: skipped (turns that aren't
    translated keep their text), accepted (the old target, restored, passes today's rules), pending. Blank texts are left out."""
    rows = failed.withColumn("source", F.trim("source")).where(~text.blank(F.col("source"))).withColumn("skip_reason", sessions.skip_reason(F.col("source"), exact, patterns))
    rows = rows.withColumn("target", external.restore_redactions(F.col("target"), text.redacted_tokens(F.col("source"))))
    rows = restore.restore_placeholders(rows, "source", "target", pack.entities, "target", pack.residue)
    checked = qa.hard_qa(rules.annotate(rows, "source", pack), pack)
    passed = F.col("hard_pass") & ~text.blank(F.col("target"))
    outcome = F.when(F.col("skip_reason").isNotNull(), "skipped").when(passed, "accepted").otherwise("pending")
    return checked.withColumn("outcome", outcome).withColumn("target", F.when(outcome == "skipped", F.col("source")).otherwise(F.col("target")))


def repair_groups(items: DataFrame, pack: Rules, client: Client) -> dict[str, DataFrame]:
    """Checked items (group_idx, item_id, role, idx, source, target, status, hard_errors) -> triage, repaired (with
    repair_status), merged items, dropped."""
    failed = items.where("status <> 'accepted'")
    triaged = qa.triage(failed, pack)
    again = payloads.by_priority(triaged)[0].select("item_id", "role", "source", F.concat_ws(",", "hard_errors").alias("errors"))
    answers = external.call(again, client, ["source", "errors"])
    checked = qa.hard_qa(restore.restore_placeholders(rules.annotate(answers, "source", pack), "source", "target", pack.entities, "target", pack.residue), pack)
    repaired = checked.select("item_id", "role", "source", "target", F.when(F.col("hard_pass"), "accepted").otherwise("failed").alias("repair_status"))
    fixed = repaired.where("repair_status = 'accepted'").select("item_id", F.col("target").alias("fixed"))
    merged = items.join(fixed, "item_id", "left").withColumn("status", F.when(F.col("fixed").isNotNull(), "accepted").otherwise(F.col("status"))).withColumn("target", F.coalesce("fixed", "target")).drop("fixed")
    return {"triage": triaged, "repaired": repaired, "merged": merged, "dropped": payloads.dropped(triaged, repaired)}


def translate_faq(rows: DataFrame, key: str, fields: list[str], lists: list[str], pack: Rules, client: Client, cache: DataFrame | None = None, cut: Cut = shared.cut) -> tuple[DataFrame, DataFrame]:
    """FAQ rows with all their cells translated (a row with a cell that failed is left out), and all results."""
    cells = F.concat(F.array(*fields), *(F.coalesce(c, F.array().cast("array<string>")) for c in lists))
    done = translate_texts(rows.select(F.explode(cells).alias("source")), pack, client, cache, cut=cut)
    return lookup.all_or_nothing(rows, key, fields, lists, done.where("status = 'accepted'")), done


def translate_dialogues(turns: DataFrame, pack: Rules, client: Client, exact: list[str], patterns: list[str], cache: DataFrame | None = None, cut: Cut = shared.cut) -> DataFrame:
    """turns (dialogue_id, turn, content, ...) with content_msa and skip_reason: skipped turns keep their content, others
    have the accepted translation of their text with its redactions back in place, or null."""
    rows = turns.withColumn("skip_reason", sessions.skip_reason(F.col("content"), exact, patterns))
    rows = rows.withColumn("_tokens", text.redacted_tokens(F.col("content"))).withColumn("source", F.when(F.col("skip_reason").isNull(), external.mask_redactions(F.col("content"))))
    done = translate_texts(rows.where("skip_reason is null"), pack, client, cache, cut=cut).where("status = 'accepted'").select("source", "target")
    out = rows.join(done, "source", "left")
    target = F.when(F.col("skip_reason").isNotNull(), F.col("content")).otherwise(external.restore_redactions(F.col("target"), F.col("_tokens")))
    return out.withColumn("content_msa", target).drop("_tokens", "source", "target")


def fill_dialogues(turns: DataFrame, client: Client, content: str = "content_msa", gap: int = sessions.GAP, entities: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """turns with redactions (dialogue_id, turn, role, `content`) -> turns with filled and fill_status, and slots with hints.

    Nearby turns with redactions form a cluster; each token gets a hint from the turn and the turns around its cluster and a
    synthetic value; the model fills a turn by these; what it returns is checked."""
    tokens = text.redacted_tokens(F.col(content))
    clustered = sessions.clusters(turns, F.size(tokens) > 0, gap)
    near = sessions.context(turns, clustered).join(turns.select("dialogue_id", "turn", F.col(content).alias("near")), ["dialogue_id", "turn"])
    around = near.groupBy("dialogue_id", "cluster_idx").agg(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("turn", "near"))), lambda x: x["near"])).alias("around"))
    rows = clustered.join(around, ["dialogue_id", "cluster_idx"], "left").withColumn("hint_type", text.hint_type(F.col(content), F.col("around")))
    slots = sessions.slots(rows, tokens).join(rows.select("dialogue_id", "turn", "hint_type"), ["dialogue_id", "turn"])
    hinted = sessions.slot_hints(slots, F.col("hint_type"))
    values = hinted.groupBy("dialogue_id", "turn").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token", "suggested_value"))), lambda x: F.struct(x["token"].alias("token"), x["suggested_value"].alias("value")))).alias("slots"))
    asked = rows.join(values, ["dialogue_id", "turn"]).select("dialogue_id", "turn", "hint_type", F.col(content).alias("source"), "slots")
    answered = external.call(asked, client, ["source", "slots"])
    pairs = answered.select("dialogue_id", "turn", "hint_type", F.col("source").alias("original"), F.col("target").alias("filled"))
    checked = qa.fill_qa(pairs, external.preservation(F.col("original"), F.col("filled")), entities or [])
    return sessions.merge_back(turns, checked.select("dialogue_id", "turn", "filled", "status"), tokens), hinted


class Filler:
    """A stub that fills slots with their suggested values, in order."""

    def answer(self, payloads_: list[dict]) -> list[dict]:
        import json
        import re

        out = []
        for p in payloads_:
            filled = p["source"]
            for slot in json.loads(p["slots"]):
                filled = re.sub(rf"\b{re.escape(slot['token'])}\b", slot["value"], filled, count=1)
            out.append({"target": filled})
        return out


def needs_fill(c: Column) -> Column:
    return text.redacted_count(c) > 0


def evaluate_groups(groups: DataFrame, encoder: str = "hashed", ks: tuple[int, ...] = (1, 3, 5), k: int = 10, cut: Cut = shared.cut, done: DataFrame | None = None, **config) -> dict[str, DataFrame]:
    """groups (group_idx, query, positive, negative) -> how an encoder ranks each query's positives among all candidates of all groups:
    queries (group_idx, n_positive, recall@k, hit@k, best_rank), summary (one row), top (the k best texts of each query), vectors
    (text, vector; give them as `done` to the next run, which encodes what they lack).

    A query without text, or without a positive, has no row. Each distinct text is encoded once."""
    candidates = cut(retrieval.canonical(groups))
    asked = groups.where(~text.blank(F.col("query"))).select("group_idx", F.col("query").alias("text"))
    every = candidates.select("text").unionByName(asked.select("text")).distinct()
    vectors = cut(encoders.encode(every, "text", encoder, done=done, **config))
    found = candidates.join(vectors, "text").select("cand_id", F.col("vector").alias("v"), "text")
    # queries have negative ids, as none of them is a candidate
    queries = cut(asked.join(vectors, "text").select((-1 - F.col("group_idx")).cast("long").alias("query_id"), F.col("vector").alias("v")))
    own = groups.select((-1 - F.col("group_idx")).cast("long").alias("query_id"), F.explode("positive").alias("text")).join(candidates, "text").select("query_id", "cand_id")
    told = dense.evaluate(queries, found, own, ks)
    per = cut(told.select((-1 - F.col("query_id")).alias("group_idx"), *(c for c in told.columns if c != "query_id")))
    best = dense.search(queries, found, k).join(candidates, "cand_id").select((-1 - F.col("query_id")).alias("group_idx"), "rank", "cand_id", "text", "score")
    return {"queries": per, "summary": reports.summary(per.withColumn("encoder", F.lit(encoder)), ["encoder"]), "top": best, "vectors": vectors}
