"""Command line: python -m textflow translate | dialogues | faq | fill | repair | evaluate | sanity | reports; run by spark-submit on a
cluster."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.operators import encoders, external, judges, reports, reshape, rules, sessions
from textflow.plans import pipelines
from textflow.sources import readers, sinks, versions


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="textflow")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, model: bool = True) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=text)
        p.add_argument("--input", required=True, nargs="+" if name == "reports" else None)
        p.add_argument("--output", required=True)
        if model:
            p.add_argument("--rules", required=True, help="YAML file of a rule pack")
            p.add_argument("--cache", help="JSON lines of texts that are translated already")
            p.add_argument("--base-url", help="an OpenAI-compatible endpoint; without one a stub answers")
            p.add_argument("--model", default="default")
            p.add_argument("--api-key", default="EMPTY")
            p.add_argument("--system", default="", help="file with the system prompt")
        return p

    p = command("translate", "groups of a query, positives and negatives")
    p.add_argument("--start-index", type=int, default=0)
    p.add_argument("--max-groups", type=int)
    p.add_argument("--enable-semantic-qa", action="store_true")
    p.add_argument("--enable-relation-qa", action="store_true")
    p.add_argument("--enable-backtranslation", action="store_true")
    p.add_argument("--relation-sample-limit", type=int, default=20)
    command("dialogues", "turns of dialogues").add_argument("--skip", help="YAML file of turns that aren't translated")
    command("faq", "question tables, whole rows only")
    command("fill", "redactions of translated turns (JSON lines as dialogues writes them)").add_argument("--gap", type=int, default=sessions.GAP)
    command("repair", "failed items (JSON lines with their errors) by priority")
    p = command("evaluate", "how an encoder ranks the positives of groups", False)
    p.add_argument("--encoder", default="hashed", choices=sorted(encoders.REGISTRY))
    p.add_argument("--top", type=int, default=10)
    p.add_argument("--vectors", help="Parquet folder of vectors by encoder: those that are there aren't made again")
    command("sanity", "exit with 1 if a group has a problem", False).add_argument("--residue", help="file of words that may not be left")
    command("reports", "one report of several; the last wins", False)
    return parser.parse_args(argv)


def client(a: argparse.Namespace, judge: bool = False):
    if not a.base_url:
        return judges.StubJudge() if judge else external.Stub()
    return external.Http(a.base_url, a.model, a.api_key, open(a.system, encoding="utf-8").read() if a.system else "")


def write(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        sinks.json_lines(df, f"{folder}/{name}")


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    """The exit code: 0, or 1 if something is left to do."""
    if a.command == "sanity":
        bad = reshape.sanity(readers.groups(spark, a.input), readers.word_list(a.residue) if a.residue else ["\\b\\B"]).where(F.size("problems") > 0)
        sinks.failures(bad, a.output)
        return int(bad.limit(1).count() > 0)
    if a.command == "reports":
        sinks.json_lines(reports.merge(reports.flatten(readers.reports(spark, a.input))), a.output)
        return 0
    if a.command == "evaluate":
        done = None
        if a.vectors and versions.newest(spark, f"{a.vectors}/{a.encoder}"):
            done = versions.read(spark, f"{a.vectors}/{a.encoder}")
        out = pipelines.evaluate_groups(readers.groups(spark, a.input, strict=True), a.encoder, k=a.top, done=done)
        write({k: out[k] for k in ("queries", "summary", "top")}, a.output)
        if a.vectors:
            versions.commit(out["vectors"] if done is None else done.unionByName(out["vectors"]).dropDuplicates(["text"]), f"{a.vectors}/{a.encoder}")
        return 0
    pack, cache = rules.load(a.rules), readers.cache(spark, a.cache) if a.cache else None
    if a.command == "translate":
        groups = readers.rows_between(readers.groups(spark, a.input), "group_idx", a.start_index, a.max_groups)
        judge = lambda on: client(a, True) if on else None
        out = pipelines.translate_groups(groups, pack, client(a), cache, meaning=judge(a.enable_semantic_qa), relation=judge(a.enable_relation_qa), back=judge(a.enable_backtranslation), relation_limit=a.relation_sample_limit)
        write({k: out[k] for k in ("strict", "partial", "debug", "report", "rejected", "accepted")}, a.output)
        return int(out["report"].first().failed_groups > 0)
    if a.command == "dialogues":
        exact, patterns = readers.skip_list(a.skip) if a.skip else ([], [])
        turns = pipelines.translate_dialogues(reshape.turns(readers.dialogues(spark, a.input)), pack, client(a), exact, patterns, cache)
        lost = turns.where("content_msa is null")
        write({"turns": turns}, a.output)
        sinks.failures(lost, f"{a.output}/failed")
        return int(lost.limit(1).count() > 0)
    if a.command == "fill":
        turns = spark.read.json(a.input)
        turns, slots = pipelines.fill_dialogues(turns, client(a) if a.base_url else pipelines.Filler(), gap=a.gap, entities=list(pack.entities))
        lost = turns.where("fill_status = 'failed'")
        write({"turns": turns, "slots": slots}, a.output)
        sinks.failures(lost, f"{a.output}/failed")
        return int(lost.limit(1).count() > 0)
    if a.command == "repair":
        out = pipelines.repair_groups(spark.read.json(a.input, "group_idx long, item_id string, role string, idx long, source string, target string, status string, hard_errors array<string>"), pack, client(a))
        write(out, a.output)
        return int(out["merged"].where("status <> 'accepted'").limit(1).count() > 0)
    rows = readers.faq(spark, a.input).withColumnRenamed("Question", "question").withColumn("key", F.col("question"))
    done, _ = pipelines.translate_faq(rows.select("key", "question", "Answer", "Question_cluster"), "key", ["question", "Answer"], ["Question_cluster"], pack, client(a), cache)
    write({"rows": done}, a.output)
    return int(done.count() < rows.count())


def main(argv: list[str] | None = None) -> int:
    a = arguments(sys.argv[1:] if argv is None else argv)
    return run(SparkSession.builder.appName(f"textflow {a.command}").getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
