"""Restored placeholders, judges, preflight, nested write-back, sinks and readers over several files, streams, settings, commands."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from textflow import __main__ as cli
from textflow.operators import encoders, judges, lookup, reshape, restore, retrieval, runs, sessions
from textflow.operators.external import Stub
from textflow.operators.rules import Rules
from textflow.plans import pipelines as P
from textflow.sources import readers, shared, sinks
from textflow.streaming import cache as keyed


@pytest.mark.parametrize(
    ("source", "target", "want", "notes"),
    [
        ("use Alpha Card with PIN", "a <ENT_00> b <ENT_pin>", "a Alpha Card b PIN", ["<ENT_pin>->PIN"]), ("the eWallet of Gamma", "x <ENT_ORG> y", "x eWallet y", ["<ENT_ORG>->eWallet"]),
        ("a Gamma-Pay limit B", "<ENT_gamma_pay> <ENT_SRV1>", "Gamma-Pay Gamma-Pay", ["<ENT_gamma_pay>->Gamma-Pay", "<ENT_SRV1>->Gamma-Pay"]), ("Gamma then ABC", "x <ENT_VAL> <ENT_9>", "x Gamma ABC", ["<ENT_VAL>->Gamma", "<ENT_9>->ABC"]),
        ("Gamma then ABC", "x <ENT_ENT_2> y", "x ABC y", ["<ENT_ENT_2>->ABC"]), ("Gamma", "x <ENT_ENT_7>", "x Gamma", ["<ENT_ENT_7>->Gamma"]), ("status c now", "<ENT_NUM>", "C", ["<ENT_NUM>->C"]),
        ("saldo untuk apa", "y <ENT_VAL>", "y <ENT_VAL>", []), ("has Alpha Card", "<ENT_alphacardplus>", "Alpha Card", ["<ENT_alphacardplus>->Alpha Card"]), (None, "a <ENT_x>", "a <ENT_x>", []), ("a", None, None, []), ("<ENT_ORG1> X9", "<ENT_ORG>", "ENT", ["<ENT_ORG>->ENT"]),
    ],
)
def test_placeholders(spark, source, target, want, notes):
    df = spark.createDataFrame([(source, target)], "s string, t string")
    r = restore.restore_placeholders(df, "s", "t", ["Alpha Card", "PIN"], "restored", (), "how").first()
    assert (r.restored, r.how) == (want, notes)


def test_disjoint_spans_take_the_longest_of_the_leftmost():
    assert restore.disjoint([(4, 6, "c"), (0, 2, "a"), (0, 5, "b"), (5, 9, "d"), (5, 5, "e")]) == ["b", "d"]


def test_ids_never_collide(spark):
    rows = [(1234567, "q", ["p"] * 1001, ["n"]), (1234568, "q", ["p"], ["n"])]
    items = reshape.expand(spark.createDataFrame(rows, "group_idx long, query string, positive array<string>, negative array<string>"))
    assert items.count() == items.select("item_id").distinct().count() == 1006
    assert {r.item_id for r in items.where("group_idx = 1234568").collect()} == {"q_1234568_query", "q_1234568_p_000", "q_1234568_n_0000"}


def test_debug_groups_give_all_items(spark):
    kind = "array<struct<id:string,idn:string,msa:string,final_status:string>>"
    rows = [(1, "q_000001", "s", "t", [("q_000001_p_000", "a", "b", "accepted")], None), (2, "q_000002", "s2", "t2", None, [("q_000002_n_0012", "c", "d", "failed")])]
    out = reshape.from_debug(spark.createDataFrame(rows, f"group_idx int, query_id string, query_idn string, query_msa string, positive {kind}, negative {kind}"))
    assert {(r.group_idx, r.role, r.idx, r.id, r.idn, r.msa, r.final_status) for r in out.collect()} == {
        (1, "query", 0, "q_000001_query", "s", "t", None), (1, "positive", 0, "q_000001_p_000", "a", "b", "accepted"), (2, "query", 0, "q_000002_query", "s2", "t2", None), (2, "negative", 12, "q_000002_n_0012", "c", "d", "failed"),
    }


def test_write_back_only_where_matched(spark):
    rows = [(1, [(0, " a ", "old"), (1, "b", "old"), (2, None, None)], "x"), (2, [], "y"), (3, None, "z")]
    df = spark.createDataFrame(rows, "dialogue_id long, turns array<struct<turn:int,content:string,content_msa:string>>, topic string")
    out = {r.dialogue_id: r for r in reshape.write_back(df, spark.createDataFrame([("a", "A"), ("zz", "Z")], "source string, target string")).collect()}
    assert [(t.turn, t.content, t.content_msa) for t in out[1].turns] == [(0, " a ", "A"), (1, "b", "old"), (2, None, None)]
    assert (out[1].topic, out[2].turns, out[3].turns) == ("x", [], None)


def test_logs_of_several_files_keep_their_order(spark, tmp_path):
    """The first file is small, the second large and read in several pieces: the last line of the last file wins."""
    (tmp_path / "part-0.jsonl").write_text('{"idn": "a", "msa": "old"}\n{"idn": "b", "msa": "only"}\n')
    filler = "\n".join(json.dumps({"idn": f"k{i}", "msa": "x" * 50}) for i in range(20000))
    (tmp_path / "part-1.jsonl").write_text('{"idn": "a", "msa": "first"}\n' + filler + '\n{"idn": "a", "msa": "new"}\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        got = {r.source: r.target for r in readers.cache(spark, str(tmp_path)).where("source in ('a', 'b')").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {"a": "new", "b": "only"}


def test_a_replayed_batch_counts_once(spark, tmp_path):
    spark.range(6).write.parquet(str(tmp_path / "in"))
    for checkpoint in ("c1", "c2"):  # the second start has lost its progress and replays batch 0
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        sinks.in_batches(stream, str(tmp_path / "out"), str(tmp_path / checkpoint)).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(6))


def test_keyed_cache_of_a_stream(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "cache")
    for k, rows in enumerate([[("a", 1, "x"), ("b", 1, "y")], [("a", 2, "z"), ("b", 0, "late")], [("c", 1, "w")]]):
        spark.createDataFrame(rows, "source string, seq int, target string").coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("source string, seq int, target string").parquet(folder)
        keyed.keyed_cache(stream, out, str(tmp_path / "progress"), ["source"], "seq").awaitTermination()
        assert keyed.versions(spark, out) == list(range(k + 1))[-2:]
    assert {(r.source, r.target) for r in keyed.latest(spark, out).collect()} == {("a", "z"), ("b", "y"), ("c", "w")}
    items = spark.createDataFrame([("a",), ("q",)], "source string")
    assert {(r.source, r.target) for r in keyed.lookup(items, out, ["source"]).collect()} == {("a", "z"), ("q", None)}
    assert keyed.latest(spark, str(tmp_path / "none")) is None


def test_failures_go_when_nothing_failed(spark, tmp_path):
    df, path = spark.createDataFrame([(1,)], "x int"), str(tmp_path / "failed")
    sinks.failures(df, path)
    assert spark.read.json(path).count() == 1
    sinks.failures(df.limit(0), path)
    assert not (tmp_path / "failed").exists()


def test_outputs_are_rebuilt_from_the_log(spark, tmp_path):
    rows = [(1, "q_000001_query", "query", 0, "t0", "accepted", 1), (1, "q_000001_p_000", "positive", 0, "bad", "failed", 1), (1, "q_000001_p_000", "positive", 0, "t1", "accepted", 2), (1, "q_000001_n_0000", "negative", 0, "t2", "accepted", 1), (2, "q_000002_query", "query", 0, "u0", "accepted", 1), (2, "q_000002_p_000", "positive", 0, "u1", "failed", 3)]
    log = spark.createDataFrame([(*r[:6], r[5] == "accepted", None, None, 0, r[6]) for r in rows], "group_idx int, item_id string, role string, idx int, target string, status string, hard_pass boolean, semantic_pass boolean, relation_preserved boolean, retry_rounds int, seq int")
    out = sinks.rebuilt(log, str(tmp_path))
    assert [(r.group_idx, r.query, r.positive, r.negative) for r in out["strict"].collect()] == [(1, "t0", ["t1"], ["t2"])]
    assert spark.read.json(f"{tmp_path}/report").first().accepted_groups == 1 and spark.read.json(f"{tmp_path}/strict").count() == 1


def test_many_queries_are_scored_in_blocks(spark):
    q = spark.range(50).select(F.col("id").alias("query_id"))
    c = spark.range(20).select(F.col("id").alias("cand_id"))
    score = (F.col("query_id") * F.col("cand_id")).cast("double")
    rows = {most: {tuple(r) for r in retrieval.score_all(q, c, score, most).select("query_id", "cand_id", "score").collect()} for most in (100, 7)}
    assert rows[100] == rows[7] and len(rows[7]) == 50 * 20 - 20


def test_recall_against_sorted_lists(spark):
    r = np.random.default_rng(3)
    rows = [(q, c, float(s), bool(p)) for q in range(12) for c, (s, p) in enumerate(zip(r.integers(0, 6, 30), r.random(30) < 0.08 * (q % 5), strict=True))]
    out = {x.query_id: x for x in retrieval.recall(spark.createDataFrame(rows, "query_id int, cand_id int, score double, positive boolean"), ks=(1, 2, 6)).collect()}
    for q in range(12):
        ranked = sorted((x for x in rows if x[0] == q), key=lambda x: (-x[2], x[1]))
        places = [i + 1 for i, x in enumerate(ranked) if x[3]]
        if not places:
            assert q not in out
            continue
        x = out[q]
        assert (x.n_positive, x.best_rank) == (len(places), places[0])
        assert [x.recall_1, x.recall_2, x.recall_6] == [sum(p <= k for p in places) / len(places) for k in (1, 2, 6)]
        assert [x.hit_1, x.hit_2, x.hit_6] == [any(p <= k for p in places) for k in (1, 2, 6)]


def test_sparse_scores_with_many_terms_are_the_same(spark, monkeypatch):
    q = spark.createDataFrame([(1, "a", 2.0), (1, "b", 1.0), (2, "a", 1.0)], "query_id int, token string, weight double")
    d = spark.createDataFrame([(7, "a", 3.0), (8, "b", 5.0), (8, "a", 1.0), (9, "c", 1.0)], "cand_id int, token string, weight double")
    want = {(1, 7, 6.0), (1, 8, 7.0), (2, 7, 3.0), (2, 8, 1.0)}
    for most in (100, 1):
        monkeypatch.setattr(retrieval, "VARIANTS", most)
        assert {tuple(r) for r in retrieval.sparse_scores(q, d).collect()} == want


def test_a_candidate_without_a_cluster_is_an_error(spark):
    scores = spark.createDataFrame([(1, 5, 0.5), (1, 6, 0.7)], "query_id int, cand_id int, score double")
    with pytest.raises(Exception, match="no cluster for candidate 6"):
        retrieval.cluster_mean(scores, spark.createDataFrame([(5, 1)], "cand_id int, cluster int")).collect()


def test_a_cache_with_a_source_twice(spark):
    items = spark.createDataFrame([("a",), ("b",)], "source string")
    cache = spark.createDataFrame([("a", "z", 1), ("a", "y", 2)], "source string, target string, seq int")
    assert {tuple(r) for r in lookup.cached(items, cache).collect()} == {("a", "y", True), ("b", None, False)}
    assert {tuple(r) for r in lookup.cached(items, cache.drop("seq")).collect()} == {("a", "z", True), ("b", None, False)}


def test_judges_hold_groups_back(spark):
    pack = Rules(script=r"A-Za-z0-9 \[\]")
    rows = [(i, f"query number {i}" + "x" * i, [f"good {i}" + "y" * i], [f"bad {i}", f"worse {i}" + "z" * i]) for i in range(14)]
    groups = spark.createDataFrame(rows, "group_idx int, query string, positive array<string>, negative array<string>")
    judge = judges.StubJudge()
    out = P.translate_groups(groups, pack, Stub(), meaning=judge, relation=judge, back=judge, relation_limit=2)
    items, queries = out["items"].collect(), {}
    for r in items:
        if r.role == "query":
            queries[r.group_idx] = r
    for r in items:
        n, m = len(r.source), len(r.target)
        meant = 2 + n % 5 >= 4 and m % 7 != 0 and n % 11 and n % 13
        place = 1 + r.idx if r.role == "negative" else 0
        kept = r.role == "query" or r.role == "negative" and place >= 2 or (n + m + len(r.role)) % 9 != 0
        assert r.semantic_pass == bool(meant and kept) and r.back == r.target[::-1] and (r.status == "accepted") == bool(meant and kept)
        assert r.relation_preserved is None if r.role == "query" else r.relation_preserved == kept
    good = {g for g in range(14) if all(r.status == "accepted" for r in items if r.group_idx == g)}
    assert {r.group_idx for r in out["strict"].collect()} == good and out["report"].first().accepted_groups == len(good)


def test_preflight(spark):
    pack = Rules(entities=("Alpha Card",), script="A-Za-z0-9 ")
    rows = [("my Alpha Card", "the Alpha Card"), ("my Alpha Card", "the <ENT_00>"), ("my Alpha Card", "the card"), ("call XX12 now", "call <SENS_00> now"), ("ok", "whatever"), ("  ", "x"), (None, "x"), ("new", None)]
    got = [(r.source, r.target, r.outcome) for r in P.preflight(spark.createDataFrame(rows, "source string, target string"), pack, ["OK"], []).collect()]
    assert got == [("my Alpha Card", "the Alpha Card", "accepted"), ("my Alpha Card", "the Alpha Card", "accepted"), ("my Alpha Card", "the card", "pending"), ("call XX12 now", "call XX12 now", "accepted"), ("ok", "ok", "skipped"), ("new", None, "pending")]


def test_encoders_with_several_outputs(spark):
    df = spark.createDataFrame([(1, "A b b"), (2, "A b b"), (3, ""), (4, None)], "id int, text string")
    out = {r.id: r for r in encoders.encode_parts(df, "text", "counted", size=8).collect()}
    assert out[1].sparse == out[2].sparse == {"a": 1.0, "b": 2.0} and len(out[1].multi) == 3 and len(out[1].dense) == len(out[1].multi[0]) == 8
    assert (out[3].sparse, out[3].multi, out[4].dense) == ({}, [], None)


def test_matrix_files(spark, tmp_path):
    np.save(tmp_path / "m.npy", np.arange(6, dtype=np.float32).reshape(3, 2))
    assert [(r.row, r["values"]) for r in readers.matrix(spark, str(tmp_path)).orderBy("row").collect()] == [(0, [0.0, 1.0]), (1, [2.0, 3.0]), (2, [4.0, 5.0])]


def test_settings_of_runs(tmp_path):
    assert runs.model("p") == {"path": "p", "backend": "dense", "modes": ["dense"]} and runs.model({"path": "p", "modes": ["sparse"]})["modes"] == ["sparse"]
    assert [runs.device(s, "cuda") for s in ({}, {"device": "cpu"}, {"devices": "2,3"}, {"devices": "all"}, {"devices": [1]}, {"devices": ["cuda:4"]}, {"devices": []})] == ["cuda", "cpu", "cuda:2", "cuda", "cuda:1", "cuda:4", "cuda"]
    assert list(runs.selected({"a": "x", "b": "y"}, ["b"])) == ["b"] and len(runs.selected({"a": "x", "b": "y"})) == 2
    with pytest.raises(ValueError, match="unknown models"):
        runs.selected({"a": "x"}, ["z"])
    assert runs.first_path(None, "a/b", root="/r") == "/r/a/b" and runs.resolved("hdfs://x/y", "/r") == "hdfs://x/y"
    (tmp_path / "skip.yaml").write_text("exact_skip: [OK, ' ']\npattern_skip: ['[0-9]+']\n")
    assert readers.skip_list(str(tmp_path / "skip.yaml")) == (["OK"], ["[0-9]+"])


def test_chosen_clusters(spark):
    df = spark.createDataFrame([(d, c, t) for d in (1, 2) for c in (0, 1) for t in (0, 1)], "dialogue_id int, cluster_idx int, turn int")
    assert sessions.chosen(df, dialogue=2).count() == 4 and {(r.dialogue_id, r.cluster_idx) for r in sessions.chosen(df, most=3).collect()} == {(1, 0), (1, 1), (2, 0)}


def test_canonical_candidates_over_many_ranges(spark):
    texts = [f"t{i % 97:03d}" for i in range(300)]
    df = spark.createDataFrame([(i, [t], ["neg " + t, None]) for i, t in enumerate(texts)], "group_idx int, positive array<string>, negative array<string>")
    want = sorted({*texts, *("neg " + t for t in texts)})
    assert [(r.cand_id, r.text) for r in retrieval.canonical(df).orderBy("cand_id").collect()] == list(enumerate(want))


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "g.json").write_text(json.dumps([{"query": "hello there", "positive": ["good text"], "negative": ["bad text", "good text"]}]))
    (tmp_path / "r.yaml").write_text("entities: []\nscript: 'A-Za-z0-9 \\[\\]'\n")
    (tmp_path / "d.json").write_text(json.dumps([{"dialogue_id": 1, "turns": [{"turn": 0, "role": "user", "content": "hello"}]}]))
    (tmp_path / "f.json").write_text(json.dumps([{"Question": "what is it", "Answer": "a thing", "Question_cluster": ["what"]}]))
    go = lambda *a: cli.run(spark, cli.arguments([str(x) for x in a]))
    assert go("translate", "--input", tmp_path / "g.json", "--output", tmp_path / "out", "--rules", tmp_path / "r.yaml") == 0
    assert spark.read.json(f"{tmp_path}/out/strict").first().positive == ["[t] good text"]
    assert go("dialogues", "--input", tmp_path / "d.json", "--output", tmp_path / "dia", "--rules", tmp_path / "r.yaml") == 0
    assert go("faq", "--input", tmp_path / "f.json", "--output", tmp_path / "faq", "--rules", tmp_path / "r.yaml") == 0
    assert go("sanity", "--input", tmp_path / "g.json", "--output", tmp_path / "bad") == 1
    assert spark.read.json(f"{tmp_path}/bad").first().problems == ["overlap"]


def test_shared_folder(spark, tmp_path):
    assert shared.qualified(spark, str(tmp_path)) == shared.qualified(spark, f"file:{tmp_path}") == f"file://{tmp_path}"
    table = shared.cut(spark.range(3).toDF("x"))
    assert table.count() == 3
    shared.remove(spark, table)


def test_run_tags_follow_the_input(spark, tmp_path):
    from textflow.operators.payloads import run_tag

    (tmp_path / "a").write_text("one")
    first = run_tag(spark, str(tmp_path / "a"), mode="dense")
    assert first == run_tag(spark, str(tmp_path / "a"), mode="dense") != run_tag(spark, str(tmp_path / "a"), mode="sparse")
    (tmp_path / "a").write_text("other")
    assert run_tag(spark, str(tmp_path / "a"), mode="dense") != first and len(first) == 12


def test_turns_are_cast_and_trimmed(spark):
    df = spark.createDataFrame([("7", [("3", " user ", " a ", None), (None, None, "b", "c")])], "dialogue_id string, turns array<struct<turn:string,role:string,content:string,content_msa:string>>")
    assert [(r.dialogue_id, r.turn, r.role, r.content, r.content_msa) for r in reshape.turns(df).collect()] == [(7, 3, "user", "a", ""), (7, 0, "", "b", "c")]
