"""Operators on rows made by hand."""

import json

import pytest
from pyspark.sql import functions as F

from textflow import schemas
from textflow.functions import text as T
from textflow.operators import external, lookup, qa, reports, reshape, restore, retrieval, rules, sessions
from textflow.operators.rules import Rules
from textflow.sources import readers, sinks

PACK = Rules(
    entities=("Alpha Card", "Alpha", "PIN"), terms={"pin": {"triggers": ["pin"], "expected": ["رمز"], "forbidden": ["كلمة المرور"]}}, actions={"memblokir": {"triggers": ["memblokir"], "expected": ["حظر"], "forbidden": ["تفعيل"]}},
    confusions={"Alpha Card": ["Beta Card"]}, aliases={"Alpha": ["ألفا"]}, whitelist=("Alpha",), residue=("untuk",), keep_terms=("pin",), core=("alpha card",), easy_themes=("weather",),
)
ARABIC = "هذا نص عربي طويل بما يكفي للاختبار"


def _qa(spark, source, target, entities=(), actions=()):
    df = spark.createDataFrame([(source, target, list(entities), list(actions))], "source string, target string, entities array<string>, actions array<string>")
    return qa.hard_qa(df, PACK).first()


@pytest.mark.parametrize(
    ("source", "target", "entities", "actions", "error", "warning"),
    [
        ("abc", " ", (), (), "empty_translation", None), ("abc", f"{ARABIC} <ENT_01>", (), (), "unrestored_entity_placeholder", None), ("abc", f"{ARABIC} <ENT_ORG>", (), (), "hallucinated_placeholder", None),
        ("abc", f"{ARABIC} 中", (), (), "cjk_characters_found", None), ("abc", "plain words only", (), (), "script_ratio_too_low", "latin_unknown"), ("abc XXXX", ARABIC, (), (), None, "script_ratio_relaxed"),
        ("abc", f"{ARABIC} untuk", (), (), "must_translate_latin:untuk", None), ("abc PIN", ARABIC, ("PIN",), (), "missing_entity:PIN", None), ("Alpha", f"{ARABIC} ألفا", ("Alpha",), (), None, "entity_translated_ok:Alpha"),
        ("Alpha Card", f"{ARABIC} Beta Card", ("Alpha Card",), (), "entity_drift:Alpha Card->Beta Card", None), ("my pin is", f"{ARABIC} كلمة المرور", (), (), "term_confusion:pin", "term_missing:pin"),
        ("memblokir x", f"{ARABIC} تفعيل", (), ("memblokir",), "action_polarity_error:memblokir", "action_missing:memblokir"), ("memblokir dan buka blokir", f"{ARABIC} فك الحظر تفعيل", (), ("memblokir",), None, "dual_block_unblock_allowed"),
        ("a" * 200, ARABIC, (), (), None, "maybe_too_short"), ("ab", ARABIC, (), (), None, "maybe_too_long"), ("abc", "{" + ARABIC, (), (), "markdown_or_json_leakage", None),
    ],
)
def test_hard_rules(spark, source, target, entities, actions, error, warning):
    r = _qa(spark, source, target, entities, actions)
    assert r.hard_pass == (error is None), r
    assert error is None or any(e.startswith(error) for e in r.hard_errors)
    assert warning is None or any(w.startswith(warning) for w in r.hard_warnings)


def test_null_item_fails_without_an_error(spark):
    assert _qa(spark, None, None).hard_errors[0] == "empty_translation"


def test_masking_is_longest_first_and_restores(spark):
    df = spark.createDataFrame([("alpha card and Alpha, PIN but not sweepPING",), (None,), ("",)], "t string")
    rows = rules.mask_entities(df, "t", PACK).withColumn("back", rules.restore_entities(F.col("masked"), PACK)).collect()
    assert rows[0].masked == "<ENT_00> and <ENT_01>, <ENT_02> but not sweepPING"
    assert rows[0].entities == ["Alpha Card", "Alpha", "PIN"]
    assert rows[0].back == "Alpha Card and Alpha, PIN but not sweepPING"
    assert (rows[1].masked, rows[1].entities) == ("", [])


@pytest.mark.parametrize(
    ("role", "errors", "source", "target", "priority"),
    [
        ("query", [], "", "", "P0"), ("negative", ["missing_entity:Alpha"], "", "x", "RULE"), ("negative", ["action_polarity_error:a"], "terblokir buka blokir", "x", "RULE"), ("negative", ["term_confusion:pin"], "", "x", "P0"),
        ("negative", ["x"], "", "a <ENT_1>", "P0"), ("negative", ["missing_entity:Alpha Card", "y"], "", "x", "P0"), ("negative", ["script_ratio_too_low:0.1"], "weather", "x", "P2_DROP"), ("negative", ["missing_entity:PIN"], "", "x", "P1"),
        ("negative", ["action_polarity_error:a"], "", "x", "P1"), ("negative", ["script_ratio_too_low:0.1"], "", "x", "P2_DROP"), ("negative", None, None, None, "P1"),
    ],
)
def test_triage(spark, role, errors, source, target, priority):
    df = spark.createDataFrame([(role, errors, source, target)], "role string, hard_errors array<string>, source string, target string")
    assert qa.triage(df, PACK).first().repair_priority == priority


def test_expand_and_renest_are_inverse(spark):
    df = spark.createDataFrame([(1, "q", ["p0", "p1"], ["n0"]), (2, None, [], None)], "group_idx int, query string, positive array<string>, negative array<string>")
    items = reshape.expand(df)
    assert [r.item_id for r in items.where("group_idx = 1").orderBy("item_id").collect()] == ["q_000001_n_0000", "q_000001_p_000", "q_000001_p_001", "q_000001_query"]
    back = {r.group_idx: r for r in reshape.renest(items.repartition(3)).collect()}
    assert (back[1].query, back[1].positive, back[1].negative) == ("q", ["p0", "p1"], ["n0"])
    assert (back[2].query, back[2].positive, back[2].negative) == (None, [], [])


def test_precheck_and_sanity(spark):
    df = spark.createDataFrame([(1, " ", ["a", "a"], []), (2, "q", ["x <ENT_2>"], ["x <ENT_2>", "dan itu"])], "group_idx int, query string, positive array<string>, negative array<string>")
    assert [r.errors for r in reshape.precheck(df).orderBy("group_idx").collect()] == [["empty_query", "empty_negative", "duplicate_positive"], []]
    assert [r.problems for r in reshape.sanity(df, ["dan"]).orderBy("group_idx").collect()] == [["empty"], ["overlap", "placeholder", "residue"]]


def test_first_and_last_win_whatever_the_partitions(spark):
    df = spark.createDataFrame([("a", i, i * 10) for i in range(20)] + [("b", 3, 1)], "k string, seq int, v int")
    for n in (1, 7):
        assert {(r.k, r.v) for r in lookup.first_wins(df.repartition(n), ["k"], "seq").collect()} == {("a", 0), ("b", 1)}
        assert {(r.k, r.v) for r in lookup.last_wins(df.repartition(n), ["k"], "seq").collect()} == {("a", 190), ("b", 1)}


def test_clusters_split_beyond_the_gap(spark):
    df = spark.createDataFrame([(1, t, "XX" if t in (0, 3, 7) else "no") for t in range(9)], "dialogue_id long, turn int, text string")
    c = sessions.clusters(df, T.redacted_count(F.col("text")) > 0)
    assert [(r.turn, r.cluster_id) for r in c.orderBy("turn").collect()] == [(0, "1_c0"), (3, "1_c0"), (7, "1_c1")]
    near = sessions.context(df, c, 2).where("cluster_idx = 0").orderBy("turn").collect()
    assert [(r.turn, r.side) for r in near] == [(4, "after"), (5, "after")]


def test_ranks_break_ties_by_candidate(spark):
    scores = spark.createDataFrame([(1, 5, 0.5), (1, 3, 0.5), (1, 9, 0.9)], "query_id int, cand_id int, score double")
    assert [r.cand_id for r in retrieval.top_k(scores, 2).orderBy("rank").collect()] == [9, 3]
    r = retrieval.recall(scores, spark.createDataFrame([(1, 5), (1, 9)], "query_id int, cand_id int")).first()
    assert (r.n_positive, r.recall_1, r.recall_3, r.hit_1, r.best_rank) == (2, 0.5, 1.0, True, 1)


def test_reports_last_wins(spark):
    rows = spark.createDataFrame([(0, "a", "dense", 1.0), (1, "a", "dense", 2.0), (0, "b", "dense", 3.0)], "ordinal int, alias string, mode string, v double")
    assert {(r.alias, r.v) for r in reports.merge(rows).collect()} == {("a", 2.0), ("b", 3.0)}


def test_repair_loop_is_bounded_and_deterministic(spark):
    items = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "item_id int, source string")

    def check(df):
        return df.withColumn("hard_errors", F.array_compact(F.array(F.when(F.col("target") == "", "empty")))).withColumn("hard_pass", F.size("hard_errors") == 0)

    rows = external.repair_loop(items, external.Stub(fails=4), check).collect()
    again = external.repair_loop(items.repartition(5), external.Stub(fails=4), check).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and {r.status for r in rows} == {"accepted"} and {r.retry_rounds for r in rows} == {0, 1}


def test_redactions_round_trip_and_similarity(spark):
    df = spark.createDataFrame([("call AXX12 or xxx",), (None,)], "t string")
    r = df.select("t", external.mask_redactions(F.col("t")).alias("m"), T.redacted_tokens(F.col("t")).alias("k")).withColumn("b", external.restore_redactions(F.col("m"), F.col("k"))).collect()
    assert (r[0].m, r[0].b, r[1].m) == ("call <SENS_00> or <SENS_01>", "call AXX12 or xxx", None)
    s = spark.createDataFrame([("a b XX", "a b 12"), ("XX", "YXX"), ("x", "")], "o string, f string").select(external.preservation(F.col("o"), F.col("f")).alias("p")).collect()
    assert [round(x.p, 3) for x in s] == [0.667, 1.0, 0.0]


def test_placeholders_by_number_tag_and_position(spark):
    df = spark.createDataFrame([("use Alpha Card with PIN", "a <ENT_00> b <ENT_pin>"), ("see Gamma Pay", "x <ENT_QQ>"), ("none", "plain")], "s string, t string")
    out = {r.s: r.restored for r in restore.restore_placeholders(df, "s", "t", ["Alpha Card", "PIN"]).collect()}
    assert out == {"use Alpha Card with PIN": "a Alpha Card b PIN", "see Gamma Pay": "x Gamma", "none": "plain"}


@pytest.mark.parametrize(("text", "hint"), [("", "unknown"), ("bunga 2 bulan", "rate"), ("cicilan", "tenor"), ("nomor kartu saya", "pii_card"), ("XX XX XX", "pii_generic"), ("halo", "unknown")])
def test_hints_have_a_priority(spark, text, hint):
    assert spark.createDataFrame([(text,)], "t string").select(T.hint_type(F.col("t")).alias("h")).first().h == hint


def test_readers(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps([{"query": "q", "positive": ["p"], "negative": ["n"]}, {"query": "r", "positive": [], "negative": ["n"], "extra": 1}]))
    g = readers.groups(spark, str(tmp_path / "g.json"))
    assert [(r.group_idx, r.query) for r in g.orderBy("group_idx").collect()] == [(0, "q"), (1, "r")]
    with pytest.raises(ValueError, match="no positive"):
        readers.groups(spark, str(tmp_path / "g.json"), strict=True)
    (tmp_path / "c.jsonl").write_text('{"source_idn": "a", "msa": "1"}\n\n{"idn": "a", "msa_raw": "2"}\n{"idn": "b", "msa": ""}\n')
    assert [(r.source, r.target) for r in readers.cache(spark, str(tmp_path / "c.jsonl")).collect()] == [("a", "2")]
    (tmp_path / "o.json").write_text('{"x": "y", "z": " "}')
    assert [(r.source, r.target) for r in readers.cache(spark, str(tmp_path / "o.json"), "object").collect()] == [("x", "y")]
    (tmp_path / "w.txt").write_text("# no\n\nyes\n")
    assert readers.word_list(str(tmp_path / "w.txt")) == ["yes"]
    assert readers.rows_between(g, "group_idx", 1, 5).count() == 1
    (tmp_path / "d.json").write_text(json.dumps([{"dialogue_id": 1, "turns": [{"turn": 0, "role": "user", "content": " a "}, {"turn": 1, "role": "agent"}]}]))
    t = reshape.turns(readers.dialogues(spark, str(tmp_path / "d.json"))).orderBy("turn").collect()
    assert [(r.turn, r.content) for r in t] == [(0, "a"), (1, "")]
    (tmp_path / "f.json").write_text(json.dumps([{"Question": "q", "Question_cluster": ["a"]}, {"Question": "q", "Question_cluster": ["b"]}]))
    assert readers.faq(spark, str(tmp_path / "f.json")).first().Question_cluster == ["b"]
    (tmp_path / "r.json").write_text(json.dumps({"eval_set": "e", "num_queries": 1, "models": {"m": {"path": "p", "modes": {"dense": {"mode": "dense", "summary": {"recall@1": 0.5}}}}}}))
    assert reports.flatten(readers.reports(spark, [str(tmp_path / "r.json")])).first().summary == {"recall@1": 0.5}
    assert schemas.ITEM


def test_sinks_and_gate(spark, tmp_path):
    df = spark.createDataFrame([("a", "b")], "source string, target string")
    sinks.append_log(df, str(tmp_path / "log"), "r1")
    sinks.append_log(df, str(tmp_path / "log"), "r2")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    sinks.save_cache(df, str(tmp_path / "cache"), 3)
    assert spark.read.parquet(str(tmp_path / "cache")).first().version == 3
    sinks.failures(df.limit(0), str(tmp_path / "failed"))
    with pytest.raises(ValueError, match="left"):
        sinks.gate(df, "source = 'a'", "left")


def test_stream_equals_batch(spark, tmp_path):
    from textflow.streaming import sessions as S

    rows = [(1, f"2024-01-01 00:{m:02d}:00") for m in (0, 20, 55)] + [(2, "2024-01-01 05:00:00"), (3, "2024-01-02 00:00:00")]
    df = spark.createDataFrame(rows, "user_id int, t string").select("user_id", F.col("t").cast("timestamp").alias("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = S.event_sessions(S.read_events(spark, str(tmp_path / "in"), df.schema, 10))
    q = stream.writeStream.format("memory").queryName("sessions_out").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.user_id, str(r.start), r.events) for r in spark.table("sessions_out").collect()}
    batch = {(r.user_id, str(r.start), r.events) for r in S.event_sessions(df).collect()}
    assert got and got <= batch and len(batch) == 5 - 1
