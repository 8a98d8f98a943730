"""Whole flows with stub clients."""

from textflow.operators.external import Stub
from textflow.operators.rules import Rules
from textflow.plans import pipelines as P

PACK = Rules(entities=("Alpha Card",), script=r"A-Za-z0-9 \[\]")
GROUPS = "group_idx int, query string, positive array<string>, negative array<string>"


def groups(spark):
    rows = [(i, f"query {i} about Alpha Card", [f"good {i}", "shared text"], [f"bad {i}", f"worse {i}"]) for i in range(6)] + [(9, " ", ["p"], ["n"])]
    return spark.createDataFrame(rows, GROUPS)


def test_groups_are_translated_once_and_nested(spark):
    cache = spark.createDataFrame([("shared text", "from cache")], "source string, target string")
    out = P.translate_groups(groups(spark), PACK, Stub(), cache)
    strict = {r.group_idx: r for r in out["strict"].collect()}
    assert strict[2].query == "[t] query 2 about Alpha Card" and strict[2].positive == ["[t] good 2", "from cache"] and strict[2].negative == ["[t] bad 2", "[t] worse 2"]
    assert out["rejected"].first().errors == ["empty_query"]
    assert tuple(out["report"].first())[:3] == (6, 6, 0)
    assert out["accepted"].count() == 6 * 4 + 1


def test_groups_that_fail_are_left_out_and_repaired(spark):
    out = P.translate_groups(groups(spark), PACK, Stub(fails=3), rounds=1)
    report = out["report"].first()
    assert report.failed_groups > 0 and report.accepted_groups == out["strict"].count()
    fixed = P.repair_groups(out["items"], PACK, Stub(fails=3))
    left = {r.item_id for r in fixed["merged"].where("status <> 'accepted'").collect()}
    assert left == {r.item_id for r in fixed["dropped"].collect()} == {r.item_id for r in fixed["triage"].where("repair_priority = 'P2_DROP'").collect()}
    assert fixed["repaired"].where("repair_status = 'accepted'").count() + len(left) == fixed["triage"].count()


def test_faq_rows_are_all_or_nothing(spark):
    rows = spark.createDataFrame([("q1", "a1", ["v1", "v2"]), ("q2", "", None)], "Question string, Answer string, Question_cluster array<string>").withColumnRenamed("Question", "Q")
    rows = rows.selectExpr("Q as id", "Q", "Answer", "Question_cluster")
    done, _ = P.translate_faq(rows, "id", ["Q", "Answer"], ["Question_cluster"], PACK, Stub())
    got = {r.id: (r.Q, r.Answer, r.Question_cluster) for r in done.collect()}
    assert got == {"q1": ("[t] q1", "[t] a1", ["[t] v1", "[t] v2"]), "q2": ("[t] q2", "", [])}


def test_dialogues_skip_and_restore(spark):
    rows = spark.createDataFrame([(1, 0, "hello there XXX12 friend"), (1, 1, "OK"), (1, 2, "XXXX"), (1, 3, None)], "dialogue_id long, turn int, content string")
    out = {r.turn: (r.content_msa, r.skip_reason) for r in P.translate_dialogues(rows, PACK, Stub(), ["ok"], []).collect()}
    assert out == {0: ("[t] hello there XXX12 friend", None), 1: ("OK", "exact_skip"), 2: ("XXXX", "pattern_skip:sensitive_only_tokens"), 3: (None, "empty_content")}


def test_redactions_are_filled(spark):
    rows = spark.createDataFrame([(1, 0, "u", "nama saya siapa namanya bukan"), (1, 1, "a", "my account is XXXX and that is the whole of it"), (1, 2, "u", "no slots"), (1, 9, "u", "the loan runs XX months as agreed before")], "dialogue_id long, turn int, role string, content_msa string")
    out, slots = P.fill_dialogues(rows, P.Filler())
    got = {r.turn: (r.filled, r.fill_status) for r in out.collect()}
    assert got[2] == (None, None) and got[9][1] == "accepted" and "XX" not in got[9][0]
    assert {(r.turn, r.token) for r in slots.collect()} == {(1, "XXXX"), (9, "XX")}
