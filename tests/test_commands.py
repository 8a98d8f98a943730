"""Commands of filling, repair and evaluation, and the evaluation flow against plain ranks."""

import json

import numpy as np

from textflow import __main__ as cli
from textflow.operators.encoders import Hashed
from textflow.plans import pipelines


def lines(path, rows):
    path.write_text("\n".join(json.dumps(r) for r in rows))
    return str(path)


def test_fill_and_repair(spark, tmp_path):
    pack = tmp_path / "r.yaml"
    pack.write_text("entities: []\nscript: 'A-Za-z0-9 \\[\\]'\n")
    go = lambda *a: cli.run(spark, cli.arguments([str(x) for x in a]))
    turns = [{"dialogue_id": 1, "turn": t, "role": "user", "content_msa": c} for t, c in enumerate(["my number is XXXX please", "nothing here", "and XXX more of it"])]
    go("fill", "--input", lines(tmp_path / "t.json", turns), "--output", tmp_path / "fill", "--rules", pack)
    rows = {r.turn: r for r in spark.read.json(f"{tmp_path}/fill/turns").collect()}
    assert rows[0].fill_status in ("accepted", "warning") and "XXXX" not in rows[0].filled and rows[1].fill_status is None
    assert spark.read.json(f"{tmp_path}/fill/slots").count() == 2
    items = [{"group_idx": 1, "item_id": f"i{k}", "role": "positive", "idx": k, "source": "good text here", "target": "", "status": s, "hard_errors": e} for k, (s, e) in enumerate([("failed", ["empty_translation"]), ("accepted", [])])]
    assert go("repair", "--input", lines(tmp_path / "i.json", items), "--output", tmp_path / "rep", "--rules", pack) == 0
    assert {(r.item_id, r.target, r.status) for r in spark.read.json(f"{tmp_path}/rep/merged").collect()} == {("i0", "[t] good text here", "accepted"), ("i1", "", "accepted")}


def test_evaluation(spark, tmp_path):
    groups = [{"query": q, "positive": p, "negative": n} for q, p, n in [("red apple", ["a red apple tree", "apples"], ["blue sea"]), ("blue sea", ["the sea is blue"], ["a red apple tree", "car"]), ("fast car", ["cars that are fast"], ["the sea is blue"])]]
    (tmp_path / "g.json").write_text(json.dumps(groups))
    args = ["evaluate", "--input", str(tmp_path / "g.json"), "--output", str(tmp_path / "ev"), "--vectors", str(tmp_path / "v"), "--top", "3"]
    for _ in range(2):  # the second run finds its vectors
        assert cli.run(spark, cli.arguments(args)) == 0
    texts = sorted({t for g in groups for t in g["positive"] + g["negative"]})
    encode = lambda t: Hashed().encode([t])[0]
    got = {r.group_idx: r for r in spark.read.json(f"{tmp_path}/ev/queries").collect()}
    for i, g in enumerate(groups):
        order = sorted(range(len(texts)), key=lambda c, g=g: (-round(float(encode(g["query"]) @ encode(texts[c])), 9), c))
        ranks = sorted(order.index(texts.index(p)) + 1 for p in g["positive"])
        assert got[i].best_rank == ranks[0] and got[i].recall_3 == np.mean([x <= 3 for x in ranks]) and got[i].hit_1 == (ranks[0] == 1)
    top = spark.read.json(f"{tmp_path}/ev/top")
    assert top.count() == 9 and set(top.columns) == {"group_idx", "rank", "cand_id", "text", "score"}
    assert spark.read.json(f"{tmp_path}/ev/summary").first().encoder == "hashed"
    df = spark.createDataFrame([(0, None, ["x"], []), (1, "x", ["x", "y"], ["z"])], "group_idx int, query string, positive array<string>, negative array<string>")
    assert [r.group_idx for r in pipelines.evaluate_groups(df)["queries"].collect()] == [1]
