"""Calls in a bounded pool: order, rate, answers by id, failures as rows, and no answered call repeated after a failure."""

import json
import os
import sys
import threading
import time
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from textflow.operators import external
from textflow.operators.pool import Caller, Journal, Limits, Pace

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't see the tests' folder


class Slow:
    def __init__(self):
        self.now = self.most = 0
        self.lock = threading.Lock()

    def answer(self, payloads):
        with self.lock:
            self.now += 1
            self.most = max(self.most, self.now)
        time.sleep(0.02)
        with self.lock:
            self.now -= 1
        return [{"target": p["n"]} for p in payloads]


def test_order_and_bounds():
    client = Slow()
    chunks = [[{"n": i * 10 + k} for k in range(10)] for i in range(12)] + [[]]
    got = list(Caller(client, Limits(batch=3, workers=5)).answers(chunks))
    assert [[a["target"] for a in x] for x in got] == [[p["n"] for p in x] for x in chunks]
    assert 1 < client.most <= 5


def test_rate():
    began = time.monotonic()
    list(Caller(Slow(), Limits(batch=1, workers=8, per_second=50)).answers([[{"n": i} for i in range(20)]]))
    assert time.monotonic() - began >= 19 / 50
    Pace(None).wait()


class Keyed:
    """Answers in reverse order, leaves out every third and gives one twice; nothing at all for 7, an error with 11."""

    keyed = True

    def answer(self, payloads):
        if any(p["n"] == 11 for p in payloads):
            raise RuntimeError("no 11")
        out = [{"item_id": p["item_id"], "target": str(p["n"])} for p in reversed(payloads) if p["n"] != 7 and (len(payloads) == 1 or p["n"] % 3)]
        return out + [{"item_id": out[0]["item_id"], "target": "again"}] + ["odd"] if out else []


def test_answers_by_id_and_failures():
    got = next(Caller(Keyed(), Limits(batch=5, workers=2, pause=0)).answers([[{"n": i} for i in range(14)]]))
    want = [{"target": str(i)} for i in range(14)]
    want[7], want[11] = {"error": "missing_answer"}, {"error": "RuntimeError: no 11"}
    assert got == want


class Short:
    def answer(self, payloads):
        return [{"target": "x"}] if len(payloads) == 1 else []


def test_too_few_answers_are_asked_one_by_one():
    assert next(Caller(Short(), Limits(batch=4)).answers([[{"n": i} for i in range(6)]])) == [{"target": "x"}] * 6


class Counting:
    """Leaves a file for each payload that it is asked; the executor is lost (SystemExit) at `stop`, once."""

    def __init__(self, folder, stop):
        self.folder, self.stop = folder, stop

    def answer(self, payloads):
        for p in payloads:
            if p["source"] == self.stop and not os.path.exists(f"{self.folder}/stopped"):
                open(f"{self.folder}/stopped", "w").close()
                raise SystemExit("executor lost")
        for p in payloads:
            with open(f"{self.folder}/{uuid.uuid4().hex}.json", "w") as f:
                json.dump(p, f)
        return [{"target": p["source"].upper()} for p in payloads]


def asked(folder):
    return sorted(json.load(open(f"{folder}/{f}"))["source"] for f in os.listdir(folder) if f.endswith(".json"))


def test_answered_calls_are_not_repeated(spark, tmp_path):
    calls, journal = tmp_path / "calls", tmp_path / "journal"
    calls.mkdir(), journal.mkdir()
    df = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "id long, source string").repartition(3)
    client = Counting(str(calls), "text 59")
    limits = Limits(batch=2, workers=1)
    with pytest.raises(Exception):  # noqa: B017
        external.call(df, client, ["source"], limits, journal.as_uri()).collect()
    first = asked(calls)
    assert 0 < len(first) < 60
    rows = external.call(df, client, ["source"], limits, journal.as_uri()).collect()
    assert {(r.id, r.target, r.call_error) for r in rows} == {(i, f"TEXT {i}", None) for i in range(60)}
    assert asked(calls) == sorted(f"text {i}" for i in range(60))  # each once
    assert external.call(df, client, ["source"], limits, journal.as_uri()).count() == 60 and len(asked(calls)) == 60


def test_half_written_journal_files_count_for_nothing(tmp_path):
    journal = Journal(tmp_path.as_uri(), 3)
    journal.add({"a": {"target": "1"}}), journal.add({})
    (tmp_path / "part=3" / "half.tmp").write_text('{"b": {"tar')
    assert Journal(tmp_path.as_uri(), 3).known == {"a": {"target": "1"}} and Journal(tmp_path.as_uri(), 4).known == {}


def test_a_failed_payload_is_a_row(spark):
    df = spark.createDataFrame([(i, f"s{i}") for i in range(30)] + [(30, None)], "id long, source string").withColumn("target", F.lit("old"))
    rows = external.call(df, external.Stub(raises=3), ["source"], Limits(batch=7, attempts=2, pause=0)).collect()
    bad = [r for r in rows if r.call_error]
    assert len(rows) == 31 and 0 < len(bad) < 31 and all(r.target == "" for r in bad)
    assert {r.call_error.split(":")[0] for r in bad} == {"ValueError", "AttributeError"}
    assert all(r.target == f"[t] {r.source}" for r in rows if not r.call_error)
    told = external.ask(df.where("id < 5"), external.Stub(raises=1), ["source"], Limits(attempts=1)).collect()
    assert {json.loads(r.answer)["error"] for r in told} == {"ValueError: refused"}
