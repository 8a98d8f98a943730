"""Calls of outside models: a client protocol, calls in batches within tasks, bounded rounds of repair, and the few string
steps that need Python."""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections import deque
from collections.abc import Callable
from typing import Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.functions import matching
from textflow.functions import text as T
from textflow.operators.pool import Caller, Journal, Limits
from textflow.sources import shared


class Client(Protocol):
    """Turns a batch of payloads (dicts) into as many answers; picklable, and called from several threads. With keyed = True payloads
    have an item_id that answers repeat, so that they may come in any order or be left out. Calls must be safe to repeat."""

    def answer(self, payloads: list[dict]) -> list[dict]: ...


class Stub:
    """A deterministic client for tests and dry runs: the target is the source with a mark; every source whose hash is
    divisible by `fails` comes back empty until it is asked for repair; one whose hash is divisible by `raises` is an error."""

    def __init__(self, fails: int = 0, raises: int = 0):
        self.fails, self.raises = fails, raises

    def answer(self, payloads: list[dict]) -> list[dict]:
        def one(p):
            number = int(hashlib.sha1(p["source"].encode()).hexdigest(), 16)
            if self.raises and number % self.raises == 0:
                raise ValueError("refused")
            bad = self.fails and not p.get("errors") and number % self.fails == 0
            return {"target": "" if bad else f"[t] {p['source']}"}

        return [one(p) for p in payloads]


class Http:
    """An OpenAI-compatible chat endpoint with JSON answers: up to `attempts` tries with growing pauses; an empty content
    falls back to the reasoning field. together: a batch is one request {"items": [...]}, whose answers {"items": [...]} name
    the item_id of each; else every payload is a request."""

    def __init__(self, url: str, model: str, key: str, system: str, attempts: int = 3, timeout: float = 60, together: bool = False):
        self.url, self.model, self.key, self.system, self.attempts, self.timeout, self.keyed = url, model, key, system, attempts, timeout, together

    def answer(self, payloads: list[dict]) -> list[dict]:
        return (self._one({"items": payloads}).get("items") or []) if self.keyed else [self._one(p) for p in payloads]

    def _one(self, payload: dict) -> dict:
        from urllib.request import Request, urlopen

        body = {"model": self.model, "temperature": 0.0, "response_format": {"type": "json_object"}, "messages": [{"role": "system", "content": self.system}, {"role": "user", "content": json.dumps(payload, ensure_ascii=False)}]}
        for attempt in range(self.attempts):
            try:
                request = Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
                with urlopen(request, timeout=self.timeout) as response:
                    message = json.loads(response.read())["choices"][0]["message"]
                return json.loads(message.get("content") or message.get("reasoning_content") or "")
            except (OSError, ValueError, KeyError):
                if attempt == self.attempts - 1:
                    raise
                time.sleep(min(2**attempt, 10))
        raise AssertionError


#: Keys under which a client may give its text.
TEXT_KEYS = ("target", "msa", "translation", "text", "output", "result", "content")


def first_filled(answer: dict, keys: tuple[str, ...] = TEXT_KEYS) -> str:
    """The first of several keys with a non-empty text, also in the first of `items`."""
    for place in (answer, *(answer.get("items") or [])[:1]):
        for key in keys:
            value = place.get(key) if isinstance(place, dict) else None
            if isinstance(value, str) and value.strip():
                return value.strip()
    return ""


def _told(answers: list[dict]) -> list[pa.Array]:
    """Answers as JSON."""
    return [pa.array([json.dumps(a, ensure_ascii=False) for a in answers], pa.string())]


def _texts(answers: list[dict]) -> list[pa.Array]:
    """The texts of answers, and what they say of errors as JSON."""
    errors = [json.dumps({"error": a["error"]}, ensure_ascii=False) if "error" in a else None for a in answers]
    return [pa.array([first_filled(a) for a in answers], pa.string()), pa.array(errors, pa.string())]


def _asked(df: DataFrame, client: Client, columns: list[str], limits: Limits, journal: str | None, drop: tuple[str, ...], made: Callable[[list[dict]], list[pa.Array]] = _told, into: tuple[str, ...] = ("__answer",)) -> tuple[DataFrame, list[str]]:
    """df with the columns `into` that `made` makes of the client's answers, or of {"error": why}, to payloads of the columns.
    Rows come and go in lots of one call, so that besides a batch as it came only the calls that run have Python objects.

    journal: a folder that all executors share, in which answers are kept as they come. Rows are then dealt out by their payload,
    so that a task that runs again, or the whole query, finds what was answered before and asks for the rest only. A folder is
    for one client."""
    names = [c for c in df.columns if c not in drop]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in names)
    asked = df.select(*names, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("__payload"))
    if journal is not None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        asked = asked.withColumn("__part", F.pmod(F.xxhash64("__payload"), F.lit(parts)).cast("int")).repartitionById(parts, "__part").drop("__part")

    def run(batches):
        caller = Caller(client, limits, Journal(journal, TaskContext.get().partitionId()) if journal else None)
        kept: deque = deque()

        def chunks():
            for batch in batches:
                for i in range(0, batch.num_rows, limits.batch):
                    rows = batch.slice(i, limits.batch)
                    kept.append(rows)
                    yield [json.loads(x) for x in rows.column("__payload").to_pylist()]

        for answers in caller.answers(chunks()):
            rows = kept.popleft()
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), *made(answers)], [*names, *into])

    return asked.mapInArrow(run, ", ".join([kinds, *(f"{c} string" for c in into)])), names


def call(df: DataFrame, client: Client, columns: list[str], limits: Limits = Limits(), journal: str | None = None) -> DataFrame:
    """df with target from the client, and call_error: why there is no answer (target is empty then), else null. See Limits for
    how many calls run at a time; with a journal folder no answered payload is asked again by a later attempt."""
    made, names = _asked(df, client, columns, limits, journal, ("target", "call_error"), _texts, ("__target", "__error"))
    return made.select(*names, F.col("__target").alias("target"), F.get_json_object("__error", "$.error").alias("call_error"))


def ask(df: DataFrame, client: Client, columns: list[str], limits: Limits = Limits(), journal: str | None = None) -> DataFrame:
    """df with answer, the client's whole answer as JSON to payloads of the columns, or {"error": why}."""
    made, names = _asked(df, client, columns, limits, journal, ("answer",))
    return made.select(*names, F.col("__answer").alias("answer"))


def repair_loop(items: DataFrame, client: Client, check: Callable[[DataFrame], DataFrame], rounds: int = 3, cut: Callable[[DataFrame], DataFrame] = shared.cut, extra: tuple[str, ...] = ()) -> DataFrame:
    """items (item_id, source, ...) -> with target, hard_pass, hard_errors, the extra columns of check, retry_rounds, status.
    Translated once, then only what fails is repaired with its errors (semantic_errors as well, if extra) and checked again; no
    text is changed after its last check. Each round is written before the next, so that no call is made twice."""
    made = ["target", "hard_pass", "hard_errors", *extra]
    base = [c for c in items.columns if c not in made]
    done = cut(check(call(items.select(*base), client, ["source"])).select(*base, *made).withColumn("retry_rounds", F.lit(0)))
    told = ["hard_errors", *(c for c in extra if c == "semantic_errors")]
    for i in range(1, rounds):
        failed = done.where("not hard_pass")
        if not failed.limit(1).count():
            break
        asked = failed.select(*base, F.concat_ws(",", *told).alias("errors"))
        again = check(call(asked, client, ["source", "errors"])).select(*base, *made).withColumn("retry_rounds", F.lit(i))
        done = cut(done.where("hard_pass").unionByName(again))
    return done.withColumn("status", F.when(F.col("hard_pass"), "accepted").otherwise("failed"))


def mask_redactions(c: Column) -> Column:
    """Redaction tokens replaced by <SENS_nn>, numbered in the text."""
    parts = F.split(c, T.REDACTED, -1)
    return F.array_join(F.transform(parts, lambda x, i: F.when(i > 0, F.concat(F.format_string("<SENS_%02d>", i - 1), x)).otherwise(x)), "")


def restore_redactions(c: Column, tokens: Column) -> Column:
    """The first <SENS_nn> of each number replaced by the token of that number; null tokens are none."""
    pairs = F.transform(F.coalesce(tokens, F.array().cast("array<string>")), lambda t, i: F.struct(F.format_string("<SENS_%02d>", i).alias("mark"), t.alias("token")))

    def put(x: Column, pair: Column) -> Column:
        at = F.instr(x, pair["mark"])
        return F.when(at > 0, F.concat(F.substring(x, F.lit(1), at - 1), pair["token"], F.substring(x, at + F.length(pair["mark"]), F.length(x)))).otherwise(x)

    return F.aggregate(pairs, c, put)


def _preservation(original: pa.Array, filled: pa.Array) -> pa.Array:
    pattern = re.compile(T.REDACTED)

    def bare(x):
        """The text without redactions, spaces collapsed, and how many there were; most texts have no two X in a row."""
        rest, n = pattern.subn("", x) if "xx" in x.lower() else (x, 0)
        return " ".join(rest.split()), n

    def one(a, b):
        (x, n), (y, _) = bare(a or ""), bare(b or "")
        if n >= 3:
            y = " ".join(re.sub(r"\d{2,}", "", y).split())
        return 1.0 if not x and not y else 0.0 if not x or not y else matching.ratio(x, y)

    # row by row, so that a batch isn't there once more as Python strings
    return pa.array([one(a.as_py(), b.as_py()) for a, b in zip(original, filled, strict=True)], pa.float64())


def preservation(original: Column, filled: Column) -> Column:
    """Ratcliff-Obershelp similarity of two texts without redactions; of three or more redactions in the original, digits
    that fill them don't count."""
    return F.arrow_udf(_preservation, "double")(original, filled)
