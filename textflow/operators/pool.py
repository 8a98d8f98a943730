"""Calls within a task: a bounded pool of threads, a rate limit, answers aligned with what was asked, failures as values, and a
journal in the shared folder, so that a task that runs again doesn't ask for what was answered before."""

from __future__ import annotations

import hashlib
import json
import threading
import time
import uuid
from collections import deque
from collections.abc import Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow.fs as pafs


@dataclass(frozen=True)
class Limits:
    """batch: payloads of one call; workers: calls of one task at a time; per_second: calls that one task may begin (None: any
    number; a limit of a whole service is divided by the tasks that run at a time); attempts: tries of a payload by itself, with
    pauses that double from `pause` seconds."""

    batch: int = 40
    workers: int = 4
    per_second: float | None = None
    attempts: int = 2
    pause: float = 0.1


class Pace:
    """Lets callers through at a given rate, in the order they come."""

    def __init__(self, per_second: float | None):
        self.gap, self.next, self.lock = 1 / per_second if per_second else 0.0, 0.0, threading.Lock()

    def wait(self) -> None:
        if not self.gap:
            return
        with self.lock:
            now = time.monotonic()
            at = max(self.next, now)
            self.next = at + self.gap
        time.sleep(max(0.0, at - now))


def digest(payload: dict) -> str:
    return hashlib.sha256(json.dumps(payload, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


class Journal:
    """Accepted answers by payload, in files of one partition's folder. A file is written under another name first, so that it is
    there whole or not at all."""

    def __init__(self, folder: str, partition: int):
        self.system, path = pafs.FileSystem.from_uri(folder)
        self.path = f"{path}/part={partition}"
        self.system.create_dir(self.path, recursive=True)
        self.known: dict[str, dict] = {}
        for info in self.system.get_file_info(pafs.FileSelector(self.path)):
            if info.path.endswith(".json"):
                with self.system.open_input_stream(info.path) as f:
                    self.known.update(json.loads(f.read()))

    def add(self, answers: dict[str, dict]) -> None:
        if not answers:
            return
        name = f"{self.path}/{uuid.uuid4().hex}"
        with self.system.open_output_stream(f"{name}.tmp") as f:
            f.write(json.dumps(answers, ensure_ascii=False).encode())
        self.system.move(f"{name}.tmp", f"{name}.json")


class Caller:
    """Answers of a client to payloads, in order: the client's dict, or {"error": why} for a payload that failed by itself."""

    def __init__(self, client, limits: Limits, journal: Journal | None = None):
        self.client, self.limits, self.journal, self.pace = client, limits, journal, Pace(limits.per_second)

    def _asked(self, payloads: list[dict]) -> list[dict | None]:
        """One call. A client with keyed = True gets each payload with an item_id and its answers are put in order by it; answers
        that are missing are None, as all are if a client without ids gives another number of them."""
        self.pace.wait()
        if not getattr(self.client, "keyed", False):
            answers = self.client.answer(payloads)
            return list(answers) if len(answers) == len(payloads) else [None] * len(payloads)
        by_id: dict[str, dict] = {}
        for a in self.client.answer([p | {"item_id": str(i)} for i, p in enumerate(payloads)]):
            if isinstance(a, dict) and a.get("item_id") is not None:
                by_id.setdefault(str(a["item_id"]), {k: v for k, v in a.items() if k != "item_id"})
        return [by_id.get(str(i)) for i in range(len(payloads))]

    def _alone(self, payload: dict) -> dict:
        why = "missing_answer"
        for attempt in range(self.limits.attempts):
            if attempt:
                time.sleep(min(self.limits.pause * 2 ** (attempt - 1), 10))
            try:
                answer = self._asked([payload])[0]
            except Exception as e:  # noqa: BLE001  whatever a client raises is its row's error
                why = f"{type(e).__name__}: {e}"[:500]
                continue
            if answer is not None:
                return answer
        return {"error": why}

    def _batch(self, payloads: list[dict]) -> list[dict]:
        """Together first; what fails or is left out, one by one."""
        keys = [digest(p) for p in payloads]
        known = self.journal.known if self.journal else {}
        out = [known.get(k) for k in keys]
        todo = [i for i, a in enumerate(out) if a is None]
        if not todo:
            return out
        try:
            answers = self._asked([payloads[i] for i in todo]) if len(todo) > 1 else [None]
        except Exception:  # noqa: BLE001
            answers = [None] * len(todo)
        if self.journal:  # what has been answered is kept before anything else is asked
            self.journal.add({keys[i]: a for i, a in zip(todo, answers, strict=True) if a is not None})
        for i, a in zip(todo, answers, strict=True):
            out[i] = a
            if a is None:
                out[i] = self._alone(payloads[i])
                if self.journal and "error" not in out[i]:
                    self.journal.add({keys[i]: out[i]})
        return out

    def answers(self, chunks: Iterable[list[dict]]) -> Iterator[list[dict]]:
        """The answers to each list of payloads, in order. Calls run ahead by twice the number of workers at most."""
        with ThreadPoolExecutor(self.limits.workers) as threads:
            ahead: deque[tuple[int, list[Future]]] = deque()
            pending = 0

            def done() -> list[dict]:
                nonlocal pending
                _, futures = ahead.popleft()
                pending -= len(futures)
                return [a for f in futures for a in f.result()]

            try:
                for payloads in chunks:
                    futures = [threads.submit(self._batch, payloads[i : i + self.limits.batch]) for i in range(0, len(payloads), self.limits.batch)]
                    ahead.append((len(payloads), futures))
                    pending += len(futures)
                    while len(ahead) > 1 and pending > 2 * self.limits.workers:
                        yield done()
                while ahead:
                    yield done()
            finally:
                for _, futures in ahead:
                    for f in futures:
                        f.cancel()
