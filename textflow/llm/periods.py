"""Runs of repeated words in a text: maximal stretches with a smallest period, by Lyndon arrays (after Ellert and Fischer).

A run whose words repeat with period q holds a root of q words that is a Lyndon word in one of two orders of the words, the
usual one and its reverse, and that reaches from its first word just to the next smaller suffix. So the next smaller suffixes
in both orders name all candidates, one for each word and order. They come from one scan with a stack. A comparison of two
suffixes needs their common prefix; its words are never read twice: where the later suffix lies in a stretch that was matched
with an earlier one, the comparison was made before with the counterparts there and is looked up, and where a stack entry's
common prefix with the next one differs from its own, the answer is the smaller of both. Only what reaches past everything
matched so far is read. Words are compared as numbers, their ranks in sorted order: no suffix array or tree, no fingerprints.

A text is cut down first: a window of `floor` words that isn't found twice in it is in no run with three periods and enough
words, so only stretches of words whose windows all recur are scanned, each by itself.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, PERIODS = 24, 3
#: Words of the windows that must recur.
WINDOW, ROUNDS = 4, 4


def lyndon_edges(t: list[int], work: list[int] | None = None) -> Iterator[tuple[int, int, int]]:
    """(i, j, n): j begins the next smaller suffix after i (the end of t is smaller than any word), n is the length of the common
    prefix of both. Suffixes without a smaller one are left out. work: gets the number of words that were compared one by one."""
    size = len(t)
    nss, n_next, pss, n_prev = [0] * size, [0] * size, [-1] * size, [0] * size
    left = right = reach = compared = 0  # t[left:] and t[right:] agree up to `reach` in the latter
    for i in range(1, size):
        j, word, last, known = i - 1, t[i], -1, 0
        while j >= 0:
            if t[j] != word:  # most pairs
                n = 0
            else:
                n, k = -1, 0
                if i < reach and j >= right:
                    a, b = j - right + left, i - right + left
                    n = n_next[a] if nss[a] == b else n_prev[b] if pss[b] == a else -1
                    if n >= reach - i:
                        n, k = -1, reach - i
                if n < 0 and last >= 0:
                    k = max(k, min(n_prev[last], known))
                    if n_prev[last] != known:
                        n = k
                if n < 0:
                    start = k
                    while i + k < size and t[i + k] == t[j + k]:
                        k += 1
                    n, compared = k, compared + k - start + 1
                    if i + k > reach:
                        left, right, reach = j, i, i + k
            if i + n < size and t[j + n] < t[i + n]:
                pss[i], n_prev[i] = j, n
                break
            nss[j], n_next[j] = i, n
            yield j, i, n
            last, known, j = j, n, pss[j]
    if work is not None:
        work.append(compared)


def runs_of(t: list[int], least: int = LEAST, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of t with at least `least` words and `periods` periods (2 or more), by start, then
    period; period is the smallest one."""
    found = set()
    top = max(t, default=0)
    for order in (t, [top - x for x in t]):
        ends: dict[int, int] = {}  # of each period, where its last run ends
        for i, j, n in lyndon_edges(order):
            q = j - i
            if n + q <= (periods - 1) * q or ends.get(q, 0) >= j + q:
                continue  # no first root of a run that is long enough, or a later root of one that is known
            start = i
            while start and t[start - 1] == t[start - 1 + q]:
                start -= 1
            ends[q] = j + n
            length = j + n - start
            if length >= max(least, periods * q):
                found.add((start, length, q))
    return sorted(found)


def _recurring(ids: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows of `size` numbers that are found more than once."""
    n = len(ids) - size + 1
    name = ids[:n].astype(np.int64)
    for k in range(1, size):
        top = int(name.max()) + 1
        if top * (int(ids.max()) + 1) >= 1 << 62:
            name = np.unique(name, return_inverse=True)[1]
        name = name * (int(ids.max()) + 1) + ids[k : n + k]
    order = np.argsort(name, kind="stable")
    same = name[order][1:] == name[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    return np.flatnonzero(twice)


def stretches(ids: np.ndarray, least: int = LEAST, size: int = WINDOW) -> list[tuple[int, int]]:
    """(start, end) of stretches of at least `least` numbers that hold all runs: windows of `size` that don't recur part them,
    then those that don't recur in a part, up to ROUNDS times."""
    todo, out = [(0, len(ids), 0)], []
    while todo:
        a, b, depth = todo.pop()
        if b - a < least:
            continue
        at = _recurring(ids[a:b], size) if depth < ROUNDS else ()
        if depth == ROUNDS or len(at) == b - a - size + 1:
            out.append((a, b))
        elif len(at):
            cuts = np.flatnonzero(np.diff(at) > 1)
            first, last = at[np.r_[0, cuts + 1]], at[np.r_[cuts, len(at) - 1]]
            keep = last + size - first >= least
            todo.extend((a + int(x), a + int(y) + size, depth + 1) for x, y in zip(first[keep], last[keep], strict=True))
    return sorted(out)


def word_runs(words: list, least: int = LEAST, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a list of words (any type that sorts), by start, then period."""
    least = max(least, periods)
    if len(words) < least:
        return []
    rank = {w: i for i, w in enumerate(sorted(set(words)))}
    ids = np.fromiter(map(rank.__getitem__, words), np.int64, len(words))
    # with so few words (one for two periods), all windows of a run have a copy one period before or after, in the run
    size = max(1, min(WINDOW, (least + 5) // 3)) if periods > 2 else 1
    found = []
    for a, b in stretches(ids, least, size):
        found += [(a + start, length, q) for start, length, q in runs_of(ids[a:b].tolist(), least, periods)]
    return sorted(found)


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """words without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0)]


def cyclic(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """words, for one document in ten (by the CRC-32 of its id) made periodic from a place on: texts of known runs. A document
    without id is left as it is."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


_NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "words"]
_COLUMNS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs array<struct<start:long,length:long,period:long>>, words binary"


def periodic_runs(docs: DataFrame, least: int = LEAST, periods: int = PERIODS, planted: bool = False) -> DataFrame:
    """docs (doc_id, text, ...) -> a row for each row of docs: doc_id, n_runs; start, length, period and exponent_milli (floor of
    1000 * length / period) of the run with the greatest exponent (of equal ones the first, then that of the smaller period; null
    without runs); runs, all of them by start, then period; words, the text's words joined by a space, without those that a run
    holds after its first period.

    A run is a maximal stretch of words (runs of bytes other than white space) with a smallest period, of `least` words and
    `periods` (two or more) periods at least. A null or wordless text has no runs and empty words. planted: texts are changed by cyclic()
    first. Rows are judged by themselves, so repeated rows and ids give repeated results. Further columns are ignored. A text
    is held whole by one task, with about 100 bytes for each of its words."""
    if periods < 2:
        raise ValueError("a run has two periods at least")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, out = batch.column(0).to_pylist(), []
            for doc_id, value in zip(ids, batch.column(1), strict=True):
                words = (value.as_py() or "").encode().split()
                words = cyclic(words, doc_id) if planted else words
                found = word_runs(words, least, periods)
                best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
                out.append((len(found), *best, 1000 * best[1] // best[2] if found else None, [dict(zip(("start", "length", "period"), r, strict=True)) for r in found], b" ".join(collapsed(words, found))))
            kinds = [*[pa.int64()] * 5, pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True))], _NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _COLUMNS)
