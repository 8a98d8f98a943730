"""Exact sparse retrieval: a partitioned inverted index with block maxima, and searches that read only the blocks they must.

Documents are dealt out to parts. In a part they are numbered from the heaviest down and cut into windows of ROWS; each token's
postings are sorted by number, with the largest and the smallest weight in each window. A query's bound for a window is the
sum of what its tokens can add there; windows are scored from the highest bound on, until the next bound is under the kth best
score. As heavy documents share windows, most bounds are low early. A part is one task, and its size is bounded by the number
of parts, which follows from the number of postings; a frequent token's postings are spread over all parts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textflow.sources.shared import cut, small_side

#: Documents of a window, postings of a part at most, about, and rows of queries of one pass.
ROWS, POSTINGS, TERMS = 16, 2_000_000, 1_000_000
#: Postings from which a part is worth its own task.
LEAST_POSTINGS = 250_000

_INDEX = "part int, token string, n long, numbers binary, weights binary, windows binary, starts binary, highs binary, lows binary"
_NAMES = [c.split()[0] for c in _INDEX.split(", ")]


def index(docs: DataFrame, rows: int = ROWS, postings: int = POSTINGS) -> DataFrame:
    """docs (cand_id, token, weight), or (cand_id, tokens, weights) with lists -> an index for search(), a table that may be
    written: for each part and token its postings with block maxima, and for each part a row without token, with its documents'
    ids. The weights of repeated (cand_id, token) add up; what has a null, or a weight that is no number, is left out. docs is
    read once, to a table of its own: the number of its postings is needed before they are dealt out."""
    if "tokens" not in docs.columns:
        docs = docs.select("cand_id", F.array("token").alias("tokens"), F.array("weight").alias("weights"))
    docs = docs.select(F.col("cand_id").cast("long").alias("cand_id"), "tokens", F.col("weights").cast("array<double>").alias("weights"), F.size("tokens").alias("n"))
    docs = cut(docs.na.drop().where("n > 0"), "postings")
    n = docs.agg(F.sum("n")).first()[0] or 0
    parts = max(1, min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // LEAST_POSTINGS), -(-n // postings))

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        part = table.column(0)[0].as_py()
        tokens, weights = (table.column(i).combine_chunks() for i in (2, 3))
        own = np.repeat(table.column(1).to_numpy(), tokens.value_lengths().to_numpy())
        column, weight = tokens.flatten(), weights.flatten().to_numpy(zero_copy_only=False)  # a null is a NaN
        whole = column.is_valid().to_numpy(zero_copy_only=False) & ~np.isnan(weight)
        if not whole.any():
            return
        own, column, weight = own[whole], column.filter(pa.array(whole)).dictionary_encode(), weight[whole]
        ids, own = np.unique(own, return_inverse=True)
        total = np.bincount(own, np.abs(weight), len(ids))
        order = np.lexsort((ids, -total))
        number = np.empty(len(ids), np.int64)
        number[order] = np.arange(len(ids))
        names, token, number = column.dictionary.to_pylist(), column.indices.to_numpy(), number[own]
        at = np.lexsort((number, token))
        token, number, weight = token[at], number[at], weight[at]
        new = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (number[1:] != number[:-1])])
        token, number, weight = token[new], number[new], np.add.reduceat(weight, new)
        block = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (number[1:] // rows != number[:-1] // rows)])
        high, low = np.maximum.reduceat(weight, block), np.minimum.reduceat(weight, block)
        first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        out = [(part, None, len(ids), ids[order].tobytes(), *[b""] * 5)]
        for i, j in zip(first, [*first[1:], len(token)], strict=True):
            b, e = np.searchsorted(block, [i, j])
            out.append((part, names[token[i]], int(j - i), number[i:j].astype(np.int32).tobytes(), weight[i:j].tobytes(), (number[block[b:e]] // rows).astype(np.int32).tobytes(), (block[b:e] - i).astype(np.int32).tobytes(), high[b:e].tobytes(), low[b:e].tobytes()))
        kinds = (pa.int32(), pa.string(), pa.int64(), *[pa.binary()] * 6)
        for i in range(0, len(out), 2000):
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out[i : i + 2000], strict=True), kinds, strict=True)], _NAMES)

    dealt = docs.select(F.pmod(F.xxhash64("cand_id"), F.lit(parts)).cast("int").alias("part"), "cand_id", "tokens", "weights")
    return dealt.repartitionById(parts, "part").mapInArrow(run, _INDEX)


class _Part:
    """The postings of some tokens in one part: lists behind one another, and so are their blocks."""

    def __init__(self, rows: int):
        self.rows, self.ids, self.tokens, self.lists, self.blocks = rows, np.empty(0, np.int64), [], [], {}

    def add(self, token, *arrays) -> None:
        if token is None:
            self.ids = np.frombuffer(arrays[0], np.int64)
        else:
            self.tokens.append(token)
            self.lists.append(arrays)

    def close(self) -> None:
        """To be called once all lists are there."""
        kinds = (np.int32, np.float64, np.int32, np.int32, np.float64, np.float64)
        lists = [[np.frombuffer(x[i], kind) for x in self.lists] for i, kind in enumerate(kinds)]
        sizes = [len(x) for x in lists[0]]
        ends = np.cumsum([0, *(len(x) for x in lists[2])])
        self.blocks = {t: (ends[i], ends[i + 1], n) for i, (t, n) in enumerate(zip(self.tokens, sizes, strict=True))}
        lists[3] = [x + first for x, first in zip(lists[3], np.cumsum([0, *sizes]), strict=False)]
        self.numbers, self.weights, self.windows, starts, self.highs, self.lows = (np.concatenate([np.empty(0, kind), *x]) for x, kind in zip(lists, kinds, strict=True))
        self.starts, self.counts = starts, np.diff(np.append(starts, len(self.numbers)))
        self.lists = []

    def best(self, terms: list[tuple[str, float]], k: int, own_id: int) -> tuple[np.ndarray, np.ndarray, int, int]:
        """(ids, scores) of the k best for one query, its postings read and all its postings."""
        lists = [(w, *self.blocks[t]) for t, w in terms if t in self.blocks]
        ids, scores, kth, read, at, step = np.empty(0, np.int64), np.empty(0), -np.inf, 0, 0, 4
        if not lists:
            return ids, scores, 0, 0
        block = np.concatenate([np.arange(b, e) for _, b, e, _ in lists])
        w = np.repeat([x[0] for x in lists], [e - b for _, b, e, _ in lists])
        window = self.windows[block]
        there = np.bincount(window)
        bound = np.bincount(window, np.maximum(w * np.where(w >= 0, self.highs[block], self.lows[block]), 0))
        bound += 1e-9 * (1 + np.abs(bound))
        order = np.flatnonzero(there)
        order = order[np.argsort(-bound[order], kind="stable")]
        place = np.empty(len(there), np.int32)
        place[order] = np.arange(len(order))
        place = place[window]
        turn = np.argsort(place.astype(np.uint16) if len(order) <= 1 << 16 else place, kind="stable")  # a window's blocks stay in the order of terms
        block, w, place, ends = block[turn], w[turn], place[turn], np.append(0, np.cumsum(there[order]))
        start, count = self.starts[block], self.counts[block]
        while at < len(order) and not (len(ids) == k and bound[order[at]] < kth):
            to = min(at + step, len(order))
            these = slice(ends[at], ends[to])
            n = count[these]
            total = int(n.sum())
            rows = np.repeat(start[these] - (np.cumsum(n) - n), n) + np.arange(total)
            slot = np.repeat((place[these] - at) * self.rows, n) + self.numbers[rows] % self.rows
            acc = np.bincount(slot, np.repeat(w[these], n) * self.weights[rows])
            slot = np.flatnonzero(np.bincount(slot))
            new = self.ids[order[at + slot // self.rows] * self.rows + slot % self.rows]
            keep = new != own_id
            ids, scores = np.concatenate([ids, new[keep]]), np.concatenate([scores, acc[slot][keep]])
            top = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[top], scores[top]
            kth = scores[-1] if len(ids) == k else -np.inf
            at, step, read = to, 2 * step, read + total
        return ids, scores, read, sum(x[3] for x in lists)


def _answers(queries: DataFrame, built: DataFrame, k: int, rows: int, same: bool) -> DataFrame:
    """Rows (query_id, cand_id, score, read, total): each part's k best of each query, and a row without cand_id with the numbers
    of its postings that were read and of all."""
    table = queries.groupBy("query_id", "token").agg(F.sum("weight").alias("weight")).toArrow()
    asked: dict[int, list[tuple[str, float]]] = {}
    for q, token, w in zip(*(c.to_pylist() for c in table.columns), strict=True):
        asked.setdefault(q, []).append((token, w))
    tokens = built.sparkSession.createDataFrame([(t,) for t in sorted({t for x in asked.values() for t, _ in x})], "token string")
    shared = built.sparkSession.sparkContext.broadcast({q: sorted(x) for q, x in asked.items()})
    wanted = built.join(small_side(tokens, TERMS), "token", "left_semi").unionByName(built.where("token is null"))

    def run(batches):
        now, part = None, None

        def told():
            part.close()
            out = []
            for q, terms in shared.value.items():
                ids, scores, read, total = part.best(terms, k, q if same else None)
                out += [(q, c, s, 0, 0) for c, s in zip(ids.tolist(), scores.tolist(), strict=True)]
                out.append((q, None, 0.0, read, total))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)], ["query_id", "cand_id", "score", "read", "total"])

        for batch in batches:
            for number, token, _, *arrays in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != now:
                    if part is not None and shared.value:
                        yield told()
                    now, part = number, _Part(rows)
                part.add(token, *arrays)
        if part is not None and shared.value:
            yield told()

    tasks = int(built.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wanted.select(*_NAMES).repartitionById(tasks, "part").sortWithinPartitions("part").mapInArrow(run, "query_id long, cand_id long, score double, read long, total long")


def _passes(queries: DataFrame, built: DataFrame, k: int, rows: int, same: bool, terms: int) -> DataFrame:
    queries = queries.select(F.col("query_id").cast("long").alias("query_id"), "token", F.col("weight").cast("double").alias("weight")).na.drop()
    n = queries.count()
    blocks = 1 if n <= terms else -(-2 * n // terms)
    out = None
    for i in range(blocks):
        one = _answers(queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i), built, k, rows, same)
        out = one if out is None else out.unionByName(one)
    return out


def search(queries: DataFrame, built: DataFrame, k: int, rows: int = ROWS, same: bool = False, terms: int = TERMS) -> DataFrame:
    """queries (query_id, token, weight), built: an index() with the same `rows` -> (query_id, cand_id, score, rank) of the k best
    documents of each query: sums of products over shared tokens, ties by cand_id. Documents without a shared token are none.
    Weights may be negative. same: ids of both are of one kind, and a query isn't found itself. Queries of more than `terms` rows
    (counted) take a pass over the index for each block of about half as many."""
    found = _passes(queries, built, k, rows, same, terms).where("cand_id is not null")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "cand_id")
    return found.select("query_id", "cand_id", "score").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def postings_read(queries: DataFrame, built: DataFrame, k: int, rows: int = ROWS, terms: int = TERMS) -> DataFrame:
    """query_id, read, total: the postings that search() reads for a query and all that its tokens have."""
    found = _passes(queries, built, k, rows, False, terms).where("cand_id is null")
    return found.groupBy("query_id").agg(F.sum("read").alias("read"), F.sum("total").alias("total"))
