"""Exact dense retrieval by blocked matrix products: the best k of each query and ranks of given candidates, in one pass.

Candidates stay where they are: a task reads them in batches, multiplies blocks of them with the queries, and keeps for each query
a heap of k and a count. Queries go to every task, in blocks of a checked size, each a pass. A block of candidates is left out
for a query whose kth best (or whose given candidate) it can't reach: no score exceeds the query's length times the longest
candidate's, nor the product with the block's centre plus the query's length times the block's radius (the triangle inequality).
Candidates that stand near one another, as clustered() puts them, have small radii.

Scores are dot products, or cosines of vectors scaled to length 1, rounded to `digits` if given; equal scores go by the smaller
cand_id. A null vector has no scores; a score that is not a number is none. Vectors of another length are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textflow.sources.shared import small_side

#: Bytes of the queries' vectors of one pass, candidates of a block, queries multiplied at once, sampled centres.
QUERY_BYTES, ROWS, QUERIES, CENTRES = 64 << 20, 1024, 4096, 256
#: Rows of positives up to which they go to every task.
PAIRS = 1_000_000


def matrix(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the column with a vector, their vectors)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    some = column.take(pa.array(rows))
    size = np.diff(some.offsets.to_numpy()) if len(rows) else np.zeros(0, int)
    dim = dim if dim is not None else int(size[0]) if len(size) else 0
    if (size != dim).any():
        raise ValueError(f"vectors of {sorted(set(size.tolist()))} values, not {dim}")
    return rows, some.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), dim)


def unit(v: np.ndarray, floor: float = 1e-12) -> np.ndarray:
    return v / np.maximum(np.sqrt((v * v).sum(1)), floor)[:, None]


def _query_blocks(queries: DataFrame, normalized: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of queries (query_id, v) in blocks of about half of QUERY_BYTES by the hash of the id; counted first."""
    queries = queries.where("v is not null").select(F.col("query_id").cast("long").alias("query_id"), F.col("v").cast("array<double>").alias("v"))
    n, dim = queries.agg(F.count("*"), F.max(F.size("v"))).first()
    blocks = 1 if n * (dim or 0) * 8 <= QUERY_BYTES else -(-2 * n * dim * 8 // QUERY_BYTES)
    for i in range(blocks if n else 0):
        table = (queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i)).toArrow()
        if table.num_rows:
            rows, v = matrix(table.column(1))
            yield table.column(0).to_numpy(), unit(v) if normalized else v


class _Heaps:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k, self.kth = k, np.full(n, -np.inf)
        self.query, self.score, self.id = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores: of some queries (rows) and candidates."""
        if not self.k or not scores.size:
            return
        least = self.kth[queries]
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        at, column = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
        if not len(at):
            return
        query = np.concatenate([self.query, queries[at]])
        score = np.concatenate([self.score, scores[at, column]])
        id_ = np.concatenate([self.id, ids[column]])
        order = np.lexsort((id_, -score, query))
        query, score, id_ = query[order], score[order], id_[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep = place < self.k
        self.query, self.score, self.id = query[keep], score[keep], id_[keep]
        full = place == self.k - 1
        self.kth[query[full]] = score[full]


def _pass(ids: np.ndarray, vectors: np.ndarray, candidates: DataFrame, k: int, normalized: bool, digits: int | None, wanted: dict[int, tuple[float, int]] | None) -> DataFrame:
    """One pass over candidates (cand_id, v) -> rows (query_id, cand_id, score, better, scored): each task's best k of each query,
    and a row without cand_id for each query with the number of candidates that are better than wanted[query_id] (score,
    cand_id) and of those that a product was made with."""
    bar_score = np.full(len(ids), np.inf)
    bar_id = np.zeros(len(ids), np.int64)
    for i, q in enumerate(ids.tolist()):
        if wanted and q in wanted:
            bar_score[i], bar_id[i] = wanted[q]
    shared = candidates.sparkSession.sparkContext.broadcast((ids, vectors, np.sqrt((vectors * vectors).sum(1)), bar_score, bar_id))
    slack = 1e-9 + (10.0**-digits if digits is not None else 0)

    def run(batches):
        ids, vectors, lengths, bar_score, bar_id = shared.value
        heaps, better, scored = _Heaps(len(ids), k), np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for batch in batches:
            rows, every = matrix(batch.column(1), vectors.shape[1])
            every = unit(every) if normalized else every
            cand = batch.column(0).to_numpy(zero_copy_only=False)[rows]
            for i in range(0, len(rows), ROWS):
                block, own = every[i : i + ROWS], cand[i : i + ROWS]
                centre = block.mean(0)
                radius = np.sqrt(((block - centre) ** 2).sum(1).max())
                longest = np.sqrt((block * block).sum(1).max())
                bound = np.minimum(lengths * longest, vectors @ centre + lengths * radius)
                bound = bound + slack * np.maximum(1, np.abs(bound))
                need = np.minimum(heaps.kth if k else np.inf, bar_score)
                active = np.flatnonzero(~(bound < need))
                for j in range(0, len(active), QUERIES):
                    some = active[j : j + QUERIES]
                    s = vectors[some] @ block.T
                    s = np.round(s, digits) if digits is not None else s
                    s[np.isnan(s) | (own[None, :] == ids[some][:, None])] = -np.inf
                    scored[some] += len(own)
                    better[some] += ((s > bar_score[some, None]) | (s == bar_score[some, None]) & (own[None, :] < bar_id[some, None]) & np.isfinite(s)).sum(1)
                    heaps.add(some, s, own)
        none = np.zeros(len(ids), bool)
        yield _rows(ids[heaps.query], heaps.id, heaps.score, np.zeros(len(heaps.id), np.int64), np.zeros(len(heaps.id), np.int64))
        yield _rows(ids, none, np.zeros(len(ids)), better, scored)

    return candidates.select(F.col("cand_id").cast("long").alias("cand_id"), F.col("v").cast("array<double>").alias("v")).mapInArrow(run, "query_id long, cand_id long, score double, better long, scored long")


def _rows(query, cand, score, better, scored) -> pa.RecordBatch:
    cand = pa.array(cand) if cand.dtype == np.int64 else pa.nulls(len(cand), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(query), cand, pa.array(score), pa.array(better), pa.array(scored)], ["query_id", "cand_id", "score", "better", "scored"])


def _union(frames: list[DataFrame], session, schema: str) -> DataFrame:
    out = None
    for df in frames:
        out = df if out is None else out.unionByName(df)
    return session.createDataFrame([], schema) if out is None else out


def _best(rows: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "cand_id")
    top = rows.where("cand_id is not null").select("query_id", "cand_id", "score").withColumn("rank", F.row_number().over(w))
    return top.where(F.col("rank") <= k)


def search(queries: DataFrame, candidates: DataFrame, k: int, normalized: bool = True, digits: int | None = None) -> DataFrame:
    """queries (query_id, v), candidates (cand_id, v) -> (query_id, cand_id, score, rank) of the k best candidates of each query,
    which is no candidate of its own. Each block of queries is a pass over the candidates."""
    passes = [_pass(ids, v, candidates, k, normalized, digits, None) for ids, v in _query_blocks(queries, normalized)]
    return _best(_union(passes, queries.sparkSession, "query_id long, cand_id long, score double"), k)


def _own_scores(queries: DataFrame, candidates: DataFrame, pairs: DataFrame, normalized: bool, digits: int | None) -> DataFrame:
    """Scores of the pairs (query_id, cand_id) alone, by the same arithmetic."""

    def run(batches):
        for batch in batches:
            good = batch.filter(pa.compute.and_(batch.column(2).is_valid(), batch.column(3).is_valid()))
            (_, q), (_, c) = matrix(good.column(2)), matrix(good.column(3))
            s = (unit(q) * unit(c) if normalized else q * c).sum(1)
            s = np.round(s, digits) if digits is not None else s
            yield pa.RecordBatch.from_arrays([*good.columns[:2], pa.array(s)], ["query_id", "cand_id", "score"]).filter(pa.array(~np.isnan(s)))

    q = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("v").cast("array<double>").alias("qv"))
    few = small_side(pairs.select(F.col("query_id").cast("long").alias("query_id"), F.col("cand_id").cast("long").alias("cand_id")).where("query_id <> cand_id").distinct(), PAIRS)
    both = candidates.select(F.col("cand_id").cast("long").alias("cand_id"), F.col("v").cast("array<double>").alias("cv")).join(few, "cand_id").join(q, "query_id")
    return both.select("query_id", "cand_id", "qv", "cv").mapInArrow(run, "query_id long, cand_id long, score double")


def _ranked(queries: DataFrame, candidates: DataFrame, own: DataFrame, k: int, normalized: bool, digits: int | None) -> DataFrame:
    """The rows of one pass for each block of queries, with the first of own (query_id, cand_id, score) as the wanted one."""
    order = F.struct((-F.col("score")).alias("s"), "cand_id")
    firsts = own.groupBy("query_id").agg(F.min(order).alias("first"))
    passes = []
    for ids, v in _query_blocks(queries, normalized):
        few = firsts if len(ids) == 0 else firsts.join(F.broadcast(queries.sparkSession.createDataFrame([(int(i),) for i in ids], "query_id long")), "query_id")  # a block of queries
        wanted = {r.query_id: (-r.first.s, r.first.cand_id) for r in few.toLocalIterator()}
        passes.append(_pass(ids, v, candidates, k, normalized, digits, wanted))
    return _union(passes, queries.sparkSession, "query_id long, cand_id long, score double, better long, scored long")


def ranks_of(queries: DataFrame, candidates: DataFrame, wanted: DataFrame, normalized: bool = True, digits: int | None = None) -> DataFrame:
    """wanted (query_id, cand_id), one candidate for each query (the best of several) -> (query_id, rank) of it among all."""
    own = _own_scores(queries, candidates, wanted, normalized, digits)
    rows = _ranked(queries, candidates, own, 0, normalized, digits)
    counts = rows.groupBy("query_id").agg((F.sum("better") + 1).alias("rank"))
    return counts.join(own.select("query_id").distinct(), "query_id", "left_semi")


def evaluate(queries: DataFrame, candidates: DataFrame, positives: DataFrame, ks: tuple[int, ...] = (1, 3, 5), normalized: bool = True, digits: int | None = None) -> DataFrame:
    """positives (query_id, cand_id) -> query_id, n_positive, recall@k and hit@k for each k, best_rank (the best positive's), for
    each query with a positive among the candidates. Scores of all candidates are made once; those of the positives before."""
    k = max(ks)
    own = _own_scores(queries, candidates, positives, normalized, digits)
    rows = _ranked(queries, candidates, own, k, normalized, digits)
    top = _best(rows, k).join(own.select("query_id", "cand_id"), ["query_id", "cand_id"], "left_semi")
    hits = top.groupBy("query_id").agg(*(F.count_if(F.col("rank") <= x).alias(f"hits_{x}") for x in ks))
    counts = rows.where("cand_id is null").groupBy("query_id").agg((F.sum("better") + 1).alias("best_rank"))
    out = own.groupBy("query_id").agg(F.count("*").alias("n_positive")).join(counts, "query_id").join(hits, "query_id", "left")
    n = lambda x: F.coalesce(f"hits_{x}", F.lit(0))
    return out.select("query_id", "n_positive", *((n(x) / F.col("n_positive")).alias(f"recall_{x}") for x in ks), *((n(x) > 0).alias(f"hit_{x}") for x in ks), "best_rank")


def clustered(candidates: DataFrame, centres: int = CENTRES, normalized: bool = True) -> DataFrame:
    """candidates (cand_id, v, ...) dealt out and sorted by their nearest centre, so that blocks have small radii and searches skip
    more; worth a shuffle for tables that are searched often. Centres are a bounded sample of the vectors; results are the same
    with any. Large clusters are split over tasks."""
    sample = candidates.where("v is not null").select(F.xxhash64("cand_id").alias("h"), F.col("v").cast("array<double>").alias("v")).orderBy("h").limit(centres).toArrow()
    if not sample.num_rows:
        return candidates
    _, middle = matrix(sample.column(1))
    middle = unit(middle) if normalized else middle
    names = candidates.columns

    def nearest(column: pa.Array) -> pa.Array:
        rows, v = matrix(column, middle.shape[1])
        v = unit(v) if normalized else v
        out = np.full(len(column), -1, np.int32)
        for i in range(0, len(rows), ROWS):
            some = v[i : i + ROWS]
            out[rows[i : i + ROWS]] = ((middle * middle).sum(1)[None, :] - 2 * some @ middle.T).argmin(1)
        return pa.array(out)

    marked = candidates.withColumn("__centre", F.arrow_udf(nearest, "int")(F.col("v").cast("array<double>")))
    return marked.repartitionByRange("__centre", F.xxhash64("cand_id")).sortWithinPartitions("__centre").select(*names)
