"""Exact top-k search for binary codes by incremental multi-index hashing.

A vector's code has a bit for each dimension, set where it is positive. Codes are dealt to shards; a shard's codes are
parted into segments of about log2(codes) bits, and each segment's values are indexed. For a query the segments are looked
up with 0, 1, 2, ... of their bits changed: after radius r in all of s segments, every code within distance
s * (r + 1) - 1 has been verified (pigeonhole), so a query is done once its kth verified distance is at most that.
A task goes from shard to shard with the best k so far, so that later shards need smaller radii; the best k of all tasks
are merged. Nothing is approximate: ties at the kth distance go to the smaller ids.

Rows with one code are one entry with its k smallest ids, as no others can be among a query's k; so a code that a third of
all rows have is no larger than another. Queries come in blocks of QUERIES, which every task gets: a pass over the index for
each block, whose results are written before the next, so that the driver holds one block.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textflow.llm._shared import cut, new_path

#: Codes in a shard, and queries in a block (at 64 bits: 4 MB for each task).
SHARD, QUERIES = 1 << 18, 1 << 18
#: Codes for which another task is worthwhile, up to the cluster's cores.
LEAST = 1 << 12


def code(vector: Column, bits: int) -> Column:
    """The signs of `bits` values as binary; missing and null values count as not positive."""
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: F.when(F.coalesce(F.get(vector, i) > 0, F.lit(False)), F.lit("1")).otherwise(F.lit("0"))), "")
    pieces = [F.lpad(F.conv(F.substring(text, 1 + i, 32), 2, 16), 8, "0") for i in range(0, bits, 32)]
    return F.unhex(F.concat(*pieces))


def _masks(width: int, r: int) -> np.ndarray:
    return np.array([sum(1 << i for i in c) for c in itertools.combinations(range(width), r)], np.int64)


class Shard:
    """An index of codes (rows of 32-bit words) with their ids (a list for each, ascending)."""

    def __init__(self, words: np.ndarray, ids: list[list[int]]):
        self.words, self.ids = words, ids
        bits = words.shape[1] * 32
        width = max(1, min(24, round(math.log2(max(len(words), 2)))))
        self.segments = math.ceil(bits / width)
        self.edges = [round(i * bits / self.segments) for i in range(self.segments + 1)]
        self.tables = []
        for low, high in itertools.pairwise(self.edges):
            values = self.segment(words, low, high)
            order = np.argsort(values, kind="stable")
            self.tables.append((order, np.searchsorted(values[order], np.arange((1 << high - low) + 1))))
        self.masks: dict[tuple[int, int], np.ndarray] = {}

    @staticmethod
    def segment(words: np.ndarray, low: int, high: int) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for bit in range(low, high):
            out = out << 1 | (words[:, bit // 32] >> np.uint32(31 - bit % 32) & np.uint32(1)).astype(np.int64)
        return out

    def search(self, query: np.ndarray, k: int, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The k smallest (distance, id) of `best` and this shard."""
        values = [int(self.segment(query[None], low, high)[0]) for low, high in itertools.pairwise(self.edges)]
        seen = np.zeros(len(self.words), bool)
        widest = max(high - low for low, high in itertools.pairwise(self.edges))
        for r in range(widest + 1):
            if r and len(best) >= k and best[k - 1][0] <= self.segments * r - 1:
                break
            found = []
            for (low, high), value, (order, at) in zip(itertools.pairwise(self.edges), values, self.tables, strict=True):
                if r > high - low:
                    continue
                if (high - low, r) not in self.masks:
                    self.masks[high - low, r] = _masks(high - low, r)
                probe = value ^ self.masks[high - low, r]
                start, size = at[probe], at[probe + 1] - at[probe]
                full = size > 0
                start, size = start[full], size[full]
                if len(start):
                    i = np.repeat(start - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
                    found.append(order[i])
            if not found:
                continue
            new = np.unique(np.concatenate(found))
            new = new[~seen[new]]
            seen[new] = True
            far = np.bitwise_count(self.words[new] ^ query).sum(1, dtype=np.int64)
            limit = best[k - 1][0] if len(best) >= k else 1 << 30
            near = np.flatnonzero(far <= limit)
            if len(near) > k:
                near = near[far[near] <= np.partition(far[near], k - 1)[k - 1]]
            more = [(int(far[j]), x) for j in near for x in self.ids[new[j]]]
            best = sorted({*best, *more})[:k]
        return best


def search(index: DataFrame, queries: DataFrame, k: int = 10, bits: int | None = None, shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """index, queries (vec_id, embedding, ...) -> (query_id, rank, vec_id, distance): for each distinct query id the k rows
    of the index whose codes are nearest in Hamming distance, ties by vec_id; rank from 1.

    bits: a bit for each dimension; by default the longest vector's number of dimensions in either table, so that none is
    cut; what a shorter vector lacks counts as not positive. Rows with a null id or vector are left out of the index and the
    queries; ids that repeat with equal codes count once. A query finds its own row if the index has it. With fewer than k
    rows, all are returned; an empty table gives an empty one."""
    spark = index.sparkSession
    index, queries = (df.where("vec_id is not null and embedding is not null") for df in (index, queries))
    if bits is None:
        widest = [df.agg(F.max(F.size("embedding"))).first()[0] or 1 for df in (index, queries)]
        bits = max(widest)
    bits = -(-bits // 32) * 32
    coded = index.select(F.col("vec_id").cast("long").alias("vec_id"), code(F.col("embedding"), bits).alias("code")).distinct()
    least = coded.withColumn("r", F.row_number().over(Window.partitionBy("code").orderBy("vec_id"))).where(F.col("r") <= k)
    entries = cut(least.groupBy("code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "codes")
    n = entries.count()
    tasks = max(-(-n // shard), min(spark.sparkContext.defaultParallelism, -(-n // LEAST)), 1)
    entries = cut(entries.repartition(tasks), "shards")
    asked = cut(queries.select(F.col("vec_id").cast("long").alias("query_id"), code(F.col("embedding"), bits).alias("code")).distinct(), "queries")

    def ask(ids: np.ndarray, words: np.ndarray) -> DataFrame:
        def run(batches):
            best: list[list[tuple[int, int]]] = [[] for _ in ids]
            codes, lists, size = [], [], 0

            def through():
                data = np.frombuffer(b"".join(itertools.chain.from_iterable(codes)), ">u4").astype(np.uint32).reshape(-1, bits // 32)
                part = Shard(data, list(itertools.chain.from_iterable(lists)))
                for i, query in enumerate(words):
                    best[i] = part.search(query, k, best[i])

            for batch in batches:
                codes.append(batch.column(0).to_pylist()), lists.append(batch.column(1).to_pylist())
                size += batch.num_rows
                if size >= shard:
                    through()
                    codes, lists, size = [], [], 0
            if size:
                through()
            for i in range(0, len(ids), 1000):
                rows = [(int(q), d, x) for q, b in zip(ids[i : i + 1000], best[i : i + 1000], strict=True) for d, x in b]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["query_id", "distance", "vec_id"])

        return entries.select("code", "ids").mapInArrow(run, "query_id long, distance long, vec_id long")

    def answered(ids: list[int], codes: list[bytes]) -> None:
        found = ask(np.array(ids, np.int64), np.frombuffer(b"".join(codes), ">u4").astype(np.uint32).reshape(len(ids), bits // 32))
        found.write.mode("append").parquet(path)

    path = new_path(spark, "found")
    ids, codes = [], []
    for r in asked.toLocalIterator():
        ids.append(r.query_id), codes.append(bytes(r.code))
        if len(ids) == block:
            answered(ids, codes)
            ids, codes = [], []
    answered(ids, codes)
    found = spark.read.schema("query_id long, distance long, vec_id long").parquet(path)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "distance")
