"""Target-distribution importance resampling: documents drawn by how much more likely their hashed n-grams are in a target.

A feature is a run of one to three consecutive words; its bucket is the CRC-32 of its bytes modulo BUCKETS. The first pass
counts buckets: each partition gives one vector (np.bincount) and treeReduce adds the vectors up, so that the driver gets one
vector of BUCKETS numbers whatever the size of the corpus. The logarithm of a bucket's ratio between target and corpus, with a
count of one more for each, is its gain. The second pass looks up the gains, which go to every task, and sums them for each
document (np.bincount with weights). A draw without replacement is the top of the weights with Gumbel noise made from the
document's id: no state, so a task that runs again gives the same noise.

CRC-32 is linear: the value of a joined text follows from those of its parts and the length of the last. So each word is
hashed once, and the runs of two and three come from table lookups over whole batches.
"""

from __future__ import annotations

import functools
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.llm._shared import cut
from textflow.llm._words import LOWER, Texts, Words, texts, words

BUCKETS, ORDERS, SEED = 10_000, 3, 42
#: A word's bytes, after A-Z are lower-cased: digits, letters, everything above ASCII.
GAP = np.ones(256, bool)
GAP[0x30:0x3A] = GAP[0x61:0x7B] = GAP[0x80:] = False
#: Bytes up to which words are hashed side by side, and of which shift tables are kept.
SHORT = 48


def _table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _table()


def _apply(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map, given as four tables of 256, on CRC values."""
    return tables[0][c & 255] ^ tables[1][(c >> 8) & 255] ^ tables[2][(c >> 16) & 255] ^ tables[3][c >> 24]


@functools.cache
def _shifts() -> np.ndarray:
    """[n, place, byte]: what the byte of a CRC value becomes when n zero bytes follow; n up to SHORT + 1."""
    c = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    out = [c]
    for _ in range(SHORT + 1):
        out.append(c := _CRC[c & 255] ^ (c >> 8))
    return np.stack(out)


def _shift_far(c: int, n: int) -> int:
    """c followed by n zero bytes, by squaring the map of one of them."""
    step = _shifts()[1]
    while n:
        if n & 1:
            c = int(_apply(step, np.array([c], np.uint32))[0])
        n >>= 1
        if n:
            step = _apply(step, step)
    return c


def word_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """zlib.crc32 of each word."""
    n = end - start
    out = np.zeros(len(n), np.uint32)
    order = np.argsort(-np.minimum(n, SHORT + 1), kind="stable")
    length, at = n[order], start[order]
    first = int(np.searchsorted(-np.minimum(length, SHORT + 1), -SHORT))  # longer ones stand before it
    for i in order[:first]:
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes())
    c = np.full(len(n) - first, 0xFFFFFFFF, np.uint32)
    length, at = length[first:], at[first:]
    for k in range(int(length[0]) if len(length) else 0):
        m = int(np.searchsorted(-length, -k))  # words of more than k bytes
        c[:m] = _CRC[(c[:m] ^ data[at[:m] + k]) & 255] ^ (c[:m] >> 8)
    out[order[first:]] = c ^ np.uint32(0xFFFFFFFF)
    return out


def joined(left: np.ndarray, right: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC values of left + right, the right part having n bytes."""
    flat = _shifts().reshape(-1)
    base = np.minimum(n, SHORT + 1).astype(np.int64) * 1024
    out = flat[base + (left & 255)] ^ flat[base + 256 + ((left >> 8) & 255)] ^ flat[base + 512 + ((left >> 16) & 255)] ^ flat[base + 768 + (left >> 24)]
    for i in np.flatnonzero(n > SHORT + 1):
        out[i] = _shift_far(int(left[i]), int(n[i]))
    return out ^ right


def features(t: Texts, buckets: int = BUCKETS, orders: int = ORDERS) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of a piece, and (row, bucket) of its features."""
    data = LOWER[t.data]
    w = words(Texts(t.first, np.where(GAP[data], np.uint8(32), data), t.starts, t.ends))
    crc = word_crcs(data, w.start, w.end)
    space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    after = joined(space, crc, w.end - w.start)  # " word"
    rows, found, now = [w.row], [crc % np.uint32(buckets)], crc
    for k in range(1, orders):
        if len(crc) <= k:
            break
        now = joined(now[:-1], after[k:], (w.end - w.start)[k:] + 1)
        inside = w.row[k:] == w.row[:-k]
        rows.append(w.row[k:][inside])
        found.append((now % np.uint32(buckets))[inside])
    return w, np.concatenate(rows), np.concatenate(found).astype(np.int64)


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, orders: int = ORDERS) -> np.ndarray:
    """Features of all texts by bucket. Vectors are added up in a tree of levels of about a hundred, so no task and not the
    driver gets more than that many of them."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for t in texts(batch.column(0)):
                total += np.bincount(features(t, buckets, orders)[2], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    parts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "counts binary").rdd.map(lambda r: np.frombuffer(r.counts, np.int64))
    n = parts.getNumPartitions()
    return parts.treeReduce(np.add, depth=max(2, math.ceil(math.log(n, 100)))) if n else np.zeros(buckets, np.int64)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio) of each bucket."""
    s_all, t_all, k = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(s_all + k) / (float(s + 1) * float(t_all + k)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 times a Gumbel number) from the first 32 bits of sha256("seed:doc_id")."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weighed(docs: DataFrame, gain: np.ndarray, orders: int = ORDERS, seed: int = SEED) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_words, n_features, weight, score; the gains go to every task (8 bytes each)."""
    shared = docs.sparkSession.sparkContext.broadcast(gain.astype(np.float64))

    def run(batches):
        of = shared.value
        for batch in batches:
            out = []
            for t in texts(batch.column(1)):
                w, rows, found = features(t, len(of), orders)
                weight = np.bincount(rows, of[found], len(t)) if len(rows) else np.zeros(len(t))
                out.append((w.count, np.bincount(rows, minlength=len(t)), weight))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out, strict=True))], ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")
    return rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def ranked(rows: DataFrame, order: list[Column], most: int) -> DataFrame:
    """rows in the order given, with rank from 1 where it is up to `most`, else null. Ranges of rows are sorted by themselves;
    a range's first rank is the number of rows in those before it, so no task has more than its range. Row numbers in a range
    are those of monotonically_increasing_id: 33 bits below the partition's number."""
    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id()), "ranges")
    part, at = F.shiftright("__place", 33), F.col("__place").bitwiseAND((1 << 33) - 1)
    sizes = {r.part: r.n for r in placed.groupBy(part.alias("part")).agg((F.max(at) + 1).alias("n")).collect()}  # a row for each range
    spark, before, offsets = rows.sparkSession, 0, []
    for p in sorted(sizes):
        offsets.append((p, before))
        before += sizes[p]
    offsets = F.broadcast(spark.createDataFrame(offsets, "__part long, __before long"))
    rank = F.col("__before") + at + 1
    return placed.join(offsets, part == F.col("__part")).select(*rows.columns, F.when(rank <= most, rank).alias("rank"))


def drawn(rows: DataFrame, percent: int = 5, least_words: int = 20) -> DataFrame:
    """rows of weighed() -> with rank, 1 for the highest score, of the floor(percent * N / 100) documents drawn; N are those
    with doc_id and at least least_words words. Only rows from an estimated score up, counted to be enough, are ordered."""
    fit = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    n, least = rows.where(fit).agg(F.count("*"), F.percentile_approx("score", max(0.0, 1 - percent / 100 - 0.01), 1000)).first()
    most = percent * n // 100
    if not most:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    enough = rows.where(fit & (F.col("score") >= least)).count() >= most
    top = F.coalesce(fit & (F.col("score") >= least) if enough else fit, F.lit(False))
    rest = rows.where(~top).withColumn("rank", F.lit(None).cast("long"))
    return ranked(rows.where(top), [F.desc("score"), F.col("doc_id")], most).unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = SEED, buckets: int = BUCKETS, orders: int = ORDERS) -> DataFrame:
    """docs (doc_id, text, ...), target (text, ...) -> a row for each row of docs: doc_id, n_words, n_features, weight, score, rank.

    Words are runs of digits, ASCII letters (A-Z lower-cased) and code points above ASCII. A null or wordless text has no
    features and weight 0. A row without doc_id counts in the corpus and has a weight, but no score and no rank. Equal scores
    go by the smaller doc_id; rows with a doc_id in common that tie are ranked in any order. An empty target has no
    features, so gains fall with a bucket's count; empty docs give an empty table. Further columns are ignored. A text is
    held whole by one task, with about 60 bytes for each of its words beside it."""
    gain = gains(bucket_counts(docs, "text", buckets, orders), bucket_counts(target, "text", buckets, orders))
    return drawn(cut(weighed(docs, gain, orders, seed), "weights"), percent, least_words)
