"""Retrieval evaluation: score queries against candidates, rank, recall and top k, compare runs.

Queries are a set of checked size that goes to every task; candidates are never moved. The top k of each query are kept
within tasks first (a limit by group before the shuffle), and a positive's rank is a count of better candidates, so no
task ever holds all candidates of a query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.functions.automaton import pieces
from textflow.functions.text import rounded
from textflow.sources.shared import cut, small_side

QUERIES = 100_000
#: Rows of a lookup (variants of candidates, terms of queries) up to which it goes to every task; parts of a token beyond.
VARIANTS, PARTS = 1_000_000, 32
#: Bytes of lower-case ASCII words.
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True


def score_all(queries: DataFrame, candidates: DataFrame, score: Column, most: int = QUERIES) -> DataFrame:
    """queries (query_id, ...) x candidates (cand_id, ...) -> query_id, cand_id, score. More than `most` queries (counted) go to
    the candidates in blocks of about half as many, by the hash of query_id."""
    few = queries.limit(most + 1).count() <= most
    blocks = 1 if few else -(-2 * queries.count() // most)
    out = None
    for i in range(blocks):
        block = queries if few else queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i)
        part = candidates.crossJoin(F.broadcast(block)).where(F.col("query_id") != F.col("cand_id")).withColumn("score", score)
        out = part if out is None else out.unionByName(part)
    return out


def top_k(scores: DataFrame, k: int, keys: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """The k best of each key, ties by cand_id, with rank from 1. A score that is null or not a number ranks last."""
    w = Window.partitionBy(*keys).orderBy(F.desc(F.nanvl("score", F.lit(float("-inf")))), "cand_id")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def recall(scores: DataFrame, positives: DataFrame | None = None, ks: tuple[int, ...] = (1, 3, 5), keys: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """positives (keys, cand_id), or a boolean column `positive` of scores -> keys, n_positive, recall@k, hit@k for each k, and
    best_rank, the best positive's.

    Scores are made three times, but only once for all candidates at a time: for the positives alone (best and worst kept),
    for the counts of candidates before the best positive and before the positives among the first max(ks)."""
    keys_of = list(keys)
    own = scores.where("positive") if positives is None else scores.join(positives, [*keys_of, "cand_id"], "left_semi")
    order = F.struct(F.col("score").alias("score"), (-F.col("cand_id")).alias("neg"))
    ranked = own.select(*keys_of, order.alias("o")).withColumn("k", F.row_number().over(Window.partitionBy(*keys_of).orderBy(F.desc("o"))))
    first = ranked.where(F.col("k") <= max(ks)).groupBy(*keys_of).agg(F.sort_array(F.collect_list("o"), asc=False).alias("o"))  # max(ks) at most
    n = (own if positives is None else positives).groupBy(*keys_of).agg(F.count("*").alias("n_positive"))
    before = [F.count_if(order > F.get("o", i)).alias(f"before{i}") for i in range(max(ks))]
    counts = scores.join(small_side(first, QUERIES), keys_of).groupBy(*keys_of).agg(F.any_value(F.size("o")).alias("n_first"), *before)
    hits = lambda k: sum((F.when((F.col("n_first") > i) & (F.col(f"before{i}") < k), 1).otherwise(0) for i in range(k)), F.lit(0)).cast("long")
    out = n.join(counts, keys_of).select("*", (F.col("before0") + 1).alias("best_rank"), *(hits(k).alias(f"hits{k}") for k in ks))
    return out.select(*keys, "n_positive", *((F.col(f"hits{k}") / F.col("n_positive")).alias(f"recall_{k}") for k in ks), *((F.col(f"hits{k}") > 0).alias(f"hit_{k}") for k in ks), "best_rank")


def first_rank(scores: DataFrame, firsts: DataFrame) -> DataFrame:
    """firsts (query_id, cand_id), the first-listed positive -> query_id, pos_rank."""
    own = scores.join(small_side(firsts, QUERIES), ["query_id", "cand_id"], "left_semi").select("query_id", F.col("score").alias("s"), F.col("cand_id").alias("c"))
    better = (F.col("score") > F.col("s")) | ((F.col("score") == F.col("s")) & (F.col("cand_id") < F.col("c")))
    return scores.join(small_side(own, QUERIES), "query_id").groupBy("query_id").agg((F.count_if(better) + 1).alias("pos_rank"))


def cluster_mean(scores: DataFrame, variants: DataFrame) -> DataFrame:
    """scores by variant (cand_id) and variants (cand_id, cluster) -> query_id, cand_id = cluster, the mean score. A candidate
    without a cluster is an error when its score is read."""
    lost = F.raise_error(F.concat(F.lit("no cluster for candidate "), F.col("cand_id").cast("string"))).cast(variants.schema["cluster"].dataType)
    found = scores.join(small_side(variants, VARIANTS), "cand_id", "left").withColumn("cluster", F.coalesce("cluster", lost))
    return found.groupBy("query_id", F.col("cluster").alias("cand_id")).agg(F.avg("score").alias("score"))


def sparse_scores(queries: DataFrame, docs: DataFrame) -> DataFrame:
    """(query_id, token, weight) x (cand_id, token, weight) -> sum of products over shared tokens; pairs without a shared
    token are absent, as their score is 0. Terms of queries up to VARIANTS (counted) go to the documents' tasks, so that a
    frequent token is no task's burden; more are joined by token and a part of the documents, which splits it as well."""
    asked = queries.withColumnRenamed("weight", "query_weight")
    if queries.limit(VARIANTS + 1).count() <= VARIANTS:
        both = docs.join(F.broadcast(asked), "token")
    else:
        spread = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        both = docs.withColumn("part", F.pmod(F.xxhash64("cand_id"), F.lit(PARTS)).cast("int")).join(spread, ["token", "part"])
    return both.groupBy("query_id", "cand_id").agg(F.sum(F.col("weight") * F.col("query_weight")).alias("score"))


def term_weights(df: DataFrame, key: str, text: str, only: DataFrame | None = None) -> DataFrame:
    """Term counts of lower-case ASCII words; only: (token), the words that count, before anything is shuffled."""
    words = F.explode(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]+"), F.lit(0)))
    rows = df.select(key, words.alias("token"))
    if only is not None:
        rows = rows.join(small_side(only.select("token").distinct(), VARIANTS), "token", "left_semi")
    return rows.groupBy(key, "token").agg(F.count("*").cast("double").alias("weight"))


def term_lists(df: DataFrame, key: str, text: str, only: DataFrame | None = None) -> DataFrame:
    """As term_weights(), with the words of each row of df in lists (key, tokens, weights): words are counted within a row,
    nothing is shuffled, and rows of the same key aren't added up. A row without a word that counts has empty lists."""
    shared = None
    if only is not None:
        known = only.select("token").na.drop().distinct().limit(VARIANTS + 1).toArrow().column(0).combine_chunks()
        if len(known) > VARIANTS:
            return term_weights(df, key, text, only).select(key, F.array("token").alias("tokens"), F.array("weight").alias("weights"))
        shared = df.sparkSession.sparkContext.broadcast(known)
    kind = T.StructType([df.schema[key], T.StructField("tokens", T.ArrayType(T.StringType())), T.StructField("weights", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            for first, data, begin in pieces(batch.column(1)):
                letter = _LOWER[data]
                edge = np.diff(np.concatenate([[False], letter, [False]]).view(np.int8))
                start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                at = np.append(0, np.cumsum(end - start)).astype(np.int32)
                word = pa.StringArray.from_buffers(len(start), pa.py_buffer(at), pa.py_buffer(data[letter]))
                if shared is None:
                    word = word.dictionary_encode()
                    names, code = word.dictionary, word.indices.to_numpy()
                else:
                    names = shared.value
                    code = pc.index_in(word, value_set=names).fill_null(-1).to_numpy()
                row = np.searchsorted(begin, start, "right") - 1
                pair, times = np.unique((row * (len(names) or 1) + code)[code >= 0], return_counts=True)
                row, code = np.divmod(pair, len(names) or 1)
                ends = pa.array(np.searchsorted(row, np.arange(len(begin))).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, x) for x in (names.take(pa.array(code)), pa.array(times.astype(np.float64)))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(begin) - 1), *lists], kind.names)

    return df.select(key, F.lower(F.coalesce(text, F.lit("")))).mapInArrow(run, kind)


def hybrid(parts: dict[str, DataFrame], weights: dict[str, float]) -> DataFrame:
    """Weighted sum of scores by (query_id, cand_id); a part without the pair counts 0."""
    rows = None
    for name, df in parts.items():
        one = df.select("query_id", "cand_id", (F.col("score") * float(weights[name])).alias("score"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("query_id", "cand_id").agg(F.sum("score").alias("score"))


def agreement(tops: DataFrame, k: int = 10) -> DataFrame:
    """tops (run, query_id, rank, cand_id) -> for each two runs: queries, same_topk (equal lists), same_top1 and ratios."""
    lists = tops.where(F.col("rank") <= k).groupBy("run", "query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "cand_id"))), lambda x: x.cand_id).alias("top"))
    a, b = lists.select("query_id", F.col("run").alias("run_a"), F.col("top").alias("a")), lists.select("query_id", F.col("run").alias("run_b"), F.col("top").alias("b"))
    pairs = a.join(b, "query_id").where("run_a < run_b")
    n = F.count("*")
    return pairs.groupBy("run_a", "run_b").agg(n.alias("queries"), F.count_if(F.col("a") == F.col("b")).alias("same_topk"), F.count_if(F.col("a")[0] == F.col("b")[0]).alias("same_top1"), rounded(F.count_if(F.col("a") == F.col("b")) / n, 4).alias("topk_ratio"), rounded(F.count_if(F.col("a")[0] == F.col("b")[0]) / n, 4).alias("top1_ratio"))


def canonical(groups: DataFrame) -> DataFrame:
    """All distinct candidates of groups (positive, negative) with their place in text order: cand_id from 0, text. The order is
    made by ranges; places follow from the counts of the ranges before, so that no task sorts all."""
    texts = groups.select(F.explode(F.concat(F.coalesce("positive", F.array().cast("array<string>")), F.coalesce("negative", F.array().cast("array<string>")))).alias("text"))
    sorted_ = cut(texts.where("text is not null").distinct().repartitionByRange("text").withColumn("part", F.spark_partition_id()), "candidates")
    sizes = sorted_.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    offsets = sizes.select("part", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("text")) - 1
    return sorted_.withColumn("own", place).join(F.broadcast(offsets), "part").select((F.col("before") + F.col("own")).alias("cand_id"), "text")
