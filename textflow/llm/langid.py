"""Language identification with bit-sliced Bloom filters over character n-grams.

A table of SLOTS entries holds the Bloom filters of 64 languages at once: bit l of a slot is the slot's bit in the filter
of language l; there are as many tables as the languages need. An n-gram reads its HASHES slots; the AND of them is the bitmask of all languages whose filter
contains it. For a text, the set bits of all its n-grams' masks are counted by language (with repeats), the number
expected from false positives alone (fill of the filter to the power of HASHES) is taken off, and the language with the
most left wins.

An n-gram enters a language's filter if enough of the language's training texts contain it, and no smaller a share of
them than a part of the share in the language where it is most frequent; so n-grams that only stray into a language
(quotes, names) don't count for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.llm._words import LOWER, SPACE, mix, powers, prefix_hash, texts

SLOTS, HASHES = 1 << 20, 3
#: Lengths of the n-grams in bytes, over lower-case words with a space on either side.
SIZES = (3, 4, 5)
#: Training texts of a language, at most about: a bounded sample by the hash of doc_id.
SAMPLE = 1500
#: Least share of a language's training texts with an n-gram, and least part of the largest share among languages.
LEAST_SHARE, LEAST_PART = 0.004, 0.5
UNKNOWN = "und"
_WORDLESS = SPACE.copy()
_WORDLESS[[*range(0x21, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def grams(t, sizes=SIZES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of the n-grams of each size: of runs of letters and non-ASCII bytes, lower case, one space before and
    after; white space, digits and ASCII marks part runs."""
    if not len(t.data):
        return
    data = LOWER[t.data]
    gap = _WORDLESS[t.data]
    first = np.zeros(len(data), bool)
    first[t.starts[t.ends > t.starts]] = True
    keep = ~gap | np.r_[True, ~gap[:-1]] | first
    last = np.zeros(len(data), bool)
    last[t.ends[t.ends > t.starts] - 1] = True
    # each kept gap byte becomes one space; a text that starts or ends with a letter gets one there too
    row = np.repeat(np.arange(len(t)), t.ends - t.starts)
    at = np.flatnonzero(keep)
    body = np.where(gap[at], np.uint8(32), data[at])
    heads, tails = np.flatnonzero(first[at] & ~gap[at]), np.flatnonzero(last[at] & ~gap[at])
    edge, owner = np.concatenate([heads, tails + 1]), row[at[np.concatenate([heads, tails])]]
    order = np.lexsort((np.repeat([1, 0], [len(heads), len(tails)]), edge))  # a text's end before the next one's start
    body = np.insert(body, edge[order], np.uint8(32))
    row = np.insert(row[at], edge[order], owner[order])
    p = prefix_hash(body)
    space = np.cumsum(np.r_[0, body == 32])
    for n in sizes:
        if len(body) < n:
            continue
        i = np.arange(len(body) - n + 1)
        whole = (row[: len(i)] == row[n - 1 :]) & (space[i + n - 1] - space[i + 1] == 0)  # a space only at the ends
        i = i[whole]
        inverse = powers(len(p), pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64))
        yield row[i], mix((p[i + n] - p[i]) * inverse[i] + np.uint64(n))


def _slots(h: np.ndarray, k: int, slots: int) -> np.ndarray:
    """The k-th slot of each hash: double hashing."""
    return ((h & np.uint64(0xFFFFFFFF)) + np.uint64(k) * ((h >> np.uint64(32)) | np.uint64(1))) % np.uint64(slots)


def train(docs: DataFrame, sample: int = SAMPLE, slots: int = SLOTS, hashes: int = HASHES) -> dict:
    """docs (doc_id, text, lang) -> {"languages", "table": uint64 bitmasks, a row of slots for every 64 languages, "fill",
    "prior"}, for every language. Rows without text or lang don't count. The driver gets the tables' used slots, `slots` at
    most for every 64 languages."""
    spark = docs.sparkSession
    docs = docs.where("text is not null and lang is not null").withColumn("lang", F.col("lang").cast("string"))
    sizes = [(r.lang, r.n) for r in docs.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()]
    names = sorted(lang for lang, _ in sizes)
    empty = {"languages": names, "table": np.zeros((-(-len(names) // 64), slots), np.uint64), "fill": np.zeros(len(names)), "prior": sizes[0][0] if sizes else None}
    if not sizes:
        return empty
    hashed = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(3)), F.lit(1 << 30))
    below = spark.createDataFrame([(lang, int(min(1.0, sample / n) * (1 << 30))) for lang, n in sizes], "lang string, below long")
    index = {lang: i for i, lang in enumerate(names)}

    def tally(batches):
        for batch in batches:
            langs = np.array([index[x] for x in batch.column(1).to_pylist()], np.int64)
            for t in texts(batch.column(0)):
                for row, h in grams(t):
                    order = np.lexsort((h, row))
                    row, h = row[order], h[order]
                    new = np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])] if len(h) else np.empty(0, bool)
                    lang, h = langs[t.first + row[new]], h[new]
                    order = np.lexsort((lang, h))
                    lang, h = lang[order], h[order]
                    at = np.flatnonzero(np.r_[True, (lang[1:] != lang[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.empty(0, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(lang[at].astype(np.int32)), pa.array(np.diff(np.r_[at, len(h)]).astype(np.int64))], ["h", "lang", "n"])

    rows = docs.join(F.broadcast(below), "lang").where(hashed < F.col("below")).select("text", "lang")
    count = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    total = spark.createDataFrame([(index[lang], float(max(1, count.get(lang, 0)))) for lang in names], "lang int, total double")
    shares = rows.mapInArrow(tally, "h long, lang int, n long").groupBy("h", "lang").agg(F.sum("n").alias("n")).where("n >= 2")
    shares = shares.join(F.broadcast(total), "lang").withColumn("share", F.col("n") / F.col("total")).where(F.col("share") >= LEAST_SHARE)
    each = shares.groupBy("h").agg(F.max("share").alias("top"), F.collect_list(F.struct("lang", "share")).alias("all"))
    found = each.select("h", F.explode(F.expr(f"filter(all, x -> x.share >= {LEAST_PART} * top)")).alias("x")).select("h", "x.lang")

    def fill(batches):
        for batch in batches:
            h, lang = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().astype(np.int64)
            at = np.concatenate([lang // 64 * slots + _slots(h, k, slots).astype(np.int64) for k in range(hashes)])
            mask = np.tile(np.uint64(1) << (lang % 64).astype(np.uint64), hashes)
            order = np.argsort(at, kind="stable")
            at, mask = at[order], mask[order]
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, np.int64)
            if len(first):
                yield pa.RecordBatch.from_arrays([pa.array(at[first]), pa.array(np.bitwise_or.reduceat(mask, first).view(np.int64))], ["slot", "mask"])

    table = empty["table"]
    used = found.mapInArrow(fill, "slot long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    table.reshape(-1)[used.column(0).to_numpy()] = used.column(1).to_numpy().view(np.uint64)
    full = [((table[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(names))]
    return empty | {"fill": np.array(full)}


def predict(docs: DataFrame, model: dict, hashes: int = HASHES) -> DataFrame:
    """docs (doc_id, text, ...) -> (doc_id, lang_pred, score), a row for each row, by the whole text.

    A null text, or one without a letter (Unicode category L), is `und` with score 0, as is everything if the model has
    no language. A text of which no n-gram is known gets the most frequent training language with score 0. Ties go to the
    first language by name. The score is the winner's part of all languages' corrected counts."""
    names, table, prior = model["languages"], model["table"], model["prior"]
    false = np.asarray(model["fill"]) ** hashes
    piece = (1 << 26) // max(64, len(names))  # bytes of texts at once: fewer with many languages, as each text has a count for each

    def run(batches):
        for batch in batches:
            raw = batch.column(1).to_pylist()
            pred, score = [UNKNOWN] * len(raw), np.zeros(len(raw))
            for t in texts(batch.column(1), piece) if names else ():
                hits, n = np.zeros((len(t), len(names))), np.zeros(len(t))
                for row, h in grams(t):
                    slots = [_slots(h, k, table.shape[1]).astype(np.int64) for k in range(hashes)]
                    n += np.bincount(row, minlength=len(t))
                    for word, part in enumerate(table):
                        mask = part[slots[0]]
                        for at in slots[1:]:
                            mask &= part[at]
                        for i in range(64 * word, min(64 * word + 64, len(names))):
                            hits[:, i] += np.bincount(row[(mask >> np.uint64(i % 64) & np.uint64(1)).astype(bool)], minlength=len(t))
                rest = np.maximum((hits - n[:, None] * false) / np.maximum(1 - false, 1e-9), 0)
                best, total = rest.argmax(1), rest.sum(1)
                for j in range(len(t)):
                    i = t.first + j
                    if raw[i] is None or not any(map(str.isalpha, raw[i])):
                        continue
                    pred[i] = names[best[j]] if total[j] > 0 else prior
                    score[i] = rest[j, best[j]] / total[j] if total[j] > 0 else 0.0
            if raw:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
