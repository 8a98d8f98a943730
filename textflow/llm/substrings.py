"""Repeated byte strings across a corpus, by a sparse suffix array over content-defined positions.

A string of LENGTH bytes counts as repeated if it starts at two places at least, in one document or in two. Sorting the
suffixes of all positions would move LENGTH bytes for each byte of text, so only anchors are sorted: of the starts of
BLOCK-byte blocks inside each LENGTH-byte string, the one with the least hash (the leftmost of equals). An anchor depends
on nothing but the string, so equal strings have equal anchors at equal offsets, and no repeat is lost.

1. Equal texts are one text from the start, with a key of its own; where it has two rows, all of it is repeated.
2. A suffix's sort key is its leading eight bytes, then a fingerprint of its block, then one of its context, which is all
   that any string over this block can cover. Splitters from a bounded sample range-partition the suffixes by that order; a
   key with many suffixes is split like any other. Each range is sorted (Spark's sort, which spills) and neighbours are
   compared, within a range and across the boundary to the next. A block without an equal neighbour is no repeat; equal
   contexts settle an anchor, since all strings over its block are repeats.
3. What is left are suffixes near the ends of repeats, one of each context. They are dealt out by the same splitters with
   their bytes, sorted by multikey quicksort, eight bytes at a time, once to the right of the anchor and once to the left;
   common prefixes of neighbours then tell which strings are equal, at every offset, byte by byte.
4. A block with more than MANY contexts is split: strings that reach up to o bytes to the left of the anchor are dealt out by
   the bytes they must share, in two halves of their offsets, and again, until groups are small or all of a group is equal.
5. The union of the repeated strings is cut from each document.

Contexts and texts are equal if their fingerprints of 160 and 256 bits are. Memory: a batch, or the contexts of one block up
to MANY, 7 MB.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.llm._shared import cut, small_side, with_group
from textflow.llm._words import mix, prefix_hash, texts, window

LENGTH, BLOCK = 200, 64
#: Texts and anchors in the sample that the splitters come from, about: at least so many, and at least so many for each range.
SAMPLE, SPLITTERS = 2000, 50_000
TEXTS_EACH, ANCHORS_EACH = 1, 20
#: Contexts of a block beyond which they aren't gathered in one task.
MANY = 20_000
#: A second base for fingerprints of 128 bits.
_OTHER = 0xD1342543DE82EF95
CAND, TWIN, SHIP, NEW_C, FIRST_K, LAST_K, FIRST_C, LAST_C, FIRST_ROW, LAST_ROW = (1 << i for i in range(10))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for every i with a full window."""
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(x) - width + 1], out[width - have : width - have + len(x) - width + 1])


def anchors(column: pa.Array, length: int, block: int):
    """(row, position in the text, leading eight bytes as a number, block's fingerprint, context's fingerprint) of every anchor
    of a string column, piece by piece."""
    reach = length - block
    for t in texts(column):
        n = len(t.data)
        if n < length:
            continue
        p = prefix_hash(t.data)
        starts = np.arange(n - block + 1)
        h = window(p, starts, starts + block)
        bits = np.uint64(max(21, n.bit_length()))
        tagged = (h >> bits << bits) | starts.astype(np.uint64)
        least = (_sliding_min(tagged, reach + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        mark = np.zeros(n, bool)
        row_of = np.repeat(np.arange(len(t), dtype=np.int32), t.ends - t.starts)
        inside = np.arange(len(least)) + length <= t.ends[row_of[: len(least)]]
        mark[least[inside]] = True
        at = np.flatnonzero(mark)
        if not len(at):
            continue
        row = row_of[at]
        lo, hi = np.maximum(at - reach, t.starts[row]), np.minimum(at + length, t.ends[row])
        lead = np.zeros(len(at), np.uint64)
        for i in range(min(8, block)):
            lead = lead << np.uint64(8) | t.data[at + i].astype(np.uint64)
        context = mix(window(p, lo, hi) + (at - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        yield t.first + row, at - t.starts[row], (lead ^ np.uint64(1 << 63)).view(np.int64), (h[at] >> np.uint64(32)).astype(np.uint32).view(np.int32), context.view(np.int64)


def _place(columns: list[np.ndarray], cuts: np.ndarray) -> np.ndarray:
    """Number of cuts (rows, sorted by all columns) that lie before each row of columns."""
    if not columns or not len(cuts):
        return np.zeros(len(columns[0]) if columns else 0, np.int64)
    low, high = np.searchsorted(cuts[:, 0], columns[0], "left"), np.searchsorted(cuts[:, 0], columns[0], "right")
    out = low.copy()
    for i in np.unique(low[high > low]):
        rows = np.flatnonzero((low == i) & (high > low))
        if len(columns) > 1:
            out[rows] += _place([c[rows] for c in columns[1:]], cuts[i : high[rows[0]], 1:])
    return out


def _suffixes(distinct: DataFrame, length: int, block: int, cuts: np.ndarray, part: float = 1.0) -> DataFrame:
    """distinct (tid, text) -> (pid, k, h, c, tid, a): the anchor at a, and the range of its suffix; part: of all anchors, by
    hash."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, a, k, h, c in anchors(batch.column(1), length, block):
                tid = ids[row]
                if part < 1:
                    some = mix((tid << 20 ^ a).view(np.uint64)) < np.uint64(int(part * 2**63) << 1)
                    tid, a, k, h, c = (x[some] for x in (tid, a, k, h, c))
                pid = _place([k, h, c, tid, a], cuts)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (pid.astype(np.int32), k, h, c, tid, a.astype(np.int32))], ["pid", "k", "h", "c", "tid", "a"])

    return distinct.select("tid", "text").mapInArrow(run, "pid int, k long, h int, c long, tid long, a int")


def _splitters(distinct: DataFrame, length: int, block: int, n: int) -> np.ndarray:
    """Up to n - 1 rows (k, h, c, tid, a) that part the suffixes into about equal ranges: all of the sample's, if it has fewer
    suffixes. The sample grows with n; the driver gets about max(SPLITTERS, ANCHORS_EACH * n) rows of 36 bytes."""
    sizes = distinct.select("tid", F.octet_length("text").alias("size"), (F.pmod(F.xxhash64("tid"), F.lit(1 << 30)) / F.lit(1 << 30)).alias("u"))
    total = sizes.count()
    share = min(1.0, max(SAMPLE, TEXTS_EACH * n) / max(total, 1))
    size = sizes.where(F.col("u") < share).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    some = distinct.where(F.pmod(F.xxhash64("tid"), F.lit(1 << 30)) / F.lit(1 << 30) < share)
    sample = _suffixes(some, length, block, np.empty((0, 5), np.int64), min(1.0, max(SPLITTERS, ANCHORS_EACH * n) * (length - block) / 2 / max(size, 1)))
    rows = sample.select("k", F.col("h").cast("long"), "c", "tid", F.col("a").cast("long")).toArrow()
    keys = np.stack([x.to_numpy() for x in rows.columns], 1) if rows.num_rows else np.empty((0, 5), np.int64)
    keys = np.unique(keys, axis=0)
    return keys[np.unique(np.linspace(0, len(keys), min(n, len(keys)) + 1).astype(int)[1:-1])] if len(keys) else keys


def _runs(batches, columns: int) -> Iterator[list[np.ndarray]]:
    """Batches sorted by their first two columns -> arrays in which no run of equal first two values is cut."""
    held: list[np.ndarray] = []
    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)]
        if not len(new[0]):
            continue
        now = [np.concatenate(x) for x in zip(held, new, strict=True)] if held else new
        other = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
        last = int(other[-1]) + 1 if len(other) else 0
        if last:
            yield [x[:last] for x in now]
        held = [x[last:] for x in now]
    if held and len(held[0]):
        yield held


def _neighbours(suffixes: DataFrame) -> DataFrame:
    """Rows of one range, sorted by (k, h, c) -> those with a neighbour of an equal block, with flags; also the first and
    last runs, whose neighbours in other ranges are still to be seen."""

    def run(batches):
        chunk, first = None, True

        def flagged(chunk, first, last):
            k, h, c, tid, a, pid = chunk
            new_k = np.r_[True, (k[1:] != k[:-1]) | (h[1:] != h[:-1])]
            new_c = new_k | np.r_[True, c[1:] != c[:-1]]
            run_k, run_c = np.cumsum(new_k) - 1, np.cumsum(new_c) - 1
            cand, twin = (np.bincount(run_k) >= 2)[run_k], (np.bincount(run_c) >= 2)[run_c]
            open_ = np.zeros(run_k[-1] + 1, bool)
            open_[run_k[~twin]] = True
            flags = cand * CAND | twin * TWIN | (cand & open_[run_k] & new_c) * SHIP | new_c * NEW_C
            if first:
                flags |= (run_k == 0) * FIRST_K | (run_c == 0) * FIRST_C
                flags[0] |= FIRST_ROW
            if last:
                flags |= (run_k == run_k[-1]) * LAST_K | (run_c == run_c[-1]) * LAST_C
                flags[-1] |= LAST_ROW
            keep = flags & (CAND | FIRST_K | LAST_K) > 0
            return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (pid, k, h, c, tid, a, flags.astype(np.int32))], ["pid", "k", "h", "c", "tid", "a", "flags"])

        for now in _runs(batches, 6):
            if chunk is not None:
                yield flagged(chunk, first, False)
                first = False
            chunk = now
        if chunk is not None:
            yield flagged(chunk, first, True)

    return suffixes.select("k", "h", "c", "tid", "a", "pid").mapInArrow(run, "pid int, k long, h int, c long, tid long, a int, flags int")


def _across(found: DataFrame) -> DataFrame:
    """found with the flags of runs that go on in the next range; rows without an equal neighbour are dropped.
    The driver gets the first and the last row of each range."""
    ends = found.where(F.col("flags").bitwiseAND(FIRST_ROW | LAST_ROW) != 0).select("pid", "flags", "k", "h", "c").collect()
    first = {r.pid: (r.k, r.h, r.c) for r in ends if r.flags & FIRST_ROW}
    last = {r.pid: (r.k, r.h, r.c) for r in ends if r.flags & LAST_ROW}
    pids = sorted(first)
    joined = {"k": [], "c": []}
    for a, b in zip(pids, pids[1:], strict=False):
        if last[a][:2] == first[b][:2]:
            joined["k"].append((a, b))
            if last[a] == first[b]:
                joined["c"].append((a, b))

    def goes_on(what, first_bit, last_bit):
        left, right = [b for _, b in joined[what]], [a for a, _ in joined[what]]
        has = lambda bit: F.col("flags").bitwiseAND(bit) != 0
        return (F.col("pid").isin(left) & has(first_bit)) | (F.col("pid").isin(right) & has(last_bit))

    on = goes_on("k", FIRST_K, LAST_K)
    flags = F.col("flags")
    out = found.select(
        "k", "h", "tid", "a", ((flags.bitwiseAND(CAND) != 0) | on).alias("cand"),
        ((flags.bitwiseAND(TWIN) != 0) | goes_on("c", FIRST_C, LAST_C)).alias("twin"),
        ((flags.bitwiseAND(SHIP) != 0) | (on & (flags.bitwiseAND(NEW_C) != 0))).alias("ship"),
    )
    return out.where("cand").drop("cand")


_SPANS = "array<struct<start: bigint, end: bigint>>"
_MEMBER = "tid long, a int, left int, twin boolean, context binary"
_MEMBERS = ("tid", "a", "left", "twin", "context")


def _contexts(distinct: DataFrame, wanted: DataFrame, length: int, block: int, cuts: np.ndarray) -> DataFrame:
    """The contexts of the anchors wanted (tid, k, h, a, twin) -> (pid, k, h, tid, a, left, twin, context); pid is the range of
    the suffix's block, which no cut parts."""
    reach = length - block
    cuts = np.unique(cuts[:, :2], axis=0)

    def run(batches):
        for batch in batches:
            out = []
            for tid, doc, todo in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                raw = doc["text"].encode()
                for x in todo:
                    low = max(0, x["a"] - reach)
                    out.append((x["k"], x["h"], tid, x["a"], x["a"] - low, x["twin"], raw[low : x["a"] + length]))
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
                columns = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                pid = _place([columns[0].to_numpy(), columns[1].to_numpy()], cuts).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(pid), *columns], ["pid", "k", "h", *_MEMBERS])

    todo = wanted.groupBy("tid").agg(F.collect_list(F.struct("k", "h", "a", "twin")).alias("todo"))
    return _by_tid(distinct).join(todo.hint("shuffle_hash"), "tid").select("tid", "doc", "todo").mapInArrow(run, f"pid int, k long, h int, {_MEMBER}")


def _by_tid(distinct: DataFrame) -> DataFrame:
    """(tid, doc): the same columns and filter for every join by tid, so that the texts are shuffled once for all."""
    return distinct.where("tid is not null").select("tid", F.struct("doc_id", "n", "text").alias("doc"))


def multikey_order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """rows (n x bytes, zeros beyond their end) -> their order by multikey quicksort, eight bytes at a time (only rows tied so
    far are sorted by the next eight), and the common prefix of each with the one before it in that order (0 for the first)."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8").astype(np.uint64)
    order, group = np.arange(n), np.zeros(n, np.int64)
    for d in range(words.shape[1]):
        tied = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(tied):
            break
        own = order[tied]
        own = own[np.lexsort((words[own, d], group[tied]))]
        order[tied] = own
        new = np.zeros(n, bool)
        new[tied[1:]] = words[own[1:], d] != words[own[:-1], d]
        new[1:] |= group[1:] != group[:-1]
        group = np.cumsum(new)
    same = rows[order[1:]] == rows[order[:-1]]
    common = np.where(same.all(1), width, same.argmin(1)) if width else np.zeros(max(n - 1, 0), np.int64)
    return order, np.r_[0, common][:n]


def _aligned(left: np.ndarray, context: list[bytes], reach: int, length: int):
    """Contexts -> bytes from the anchor to the right and to the left (reversed), with their lengths."""
    data = np.frombuffer(b"".join(context), np.uint8)
    size = np.fromiter(map(len, context), np.int64, len(context))
    at = np.cumsum(size) - size + left
    right = size - left

    def matrix(n, width, sign, first):
        step = np.arange(width)
        inside = step < n[:, None]
        out = np.zeros((len(n), width), np.uint8)
        out[inside] = data[((at + first)[:, None] + sign * step)[inside]]
        return out

    return matrix(right, length, 1, 0), right, matrix(left, reach, -1, -1), left


def repeats(left: np.ndarray, context: list[bytes], twin: np.ndarray, reach: int, length: int, first: int = 0):
    """Contexts that start `left` bytes before their anchors -> (member, least, most): of the members that aren't twins, how
    far to the left of the anchor the strings of `length` bytes start that another member has, too. Offsets under `first`
    are left out."""
    right_bytes, right, left_bytes, left = _aligned(left.astype(np.int64), context, reach, length)
    n = len(left)

    def ranks(rows):
        order, common = multikey_order(rows)
        back = np.empty(n, np.int64)
        back[order] = np.arange(n)
        return lambda depth: np.cumsum(common < depth)[back]

    of_right, of_left = ranks(right_bytes), ranks(left_bytes)
    least, most = np.full(n, reach + 1), np.full(n, -1)
    for o in range(first, reach + 1):
        own = np.flatnonzero((left >= o) & (right >= length - o))
        if len(own) < 2:
            continue
        key = of_right(length - o)[own] * (n + 1) + of_left(o)[own]
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        again = own[np.unique(np.r_[order[1:][same], order[:-1][same]])]
        least[again] = np.minimum(least[again], o)
        most[again] = o
    member = np.flatnonzero((most >= 0) & ~twin.astype(bool))
    return member, least[member], most[member]


def _spans(tid, a, member, least, most, length) -> pa.RecordBatch:
    a = a[member].astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(tid[member]), pa.array(a - most), pa.array(a - least + length)], ["tid", "start", "end"])


def _spans_of_blocks(contexts: DataFrame, length: int, block: int) -> DataFrame:
    """Contexts with all of a block in one partition, sorted by block -> (tid, start, end) of repeats."""

    def run(batches):
        for k, h, tid, a, left, twin, context in _runs(batches, 7):
            edge = np.r_[np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (h[1:] != h[:-1])]), len(k)]
            i = 0
            while i < len(k):
                j = int(edge[np.searchsorted(edge, min(i + 2000, len(k)))])
                yield _spans(tid[i:j], a[i:j], *repeats(left[i:j], list(context[i:j]), twin[i:j], length - block, length), length)
                i = j

    return contexts.select("k", "h", *_MEMBERS).mapInArrow(run, "tid long, start long, end long")


def _fingerprints(data: np.ndarray, start: np.ndarray, end: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each data[start:end] with its tag."""
    salt = mix(tag.astype(np.uint64) + np.uint64(1))
    return mix(window(prefix_hash(data), start, end) ^ salt).view(np.int64), mix(window(prefix_hash(data, _OTHER), start, end, _OTHER) + salt).view(np.int64)


def _halves(contexts: DataFrame, length: int) -> DataFrame:
    """(low, high, members): strings that start low to high bytes before the anchor, as (k1, k2, low, high, x1, x2, members) for
    each half of these offsets: k of the bytes that all such strings share, x of all the bytes that they cover."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            low, high, tid, a, left, twin = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            low, high, left = (x.astype(np.int64) for x in (low, high, left))
            context = batch.column(6).to_pylist()
            size = np.fromiter(map(len, context), np.int64, len(context))
            data = np.frombuffer(b"".join(context), np.uint8)
            at = np.cumsum(size) - size + left
            right = size - left
            middle = (low + high) // 2
            for lo, hi in ((low, middle), (middle + 1, high)):
                own = np.flatnonzero((lo <= hi) & (left >= lo) & (right >= length - hi))
                if not len(own):
                    continue
                lo, hi, p = lo[own], hi[own], at[own]
                start, end = p - np.minimum(hi, left[own]), p + np.minimum(length - lo, right[own])
                k1, k2 = _fingerprints(data, p - lo, p + length - hi, lo)
                x1, x2 = _fingerprints(data, start, end, p - start)
                raw = data.tobytes()
                columns = [pa.array(x) for x in (k1, k2, lo.astype(np.int32), hi.astype(np.int32), x1, x2, tid[own], a[own], (p - start).astype(np.int32), twin[own].astype(bool))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([raw[i:j] for i, j in zip(start, end, strict=True)], pa.binary())], ["k1", "k2", "low", "high", "x1", "x2", *_MEMBERS])

    return contexts.select("low", "high", *_MEMBERS).mapInArrow(run, f"k1 long, k2 long, low int, high int, x1 long, x2 long, {_MEMBER}")


def _spans_of_halves(rows: DataFrame, length: int, block: int) -> DataFrame:
    """The same as _spans_of_blocks() for groups (k1, k2) of _halves()."""

    def run(batches):
        for k1, k2, low, tid, a, left, twin, context in _runs(batches, 8):
            edge = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]), True])
            for i, j in zip(edge[:-1], edge[1:], strict=True):
                yield _spans(tid[i:j], a[i:j], *repeats(left[i:j], list(context[i:j]), twin[i:j], length - block, length, int(low[i])), length)

    return rows.select("k1", "k2", "low", *_MEMBERS).mapInArrow(run, "tid long, start long, end long")


def _spans_of_large_blocks(contexts: DataFrame, length: int, block: int, many: int) -> DataFrame:
    """Contexts of blocks with more than many of them -> (tid, start, end) of repeats, in up to log2(length - block) + 1 rounds."""
    rows = contexts.select(F.lit(0).alias("low"), F.lit(length - block).alias("high"), *_MEMBERS)
    out = None
    while True:
        parts = cut(_halves(rows, length), "halves")
        groups = parts.groupBy("k1", "k2").agg(F.count("*").alias("n"), (F.min(F.struct("x1", "x2")) == F.max(F.struct("x1", "x2"))).alias("equal")).where("n > 1")
        sized = cut(with_group(parts, cut(groups.withColumn("size", F.col("n")), "groups"), ["k1", "k2"], F.col("tid"), ["size", "equal"]).where("size > 1"), "halves")
        settled = sized.where("equal and not twin")
        least_end = F.col("a") - F.col("left") + F.octet_length("context")
        found = settled.select("tid", (F.col("a") - F.col("left")).cast("long").alias("start"), least_end.cast("long").alias("end"))
        usual = sized.where(~F.col("equal") & (F.col("size") <= many))
        found = found.unionByName(_spans_of_halves(usual.repartition("k1", "k2").sortWithinPartitions("k1", "k2"), length, block))
        out = found if out is None else out.unionByName(found)
        rows = sized.where(~F.col("equal") & (F.col("size") > many))
        if not rows.limit(1).count():
            return out


def repeated_spans(docs: DataFrame, length: int = LENGTH, block: int = BLOCK, many: int | None = None) -> DataFrame:
    """docs (doc_id, text, ...) -> (doc_id, n_bytes, spans array<struct<start, end>>, kept binary), a row for each row.

    Texts are UTF-8 bytes; a null or empty one has no bytes and no spans. spans are the maximal runs of bytes covered by a
    string of `length` bytes that also starts anywhere else, judged on the input; kept is the rest. Equal rows, and rows with
    one text or one doc_id, are documents of their own and repeat each other; a null doc_id is a document like any other. Further
    columns are ignored, an empty table gives an empty one."""
    spark, many = docs.sparkSession, MANY if many is None else many
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long")).withColumn("digest", F.when(F.col("n_bytes") >= length, F.sha2("text", 256)))
    long = rows.where("digest is not null").groupBy("digest").agg(F.first("text").alias("text"), F.first("doc_id").alias("doc_id"), F.count("*").alias("n"))
    distinct = cut(long.withColumn("tid", F.monotonically_increasing_id()), "texts")
    cuts = _splitters(distinct, length, block, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = _suffixes(distinct, length, block, cuts).repartitionById(len(cuts) + 1, "pid").sortWithinPartitions("k", "h", "c")
    marks = _across(cut(_neighbours(dealt), "suffixes"))
    wanted = marks.where("ship").select("tid", "k", "h", "a", "twin")
    large = cut(wanted.groupBy("k", "h").agg(F.count("*").alias("n")).where(F.col("n") > many).select("k", "h"), "large")
    some = large.limit(1).count() > 0
    usual = wanted.join(small_side(large, 1_000_000), ["k", "h"], "left_anti") if some else wanted
    contexts = _contexts(distinct, usual, length, block, cuts)
    spans = _spans_of_blocks(contexts.repartitionById(len(cuts) + 1, "pid").sortWithinPartitions("k", "h"), length, block)
    if some:
        hot = wanted.join(small_side(large, 1_000_000), ["k", "h"], "left_semi")
        spans = spans.unionByName(_spans_of_large_blocks(_contexts(distinct, hot, length, block, cuts), length, block, many))
    settled = marks.where("twin").select("tid", F.greatest(F.col("a") - (length - block), F.lit(0)).cast("long").alias("start"), (F.col("a") + length).cast("long").alias("end"))
    per_text = settled.unionByName(spans).groupBy("tid").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    none = F.array().cast(_SPANS)
    short = rows.where("digest is null").select("doc_id", "n_bytes", none.alias("spans"), F.encode("text", "UTF-8").alias("kept"))
    repeated = distinct.where("n > 1").select("digest", "n", F.col("n").alias("rows"))
    again = with_group(rows.where("digest is not null").select("doc_id", "n_bytes", "digest"), repeated, ["digest"], F.coalesce("doc_id", F.hash("digest")), ["rows"]).where("rows > 1")
    again = again.select("doc_id", "n_bytes", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))).cast(_SPANS).alias("spans"), F.lit(b"").alias("kept"))

    def apply(batches):
        for batch in batches:
            out = []
            for doc, found in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                if doc["n"] != 1:  # here and not in a filter, which would give the shuffle below another plan
                    continue
                raw = doc["text"].encode()
                merged: list[list[int]] = []
                for start, end in sorted((x["start"], min(x["end"], len(raw))) for x in found or ()):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(end, merged[-1][1])
                    else:
                        merged.append([start, end])
                at, kept = 0, []
                for start, end in merged:
                    kept.append(raw[at:start])
                    at = end
                out.append((doc["doc_id"], len(raw), [{"start": s, "end": e} for s, e in merged], b"".join([*kept, raw[at:]])))
            for i in range(0, len(out), 1000):
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out[i : i + 1000], strict=True), kinds, strict=True)], ["doc_id", "n_bytes", "spans", "kept"])

    once = _by_tid(distinct).join(per_text, "tid", "left").select("doc", "found")
    once = once.mapInArrow(apply, f"doc_id long, n_bytes long, spans {_SPANS}, kept binary")
    return short.unionByName(again).unionByName(once)
