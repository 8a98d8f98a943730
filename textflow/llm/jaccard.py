"""Exact Jaccard join of word-shingle sets by prefix lists, with blocks skipped by position and answers taken over between sets.

Sets are ordered by one order of all shingles, rare ones first (by counters over all documents, then by hash). Of two sets with
a similarity of t or more, the first common shingle is within the first n - ceil(t * n) + 1 of each (n shingles), so only these
are listed: for each shingle the sets that have it there, with size and position. A list is sorted by size, then position; what
is left of both sets from a common position on bounds what they share, so of each size a list is read up to a position, and
sizes out of range not at all. Pairs that meet in a list are compared by bits first (whether an odd number of a set's
shingles falls on a place): places that differ bound from below how much two sets differ. Then they are compared by their sets.

Relations between sets save the rest. Equal sets are one from the start. In the first round each list has one pivot, the same in
most lists, and only pairs with it are compared. What is linked by then is a component, and only pairs of different components
are looked for in the lists from there on: in long lists a few nearest for each set, then all that are left. So groups of copies, however
large, take few pairs. A set's answers are derived from those of a pivot that it is linked with: once the pivot's overlap
with a third set is known, the set's own follows from the differences of both to the pivot, without its shingles.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textflow.llm._shared import cut, rows_a_batch, small_side, with_group
from textflow.llm._words import mix
from textflow.llm.components import components
from textflow.llm.neardup import _runs, shingle_sets

#: Counters of shingles that order them, a power of two: more make hot shingles of larger corpora stand out.
COUNTERS = 1 << 18
#: Places of the bits that lists carry.
SHORT = 1024
#: Nearest sets of other components in a long list that a set is compared with, in the rounds before the last.
FEW = (2, 4)
#: Rows of a list up to which all its pairs are looked at, over many lists at a time; rows of a longer one that one task reads.
SMALL, LIST = 64, 16_384
#: Pairs of sets in an Arrow batch: two sets take some 10 KB, those of long documents up to a megabyte.
BATCH = 256
#: Ids up to which a table is broadcast.
BROADCAST_IDS = 500_000


def shingle_levels(docs: DataFrame, size: int, counters: int = COUNTERS) -> np.ndarray:
    """How often the shingles of a counter are found in docs (text), as a power of two: one byte for each counter. A shingle's
    counter is given by the low bits of its hash. Each partition adds up its own counts first."""

    def run(batches):
        total = np.zeros(counters, np.int64)
        for batch in batches:
            for _, _, _, values in shingle_sets(batch.column(0), size):
                total += np.bincount((values & np.uint64(counters - 1)).astype(np.int64), minlength=counters)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["counter", "n"])

    sums = docs.select("text").mapInArrow(run, "counter int, n long").groupBy("counter").agg(F.ceil(F.log2(F.sum("n") + F.lit(1))).cast("int").alias("level"))
    out = np.zeros(counters, np.uint8)
    for batch in sums.toArrow().to_batches():  # a row for each counter at most
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out


def prefix_length(n, percent: int):
    """Shingles of a set of n among which the first common one with a set of `percent` or more must be."""
    return n + (-percent * n) // 100 + 1


def needed(n, m, percent: int):
    """Common shingles that sets of n and m need for a similarity of `percent` in 100."""
    return -(-percent * (n + m) // (100 + percent))


def prefixes(docs: DataFrame, percent: int, size: int, levels: np.ndarray) -> DataFrame:
    """docs (doc_id, text) -> doc_id, th (the text's hash), n_shingles, d1, d2 (digests of the set), prefix (the hashes of its first
    shingles in order, eight bytes each), bits (for each remainder of the hashes whether an odd number has it, of SHORT remainders or
    about as many as shingles) and short (the same of SHORT)."""
    shared, low = docs.sparkSession.sparkContext.broadcast(levels), np.uint64(len(levels) - 1)

    def run(batches):
        of = shared.value
        for batch in batches:
            n, d1, d2, prefix, bits, short = [], [], [], [], [], []
            for _, m, rows, values in shingle_sets(batch.column(2), size):
                count = np.bincount(rows, minlength=m)
                sums = np.zeros((2, m), np.uint64)
                if len(values):
                    has, at = np.flatnonzero(count), np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                    sums[0, has] = np.add.reduceat(mix(values), at)
                    sums[1, has] = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), at)
                begin = np.cumsum(count) - count
                level = of[(values & low).astype(np.int64)]
                for i in range(m):
                    a, b = begin[i], begin[i] + count[i]
                    order = np.argsort(level[a:b], kind="stable")[: prefix_length(int(count[i]), percent)]  # values are sorted
                    prefix.append(values[a:b][order].tobytes())
                    width = max(SHORT, 1 << (int(count[i]) - 1).bit_length())
                    odd = (np.bincount((values[a:b] & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8)
                    bits.append(np.packbits(odd, bitorder="little").tobytes())
                    short.append(np.packbits(odd.reshape(-1, SHORT).sum(0) & 1, bitorder="little").tobytes())
                n.append(count), d1.append(sums[0].view(np.int64)), d2.append(sums[1].view(np.int64))
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(np.concatenate(x).astype(np.int64)) for x in (n, d1, d2)), *(pa.array(x, pa.binary()) for x in (prefix, bits, short))], ["doc_id", "th", "n_shingles", "d1", "d2", "prefix", "bits", "short"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    return rows.mapInArrow(run, "doc_id long, th long, n_shingles long, d1 long, d2 long, prefix binary, bits binary, short binary")


def lists(nodes: DataFrame) -> DataFrame:
    """nodes (node, n, prefix) -> (key, node, n, at): the lists of shingles that more than one set has among its first."""

    def run(batches):
        for batch in batches:
            size = np.array([len(x) // 8 for x in batch.column(2).to_pylist()], np.int64)
            if not size.sum():
                continue
            keys = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64)
            at = np.arange(len(keys)) - np.repeat(np.cumsum(size) - size, size)
            yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(np.repeat(batch.column(i).to_numpy(), size)) for i in (0, 1)), pa.array(at.astype(np.int32))], ["key", "node", "n", "at"])

    every = nodes.select("node", "n", "prefix").mapInArrow(run, "key long, node long, n long, at int")
    many = every.groupBy("key").agg(F.count("*").alias("length")).where("length > 1")
    return every.join(many, "key").select("key", "node", "n", "at", "length")


def unskipped(n: int, p: int, sizes: np.ndarray, begin: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """The rows of a list that a set of size n may be similar to, if the list's shingle, at p in it, is the first that both have: then
    at most min(n - p, m - q) are common. The list's blocks have equal sizes m (`sizes`, from begin to the next) and are
    sorted by position q (`at`); a block out of range is skipped, of another its rows up to a position are left."""
    out = []
    for k in range(*np.searchsorted(sizes, [-(-n * percent // 100), n * 100 // percent + 1])):
        m = int(sizes[k])
        need = needed(n, m, percent)
        if n - p >= need:
            out.append(np.arange(begin[k], begin[k] + np.searchsorted(at[begin[k] : begin[k + 1]], m - need, "right")))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _allowed(n, m, percent: int):
    """How many shingles sets of n and m with a similarity of `percent` may differ in."""
    return n + m - 2 * needed(n, m, percent)


def _bits(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(len(column), -1)


def _batch(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b"])


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def star_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """rows (key, node, n, at, length) -> distinct (a, b), a < b: each list's pivot, the node with the smallest hash, with the others
    that may have `percent` by their sizes and positions. Long lists are dealt to several tasks, each with the pivot, and read in
    batches."""
    order = F.xxhash64("node", F.lit(13))
    first = rows.withColumn("k", F.row_number().over(Window.partitionBy("key").orderBy(order, "node"))).where("k = 1")  # cut off before the shuffle, too
    parts = F.ceil(F.col("length") / LIST).cast("int")
    heads = first.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn("head", F.lit(True))
    tails = rows.withColumn("part", F.pmod(order, parts).cast("int")).withColumn("head", F.lit(False))
    names = ["key", "part", "head", "node", "n", "at"]

    def run(batches):
        last = None  # the last head
        for batch in batches:
            if not batch.num_rows:
                continue
            head, node, n, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6))
            if last is not None:
                head, node, n, at = (np.concatenate(x) for x in zip(last, (head, node, n, at), strict=True))
            own = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
            last = tuple(x[own[-1] : own[-1] + 1].copy() for x in (head, node, n, at))
            i = np.flatnonzero(~head & (node != node[own]))
            j = own[i]
            most = np.minimum(at[i], at[j]) + np.minimum(n[i] - at[i], n[j] - at[j])  # the list's shingle may not be the first common one
            good = most >= needed(n[i], n[j], percent)
            if good.any():
                yield _batch(node[j[good]], node[i[good]])

    dealt = heads.select(*names).unionByName(tails.select(*names)).repartition("key", "part").sortWithinPartitions("key", "part", F.desc("head"))
    return _ordered(dealt.mapInArrow(run, "a long, b long"))


def _marked(key, a, b, more) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (key, a, b, more)], ["key", "a", "b", "more"])


_MARKED = "key long, a long, b long, more boolean"


def _small_crossing(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components in lists of up to SMALL rows, by sizes and positions."""

    def run(batches):
        for key, node, n, at, comp in _runs(batches, 5):
            for d in range(1, min(SMALL, len(key))):
                same = key[d:] == key[:-d]
                if not same.any():
                    break
                i = np.flatnonzero(same & (comp[d:] != comp[:-d]))
                i = i[np.minimum(n[i] - at[i], n[i + d] - at[i + d]) >= needed(n[i], n[i + d], percent)]  # sizes out of range need more than one has
                if len(i):
                    yield _marked(key[i], node[i], node[i + d], np.zeros(len(i), bool))

    return rows.select("key", "node", "n", "at", "comp").repartition("key").sortWithinPartitions("key").mapInArrow(run, _MARKED)


def _large_crossing(rows: DataFrame, sizes: DataFrame, percent: int, few: int) -> DataFrame:
    """Lists (key, top, alone, rows) of sizes: their rows outside the largest component (top) meet all rows, in a grid of blocks of
    LIST; a block is sorted by size and position and read in batches, beside the rows that meet them."""
    grid = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(n) / LIST) - 1))
    block = lambda n: F.pmod(F.xxhash64("node", F.lit(7)), F.ceil(F.col(n) / LIST))
    marked = rows.join(sizes.select("key", "top", "alone", F.col("rows").alias("all")), "key")
    right = marked.withColumn("r", block("all")).withColumn("l", grid("alone")).withColumn("side", F.lit(1))
    left = marked.where("comp <> top").withColumn("l", block("alone")).withColumn("r", grid("all")).withColumn("side", F.lit(0))
    names = ["key", "l", "r", "side", "node", "n", "at", "comp", "short"]

    def run(batches):
        last, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            key, l, r, side, node, n, at, comp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(8))  # noqa: E741
            bits = _bits(batch.column(8).to_pylist())
            edges = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (l[1:] != l[:-1]) | (r[1:] != r[:-1]), True])
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if (key[i], l[i], r[i]) != last:
                    last, held = (key[i], l[i], r[i]), []
                s = i + int((side[i:j] == 0).sum())
                held += zip(node[i:s].tolist(), n[i:s].tolist(), at[i:s].tolist(), comp[i:s].tolist(), bits[i:s].copy(), strict=True)
                if s == j:
                    continue
                own_node, own_n, own_at, own_comp, own_bits, found, size = node[s:j], n[s:j], at[s:j], comp[s:j], bits[s:j], [], 0
                begin = np.flatnonzero(np.r_[True, own_n[1:] != own_n[:-1], True])
                for x, m, p, c, b in held:
                    rest = unskipped(m, p, own_n[begin[:-1]], begin, own_at, percent)
                    rest = rest[own_comp[rest] != c]
                    differ = np.bitwise_count(own_bits[rest] ^ b).sum(1, dtype=np.int64)
                    good = differ <= _allowed(m, own_n[rest], percent)
                    if good.any():
                        near = np.argsort(differ[good], kind="stable")[: few or None]
                        found.append((np.full(len(near), key[i]), np.full(len(near), x), own_node[rest[good][near]], np.full(len(near), len(near) < good.sum())))
                        size += len(near)
                        if size > 100_000:
                            yield _marked(*(np.concatenate(x) for x in zip(*found, strict=True)))
                            found, size = [], 0
                if found:
                    yield _marked(*(np.concatenate(x) for x in zip(*found, strict=True)))

    dealt = left.select(*names).unionByName(right.select(*names)).repartition("key", "l", "r").sortWithinPartitions("key", "l", "r", "side", "n", "at")
    return dealt.mapInArrow(run, _MARKED)


def crossing_pairs(rows: DataFrame, nodes: DataFrame, comp: DataFrame, percent: int, few: int) -> DataFrame:
    """rows (key, node, n, at), nodes (node, short) and comp (node, component; a node that it lacks is alone) -> (key, a, b, more) of
    nodes of different components that meet in a list and may have `percent` by sizes and positions, in lists of more than SMALL
    rows by bits as well. few: for each node of such a list the so many nearest alone, with more where there are others (0: all)."""
    rows = rows.join(comp, "node", "left").select("key", "node", "n", "at", F.coalesce("component", "node").alias("comp"))
    each = rows.groupBy("key", "comp").agg(F.count("*").alias("k"))
    sizes = each.groupBy("key").agg(F.max_by("comp", "k").alias("top"), F.sum("k").alias("rows"), F.max("k").alias("most"))
    sizes = cut(sizes.where("rows > most").select("key", "top", "rows", (F.col("rows") - F.col("most")).alias("alone")), "mixed")
    small, large = sizes.where(F.col("rows") <= SMALL), sizes.where(F.col("rows") > SMALL)
    wide = rows.join(large.select("key"), "key", "left_semi").join(nodes.select("node", "short"), "node")
    return _small_crossing(rows.join(small.select("key"), "key"), percent).unionByName(_large_crossing(wide, large, percent, few))


def sieved(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b) without those whose bits, of nodes (node, n, bits), differ in more places than sets with `percent` may differ
    in shingles: each place that differs takes one at least. Bits of more places are folded to those of fewer."""

    def run(batches):
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                small, large = sorted((x, y), key=len)
                low, high, width = int.from_bytes(small, "little"), int.from_bytes(large, "little"), 8 * len(large)
                while width > 8 * len(small):
                    width //= 2
                    high = (high >> width) ^ (high & ((1 << width) - 1))
                keep.append((low ^ high).bit_count() <= n + m - 2 * needed(n, m, percent))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    of = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long")


def _arrays(column: pa.Array):
    """The values of a binary column as arrays of hashes, one by one, without copying the column."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    for i, j in zip(at[:-1], at[1:], strict=True):
        yield data[i:j].view(np.uint64)


def compared(pairs: DataFrame, sets: DataFrame, percent: int, near: int) -> DataFrame:
    """pairs (a, b), sets (node, n, hashes) -> the pairs with a similarity of `near` in 100 or more: a, b, n_a, n_b, common, linked
    (whether it is `percent`), less (what a has and b hasn't), more (what b has and a hasn't; hashes, eight bytes each)."""

    def run(batches):
        for batch in batches:
            rows = []
            for a, b, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _arrays(batch.column(2)), _arrays(batch.column(3)), strict=True):
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                union = len(both) - common
                if 100 * common >= near * union:
                    rows.append((a, b, len(x), len(y), common, 100 * common >= percent * union, np.setdiff1d(x, y, True).tobytes(), np.setdiff1d(y, x, True).tobytes()))
            if rows:
                kinds = (*[pa.int64()] * 5, pa.bool_(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["a", "b", "n_a", "n_b", "common", "linked", "less", "more"])

    of = lambda c: sets.select(F.col("node").alias(c), F.col("hashes").alias(f"hashes_{c}"))
    spark = pairs.sparkSession
    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "hashes_a", "hashes_b")
    with rows_a_batch(spark, BATCH):
        return cut(both.mapInArrow(run, "a long, b long, n_a long, n_b long, common long, linked boolean, less binary, more binary"), "compared")


def derived(pairs: DataFrame, pivots: DataFrame, sets_of, percent: int, near: int) -> DataFrame:
    """pairs (x, z, y), pivots (x, y, n_y, n, less, more: what y has and x hasn't, and the other way round; y is linked with x) ->
    (a, b) of the linked pairs (x, z). The answers of each y are computed for its z, by sets_of, down to `near` (by the triangle
    inequality of 1 - similarity a link of x is no further from y); those of x follow: of y's shingles x and z share all but
    those that one of them lacks, and beside these what both have that y hasn't."""
    asked = cut(pairs.where("y <> z").select(F.least("y", "z").alias("a"), F.greatest("y", "z").alias("b")).distinct(), "asked")
    told = compared(asked, sets_of(asked), percent, near)
    one = told.select(F.col("a").alias("y"), F.col("b").alias("z"), F.col("n_b").alias("n_z"), F.col("less").alias("less_z"), F.col("more").alias("more_z"))
    other = told.select(F.col("b").alias("y"), F.col("a").alias("z"), F.col("n_a").alias("n_z"), F.col("more").alias("less_z"), F.col("less").alias("more_z"))
    both = pairs.join(one.unionByName(other), ["y", "z"]).join(pivots.select("x", "y", "n_y", "n", "less", "more"), ["x", "y"])

    def run(batches):
        for batch in batches:
            rows = []
            for x, z, n_y, n, m, *parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                less, more, less_z, more_z = (np.frombuffer(p, np.uint64) for p in parts)
                lack = len(less) + len(less_z) - len(np.intersect1d(less, less_z, True))
                common = n_y - lack + len(np.intersect1d(more, more_z, True))
                if 100 * common >= percent * (n + m - common):
                    rows.append((x, z))
            if rows:
                yield _batch(*(np.array(c, np.int64) for c in zip(*rows, strict=True)))

    return both.select("x", "z", "n_y", "n", "n_z", "less", "more", "less_z", "more_z").mapInArrow(run, "a long, b long")


def hashed_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """docs (doc_id, text), wanted (node, doc_id, th): a row of docs for each -> (node, hashes), sorted."""

    def run(batches):
        for batch in batches:
            out = []
            for _, m, rows, values in shingle_sets(batch.column(1), size):
                at = np.searchsorted(rows, np.arange(m + 1))
                out.extend(values[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["node", "hashes"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text").join(small_side(wanted, BROADCAST_IDS), ["doc_id", "th"])
    return rows.groupBy("node").agg(F.first("text").alias("text")).select("node", "text").mapInArrow(run, "node long, hashes binary")


def links_of(docs: DataFrame, groups: DataFrame, percent: int, size: int) -> DataFrame:
    """docs and groups (node, n, first (doc_id, th), prefix, bits, short) -> (a, b): links that connect all nodes that are linked in
    any way. Each round reads docs for the sets of nodes that come up for the first time."""
    union = lambda frames: functools.reduce(DataFrame.unionByName, frames)
    rows = cut(lists(groups), "lists")
    sets: list[DataFrame] = []

    def sets_of(pairs: DataFrame) -> DataFrame:
        new = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        new = new.join(union(sets).select("node"), "node", "left_anti") if sets else new
        sets.append(cut(hashed_sets(docs, cut(new.join(groups, "node").select("node", "first.doc_id", "first.th"), "new"), size), "hashes"))
        return union(sets)

    close = cut(sieved(star_pairs(rows, percent), groups, percent), "close")
    answers = compared(close, sets_of(close), percent, percent)
    links, known = [answers.select("a", "b")], [close]
    one = answers.select(F.col("b").alias("x"), F.col("a").alias("y"), F.col("n_a").alias("n_y"), F.col("n_b").alias("n"), "less", "more")
    other = answers.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("n_b").alias("n_y"), F.col("n_a").alias("n"), F.col("more").alias("less"), F.col("less").alias("more"))
    none = F.lit(b"")
    order = F.struct(F.xxhash64("y", F.lit(13)).alias("h"), "y", "n_y", "n", "less", "more")
    pivots = one.unionByName(other).groupBy("x").agg(F.min(order).alias("p")).select("x", "p.y", "p.n_y", "p.n", "p.less", "p.more")
    alone = groups.select(F.col("node").alias("x")).join(pivots.select("x"), "x", "left_anti").join(groups.select(F.col("node").alias("x"), "n"), "x")
    pivots = cut(pivots.unionByName(alone.select("x", F.col("x").alias("y"), F.col("n").alias("n_y"), "n", none.alias("less"), none.alias("more"))), "pivots")
    rows = rows.where("length > 2")  # a list of two is its pivot's pair
    for few in (*FEW, 0):
        found = cut(crossing_pairs(rows, groups, components(union(links)), percent, few), "crossing")
        pairs = _ordered(found).join(union(known), ["a", "b"], "left_anti")
        close = cut(sieved(pairs, groups, percent), "close")
        if close.limit(1).count():
            asked = close.select(F.col("a").alias("x"), F.col("b").alias("z")).join(pivots.select("x", "y"), "x")
            links.append(cut(derived(asked, pivots, sets_of, percent, 2 * percent - 100), "links"))
            known.append(close)
        keys = found.where("more").select("key").distinct()
        if not keys.limit(1).count():
            break  # all pairs of all lists have been compared
        rows = cut(rows.join(keys, "key", "left_semi"), "open")
    return union(links)


def jaccard_groups(docs: DataFrame, percent: int = 90, size: int = 3) -> DataFrame:
    """docs (doc_id, text, ...) -> (doc_id, n_shingles, component_id), a row for each row of docs.

    Documents are linked if 100 * |A & B| >= percent * |A | B| on their sets of `size`-word shingles (percent over 50); with
    fewer words the whole sequence is one shingle. component_id is the smallest doc_id that links reach, itself included. A null
    or wordless text has an empty set and no link; its component_id is its doc_id. Rows with a doc_id in common are linked
    with one another (those with an empty set aside). A row without doc_id is linked with nothing; its component_id is null.
    Further columns are ignored, an empty table gives an empty one. Shingles are told by 64 bits, sets by 128."""
    if not 50 < percent <= 100:
        raise ValueError("percent is over 50, up to 100")
    docs = docs.select("doc_id", "text")
    found = cut(prefixes(docs, percent, size, shingle_levels(docs, size)), "prefixes")
    keys = ["n_shingles", "d1", "d2"]
    usable = found.where("n_shingles > 0 and doc_id is not null")
    groups = usable.groupBy(*keys).agg(F.min(F.struct("doc_id", "th")).alias("first"), F.min("prefix").alias("prefix"), F.min("bits").alias("bits"), F.min("short").alias("short"), F.count("*").alias("rows"))
    groups = cut(groups.withColumn("node", F.monotonically_increasing_id()).withColumn("n", F.col("n_shingles")), "sets")
    links = links_of(docs, groups, percent, size).unionByName(_same_id(usable, groups, keys))
    comp = components(links)
    own = cut(groups.join(comp, "node", "left").select(*keys, F.col("rows").alias("n"), F.col("first.doc_id").alias("own"), F.coalesce("component", "node").alias("component")), "own")
    lows = cut(own.groupBy("component").agg(F.min("own").alias("low"), F.count("*").alias("n")), "lows")
    named = cut(with_group(own, lows, ["component"], F.xxhash64("d1"), ["low"]).select(*keys, "n", "low"), "named")
    is_usable = F.expr("n_shingles > 0 and doc_id is not null")
    cols = [F.when(is_usable, F.col("n_shingles")).otherwise(-1).alias("n_shingles"), F.when(is_usable, F.col("d1")).otherwise(F.monotonically_increasing_id()).alias("d1"), "d2"]
    out = with_group(found.select("doc_id", F.col("n_shingles").alias("count"), *cols), named, keys, F.coalesce("doc_id", "d1"), ["low"])
    return out.select("doc_id", F.col("count").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id")).alias("component_id"))


def _same_id(usable: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Links (a, b) between the sets of a doc_id that has several."""
    several = usable.groupBy("doc_id").agg(F.min(F.struct(*keys)).alias("x"), F.max(F.struct(*keys)).alias("y")).where("x <> y")
    several = cut(several.select("doc_id", *(F.col(f"x.{k}").alias(f"x_{k}") for k in keys)), "several")
    if not several.limit(1).count():
        return groups.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    each = usable.select("doc_id", *keys).distinct().join(small_side(several, BROADCAST_IDS), "doc_id").join(groups.select(*keys, F.col("node").alias("b")), keys)
    return cut(each.join(groups.select(*(F.col(k).alias(f"x_{k}") for k in keys), F.col("node").alias("a")), [f"x_{k}" for k in keys]).select("a", "b"), "links")
