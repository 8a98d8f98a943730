"""Near-duplicate groups by MinHash signatures and a multi-index Hamming join.

A document's set is its distinct word shingles. Its signature has CHUNKS x WIDTH symbols of 16 bits (b-bit minwise
hashes); the distance of two signatures is the number of symbols in which they differ. By the pigeonhole principle, of
two signatures within CHUNKS * (ERRORS + 1) - 1 symbols at least one chunk differs in at most ERRORS symbols; so each
chunk is indexed once for every choice of ERRORS symbols left out, and every such pair meets under an equal key. With
10 chunks of 4 and one error, pairs up to distance 19 of 40 are found for certain, and a pair with similarity 0.75 is
missed with probability 1.5e-6. Pairs that meet are compared by their full signatures and then on their full sets.

Sets that are equal are one node from the start, whatever their number. In a bucket no list of all pairs is made: first
a nearest spanning forest of the pairs that may link; then, with the components that result, and by longer sketches of
the documents concerned, each node's few nearest nodes in other components; and last whatever pairs between components
are left that the sketches don't rule out. So a component loses no link, and large groups of copies take few pairs.

A bucket of more than 2 * BLOCK nodes is dealt out: for the forests into blocks that have PIVOTS nodes in common, so that the
work grows with its nodes; for the pairs between components only its nodes outside its largest component meet the others.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.llm._shared import cut, small_side, with_group
from textflow.llm._words import LOWER, distinct, mix, shingles, texts, word_hashes, words
from textflow.llm.components import components

CHUNKS, WIDTH, ERRORS = 10, 4, 1
SYMBOLS = CHUNKS * WIDTH
#: Signatures that differ in more symbols aren't confirmed on full sets: for similarity 0.75 the number of differing
#: symbols is binomial (40, 1/4), over 25 with a probability of 1e-7.
FAR = 25
#: Minwise hashes of 8 bits in a sketch, and how many must agree for a pair to be confirmed on full sets: at similarity 0.75
#: the number that agree is binomial (1536, 0.75), under 1070 with a probability of 1e-6.
SKETCH, NEAR = 1536, 1070
#: Nearest nodes in other components that a node is compared with before all others are.
FEW = 6
#: Nodes of a block, where a bucket is split, and nodes that all its blocks have in common for the forests.
BLOCK, PIVOTS = 8192, 64
#: Pairs of one node beyond which its text goes to several tasks.
HUB = 2000
#: Ids up to which a table is broadcast.
BROADCAST_IDS = 500_000
_RNG = np.random.default_rng(6)
_SKETCH_FACTORS = np.random.default_rng(66).integers(0, 1 << 63, SKETCH, np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _RNG.integers(0, 1 << 63, SYMBOLS, np.uint64) * np.uint64(2) + np.uint64(1)
_KEYS = _RNG.integers(0, 1 << 63, SYMBOLS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row of each, distinct shingle hashes sorted by row and value) for pieces of a string column."""
    for t in texts(column):
        data = LOWER[t.data]
        w = words(t)
        rows, values = distinct(*shingles(w, word_hashes(data, w.start, w.end), size))
        yield t.first, len(t), rows, values


def signatures(docs: DataFrame, size: int = 5) -> DataFrame:
    """(doc_id, text) -> (doc_id, th, n_shingles, d1, d2, sig): th is the text's hash, d1 and d2 are digests of the set, sig its
    signature."""

    def run(batches):
        for batch in batches:
            ids, n, d1, d2, sig = [], [], [], [], []
            for first, m, rows, values in shingle_sets(batch.column(2), size):
                count = np.bincount(rows, minlength=m)
                out, sums = np.zeros((m, SYMBOLS), np.uint16), np.zeros((2, m), np.uint64)
                if len(values):
                    has, at = np.flatnonzero(count), np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                    for i, factor in enumerate(_FACTORS):
                        low = np.minimum.reduceat(((values * factor) >> np.uint64(32)).astype(np.uint32), at)
                        out[has, i] = low & 0xFFFF
                    sums[0, has] = np.add.reduceat(mix(values), at)
                    sums[1, has] = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), at)
                n.append(count), d1.append(sums[0].view(np.int64)), d2.append(sums[1].view(np.int64))
                sig.extend(x.tobytes() for x in out)
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(np.concatenate(x).astype(np.int64)) for x in (n, d1, d2)), pa.array(sig, pa.binary())], ["doc_id", "th", "n_shingles", "d1", "d2", "sig"])

    return _hashed(docs).mapInArrow(run, "doc_id long, th long, n_shingles long, d1 long, d2 long, sig binary")


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")


def index_keys(nodes: DataFrame) -> DataFrame:
    """(node, sig) -> (key, node, slot): a key for each chunk and each choice of ERRORS = 1 symbols left out (its slot)."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
            part = (sig + np.uint64(1)) * _KEYS.reshape(CHUNKS, WIDTH)
            key = mix(part.sum(2, keepdims=True, dtype=np.uint64) - part + np.arange(SYMBOLS, dtype=np.uint64).reshape(CHUNKS, WIDTH))
            node = np.repeat(batch.column(0).to_numpy(), SYMBOLS)
            slot = np.tile(np.arange(SYMBOLS, dtype=np.int8), batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(node), pa.array(slot)], ["key", "node", "slot"])

    return nodes.select("node", "sig").mapInArrow(run, "key long, node long, slot byte")


def _runs(batches, columns: int) -> Iterator[list[np.ndarray]]:
    """Batches sorted by their first column -> arrays in which no run of an equal first value is cut."""
    held: list[np.ndarray] = []
    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)]
        if not len(new[0]):
            continue
        now = [np.concatenate(x) for x in zip(held, new, strict=True)] if held else new
        last = int(np.searchsorted(now[0], now[0][-1], "left"))
        if last:
            yield [x[:last] for x in now]
        held = [x[last:] for x in now]
    if held and len(held[0]):
        yield held


def shared_keys(keys: DataFrame) -> DataFrame:
    """The rows of keys that more than one node has."""

    def run(batches):
        held = None  # the last row so far, and whether the one before has its key
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node, slot = (batch.column(i).to_numpy() for i in range(3))
            before = False
            if held is not None:
                (key, node, slot), before = (np.concatenate([x, y]) for x, y in zip(held[0], (key, node, slot), strict=True)), held[1]
            same = np.r_[before, key[1:] == key[:-1]]
            keep = same[:-1] | same[1:]
            yield pa.RecordBatch.from_arrays([pa.array(x[:-1][keep]) for x in (key, node, slot)], ["key", "node", "slot"])
            held = [x[-1:] for x in (key, node, slot)], bool(same[-1])
        if held is not None and held[1]:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["key", "node", "slot"])

    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(run, "key long, node long, slot byte")


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(7)), blocks)


def forest_buckets(buckets: DataFrame, large: DataFrame | None) -> DataFrame:
    """(key, node, slot), where each bucket of large (key, n, blocks) is replaced by its blocks, all with its PIVOTS nodes of the
    smallest hashes."""
    if large is None:
        return buckets
    usual = buckets.join(large, "key", "left_anti").select("key", "node", "slot")
    rows = buckets.join(large, "key")
    order = F.xxhash64("node", F.lit(8))
    few = F.abs(order.cast("double")) < F.lit(4 * PIVOTS * 2.0**63) / F.col("n")  # about 4 * PIVOTS nodes
    edge = cut(rows.groupBy("key").agg(F.array_sort(F.collect_list(F.when(few, order))).alias("low")), "pivots")
    pivots = rows.join(small_side(edge, BROADCAST_IDS // 10), "key").where(F.array_contains(F.slice("low", 1, PIVOTS), order)).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    parts = rows.withColumn("block", _block(F.col("blocks"))).select("key", "node", "slot", "block").unionByName(pivots.select("key", "node", "slot", "block")).distinct()
    return usual.unionByName(parts.select(F.xxhash64("key", "block").alias("key"), "node", "slot"))


def _forest(node: np.ndarray, sig: np.ndarray) -> tuple[list[int], list[int], bool]:
    """The edges (a, b) of a nearest spanning forest (Prim's) of a bucket over pairs within FAR, and whether there are further
    such pairs."""
    n = len(node)
    near, parent = np.full(n, 255, np.int16), np.full(n, -1)
    out = np.zeros(n, bool)
    a, b, met, at = [], [], 0, 0
    for step in range(n):
        out[at] = True
        d = (sig != sig[at]).sum(1).astype(np.int16)
        passing = (d <= FAR) & ~out  # each pair once: those before have seen this node
        met += int(passing.sum())
        better = passing & (d < near)
        near[better], parent[better] = d[better], at
        if step == n - 1:
            break
        rest = np.where(out, 300, near)
        at = int(rest.argmin())
        if rest[at] <= FAR:
            a.append(node[at])
            b.append(node[parent[at]])
        else:
            at = int(out.argmin())
    return a, b, met > len(a)


def _crossing(node: np.ndarray, comp: np.ndarray, side: np.ndarray, sketch: np.ndarray, slot: int, most: int) -> tuple[list[int], list[int], bool]:
    """For each node on the left side its `most` nearest nodes of the right side in other components, by sketch, and whether
    any had more. side: 0 is right, 1 both, 2 left. Every pair between two components of a bucket has a node outside its
    largest component, which is on the left. A pair that shares several keys is taken in the bucket of its first slot only.
    sketch: SKETCH bytes and the signature."""
    long, sig = sketch[:, :SKETCH], np.ascontiguousarray(sketch[:, SKETCH:]).view(np.uint16).reshape(len(node), CHUNKS, WIDTH)
    right = np.flatnonzero(side < 2)
    a, b, more = [], [], False
    for i in np.flatnonzero(side > 0):
        other = right[comp[right] != comp[i]]
        equal = sig[other] == sig[i]
        n = equal.sum(2)
        chunk = (n >= WIDTH - ERRORS).argmax(1)
        rows = np.arange(len(other))
        first = chunk * WIDTH + np.where(n[rows, chunk] == WIDTH, 0, equal[rows, chunk].argmin(1))
        other = other[first == slot]
        same = np.concatenate([(long[other[j : j + 2048]] == long[i]).sum(1) for j in range(0, len(other), 2048)]) if len(other) else np.empty(0, np.int64)
        order = np.argsort(-same, kind="stable")
        order = order[same[order] >= NEAR]
        more |= len(order) > most
        take = other[order[:most]]
        a += [node[i]] * len(take)
        b += node[take].tolist()
    return a, b, more


def bucket_pairs(members: DataFrame, most: int) -> DataFrame:
    """(key, node, comp, side, slot, sig) sorted by key within partitions -> (a, b, more): pairs to confirm. most = 0: a forest of
    each bucket by signatures; else up to so many for each node on the left side, between components, by sketches."""

    def run(batches):
        for key, node, comp, side, slot, sig in _runs(batches, 6):
            at = np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)]
            a, b, m, seen = [], [], [], set()
            for i, j in zip(at[:-1], at[1:], strict=True):
                if j - i < 2:
                    continue
                order = np.argsort(node[i:j], kind="stable")
                name = hashlib.blake2b(node[i:j][order], digest_size=16).digest()
                if not most and name in seen:  # the same members under another key
                    continue
                seen.add(name)
                s = np.frombuffer(b"".join(sig[i:j][order]), np.uint8 if most else np.uint16).reshape(j - i, -1)
                x, y, more = _crossing(node[i:j][order], comp[i:j][order], side[i:j][order], s, int(slot[i]), most) if most else _forest(node[i:j][order], s)
                a += x
                b += y
                m += [more] * len(x)
            if a:
                lo, hi = np.minimum(a, b), np.maximum(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(lo), pa.array(hi), pa.array(m)], ["a", "b", "more"])

    return members.mapInArrow(run, "a long, b long, more boolean")


def mixed_buckets(buckets: DataFrame, comp: DataFrame, nodes: DataFrame, large: DataFrame | None) -> DataFrame:
    """The members (key, node, comp, side, slot) of buckets with more than one component, of nodes alone; those of large buckets
    are dealt out so that each node outside the largest component meets all nodes of others."""

    def run(batches):
        for key, node, c, slot in _runs(batches, 4):
            at = np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)]
            side = np.zeros(len(key), np.int8)
            keep = np.zeros(len(key), bool)
            for i, j in zip(at[:-1], at[1:], strict=True):
                if c[i:j].min() != c[i:j].max():
                    values, count = np.unique(c[i:j], return_counts=True)
                    side[i:j] = c[i:j] != values[count.argmax()]
                    keep[i:j] = True
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (key, node, c, side, slot)], ["key", "node", "comp", "side", "slot"])

    rows = buckets.join(nodes.select("node"), "node").join(comp, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp"), "slot")
    usual = rows if large is None else rows.join(large, "key", "left_anti")
    out = usual.repartition("key").sortWithinPartitions("key").mapInArrow(run, "key long, node long, comp long, side byte, slot byte")
    if large is None:
        return out
    sizes = rows.join(large, "key").groupBy("key", "comp").agg(F.count("*").alias("n"))
    tops = sizes.groupBy("key").agg(F.max_by("comp", "n").alias("top"), F.sum("n").alias("all"), F.max("n").alias("most")).where(F.col("all") > F.col("most"))
    tops = tops.select("key", "top", F.ceil(F.col("all") / BLOCK).alias("blocks"), F.ceil((F.col("all") - F.col("most")) / BLOCK).alias("lefts"))
    marked = rows.join(small_side(cut(tops, "tops"), BROADCAST_IDS), "key")
    grid = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    right = marked.withColumn("r", _block(F.col("blocks"))).withColumn("l", grid("lefts")).withColumn("side", F.lit(0).cast("byte"))
    left = marked.where("comp <> top").withColumn("l", _block(F.col("lefts"))).withColumn("r", grid("blocks")).withColumn("side", F.lit(2).cast("byte"))
    return out.unionByName(right.unionByName(left).select(F.xxhash64("key", "l", "r").alias("key"), "node", "comp", "side", "slot"))


def sketches(sets: DataFrame, size: int = 5) -> DataFrame:
    """sets (node, text) -> (node, sig): SKETCH minwise hashes of 8 bits."""

    def run(batches):
        for batch in batches:
            out = []
            for _, m, rows, values in shingle_sets(batch.column(1), size):
                part = np.zeros((m, SKETCH), np.uint8)
                if len(values):
                    at = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                    for i, factor in enumerate(_SKETCH_FACTORS):
                        part[rows[at], i] = np.minimum.reduceat(((values * factor) >> np.uint64(32)).astype(np.uint32), at) & 0xFF
                out.extend(x.tobytes() for x in part)
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["node", "sig"])

    return sets.select("node", "text").mapInArrow(run, "node long, sig binary")


def _with_text(pairs: DataFrame, sets: DataFrame, hubs: DataFrame | None, one: str, other: str) -> DataFrame:
    """pairs with text_<one> from sets (node, text); the pairs of hubs (node, parts) are dealt to several tasks."""
    texts_of = sets.select(F.col("node").alias(one), F.col("text").alias(f"text_{one}"))
    if hubs is None:
        return pairs.join(texts_of, one)
    hubs = hubs.withColumnRenamed("node", one)
    salted = pairs.join(hubs, one, "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64(other), F.col("parts")), F.lit(0))).drop("parts")
    spread = texts_of.join(hubs, one, "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    return salted.join(spread, [one, "salt"]).drop("salt")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int, size: int = 5) -> DataFrame:
    """pairs (a, b), a table -> (a, b, linked), by the whole shingle sets of sets (node, text)."""

    def run(batches):
        for batch in batches:
            both = [[None] * batch.num_rows, [None] * batch.num_rows]
            for side, column in enumerate((batch.column(2), batch.column(3))):
                for first, m, rows, values in shingle_sets(column, size):
                    at = np.searchsorted(rows, np.arange(m + 1))
                    for i in range(m):
                        both[side][first + i] = values[at[i] : at[i + 1]]
            linked = []
            for x, y in zip(*both, strict=True):
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    sides = [pairs.groupBy(F.col(c).alias("node")).agg(F.count("*").alias("n")) for c in ("a", "b")]
    degrees = sides[0].unionByName(sides[1]).groupBy("node").agg(F.ceil(F.sum("n") / HUB).alias("parts"))
    hubs = cut(degrees.where("parts > 1"), "hubs")
    hubs = small_side(hubs, BROADCAST_IDS) if hubs.limit(1).count() else None
    two = _with_text(_with_text(pairs, sets, hubs, "a", "b"), sets, hubs, "b", "a")
    return two.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, linked boolean")


def set_groups(docs: DataFrame, percent: int = 75, size: int = 5, by_id: bool = True) -> tuple[DataFrame, DataFrame]:
    """docs (doc_id, text, ...) -> signatures(docs), and of each distinct set: n_shingles, d1, d2, n (rows with it), low (the
    smallest doc_id that its component has), keeper (the component's smallest (doc_id, hash of its text)).

    Sets are linked by similarity; with by_id also where a doc_id has several."""
    sigs = cut(signatures(docs, size), "signatures")
    usable = sigs.where("n_shingles > 0 and doc_id is not null")
    keys = ["n_shingles", "d1", "d2"]
    groups = usable.groupBy(*keys).agg(F.min(F.struct("doc_id", "th")).alias("first"), F.min("sig").alias("sig"), F.count("*").alias("n"))
    groups = cut(groups.withColumn("node", F.monotonically_increasing_id()), "sets")
    nodes = groups.select("node", "sig")
    buckets = cut(shared_keys(index_keys(nodes)), "buckets")
    large = buckets.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 2 * BLOCK).withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    large = cut(large, "large")
    large = small_side(large, BROADCAST_IDS) if large.limit(1).count() else None
    links = groups.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    if by_id:
        several = usable.groupBy("doc_id").agg(F.min(F.struct(*keys)).alias("x"), F.max(F.struct(*keys)).alias("y")).where("x <> y")
        several = cut(several.select("doc_id", *(F.col(f"x.{k}").alias(f"x_{k}") for k in keys)), "several")
        if several.limit(1).count():
            each = usable.select("doc_id", *keys).distinct().join(small_side(several, BROADCAST_IDS), "doc_id")
            each = each.join(groups.select(*keys, F.col("node").alias("b")), keys)
            links = cut(each.join(groups.select(*(F.col(k).alias(f"x_{k}") for k in keys), F.col("node").alias("a")), [f"x_{k}" for k in keys]).select("a", "b"), "links")
    texts_of = sketch = None
    known, most = [], 0
    while True:
        if not most:
            rows = forest_buckets(buckets, large).join(nodes, "node").select("key", "node", F.lit(0).cast("long").alias("comp"), F.lit(0).cast("byte").alias("side"), "slot", "sig")
        else:
            rows = mixed_buckets(buckets, comp, sketch, large).join(sketch, "node").select("key", "node", "comp", "side", "slot", "sig")
        pairs = cut(bucket_pairs(rows.repartition("key").sortWithinPartitions("key"), most).groupBy("a", "b").agg(F.max("more").alias("more")), "pairs")
        new = pairs.select("a", "b")
        if known:
            before = functools.reduce(DataFrame.unionByName, (x.select("a", "b") for x in known))
            new = cut(new.join(before, ["a", "b"], "left_anti"), "new")
        if texts_of is None:
            paired = pairs.select(F.col("a").alias("node")).distinct().unionByName(pairs.select(F.col("b").alias("node")).distinct())
            paired = (paired if large is None else paired.unionByName(buckets.join(large, "key").select("node"))).distinct()
            paired = cut(groups.join(small_side(paired, BROADCAST_IDS), "node").select("node", "first.doc_id", "first.th"), "paired")
            first = _hashed(docs).join(small_side(paired, BROADCAST_IDS), ["doc_id", "th"])
            texts_of = cut(first.groupBy("node").agg(F.first("text").alias("text")), "texts")
        known.append(cut(confirm(new, texts_of, percent, size), "checked"))
        links = links.unionByName(known[-1].where("linked").select("a", "b"))
        comp = components(links)
        if most > FEW or (most or large is None) and not pairs.where("more").limit(1).count():
            break  # every pair between the components before this round was confirmed or refuted
        if sketch is None:
            sketch = cut(sketches(texts_of, size).join(nodes.withColumnRenamed("sig", "own"), "node").select("node", F.concat("sig", "own").alias("sig")), "sketches")
        most = FEW if not most else 1 << 30
    own = groups.join(comp, "node", "left").select(*keys, "n", "first", F.coalesce("component", "node").alias("component"))
    own = cut(own, "own")
    lows = cut(own.groupBy("component").agg(F.min("first").alias("keeper"), F.count("*").alias("n")), "lows")
    found = with_group(own.withColumnRenamed("n", "rows"), lows, ["component"], F.xxhash64("d1"), ["keeper"])
    return sigs, cut(found.select(*keys, F.col("rows").alias("n"), F.col("keeper.doc_id").alias("low"), "keeper"), "groups")


def near_duplicates(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """docs (doc_id, text, ...) -> (doc_id, n_shingles, component_id, kept), a row for each row of docs.

    Documents are linked if 100 * |A & B| >= percent * |A | B| on their shingle sets; component_id is the smallest doc_id
    that can be reached, itself included, kept says that it is the document's own. A null or wordless text has an empty
    set and no link; its component_id is its doc_id. Rows with a doc_id in common are linked with one another (those with an
    empty set aside), and each with the near copies of its own text. A row without doc_id is linked with nothing; its component_id is null and it is kept. Further
    columns are ignored. An empty table gives an empty one."""
    sigs, groups = set_groups(docs, percent, size)
    usable, keys = F.expr("n_shingles > 0 and doc_id is not null"), ["n_shingles", "d1", "d2"]
    own = [F.when(usable, F.col("n_shingles")).otherwise(-1).alias("n_shingles"), F.when(usable, F.col("d1")).otherwise(F.monotonically_increasing_id()).alias("d1"), "d2"]
    out = with_group(sigs.select("doc_id", F.col("n_shingles").alias("n"), *own), groups, keys, F.coalesce("doc_id", "d1"), ["low"])
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """The rows of docs (doc_id, text, ...), with all their columns, of which one in each group of near copies stays: that with
    the smallest doc_id; of a doc_id's different texts in a group that with the smallest hash, and of rows with the same id
    and text the smallest. Texts are judged by themselves: different ones of one doc_id are no copies. Rows without a set (a
    null or wordless text) or without doc_id stay."""
    sigs, groups = set_groups(docs, percent, size, by_id=False)
    keys = ["n_shingles", "d1", "d2"]
    usable = sigs.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id", "th", *keys).agg(F.count("*").alias("times"))
    judged = with_group(usable, groups, keys, F.col("doc_id"), ["keeper"])
    judged = cut(judged.select("doc_id", "th", "times", F.col("keeper").eqNullSafe(F.struct("doc_id", "th")).alias("stays")).where("times > 1 or not stays"), "judged")
    names = docs.columns
    rows = docs.withColumns({"__dedup_id": F.col("doc_id").cast("long"), "__dedup_th": F.xxhash64("text")})
    side = lambda df: small_side(df.select(F.col("doc_id").alias("__dedup_id"), F.col("th").alias("__dedup_th")), BROADCAST_IDS)
    keys = ["__dedup_id", "__dedup_th"]
    left = rows.join(side(judged), keys, "left_anti").select(*names)
    again = judged.where("stays")
    if not again.limit(1).count():
        return left
    once = rows.join(side(again), keys, "left_semi").groupBy(*keys).agg(F.min(F.struct(*names)).alias("row")).select("row.*")
    return left.unionByName(once.select(*names))
