"""Packing of tokenized documents into sequences of a fixed length.

Only the number of pieces of each length matters to the plan, and there are no more lengths than the sequence has places;
so the plan is made on the driver from a histogram of at most CAPACITY counts, whatever the number of documents. By
Martello and Toth's dominance criterion, sets that are at least as good as any other set for one of their pieces are fixed
first and taken out: a piece with which nothing else fits, a pair that fills the sequence, where at most one more piece
fits the piece with the largest that does, and where at most two do the best one or two, if they dominate; passes are
repeated until nothing more is fixed. Pieces with which three others fit are left to the rest, which is packed best-fit, longest pieces first, on counts: equal
pieces go into equal sequences together.

Pieces are then placed by rank among those of their length: a running number within the task that tokenized them, after
the number of such pieces in the tasks before. No step moves the pieces to one task, however many have one length.
"""

from __future__ import annotations

import bisect
import functools
import json
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textflow.llm._shared import cut, small_side

CAPACITY, END = 1024, 2
#: Fixed value: how byte-level BPE vocabularies of this family part a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of a worker's memory of encoded words.
MEMORY = 400_000


class _Words(dict):
    """word with the space before it -> its ids, as little-endian 32-bit numbers."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMORY:
            self.clear()
        self[word] = out = array("I", self.encode(word)).tobytes()
        return out


@functools.lru_cache(2)
def encoder(path: str):
    """text -> its ids as bytes (little-endian unsigned 32-bit), equal to those of tokenizers.Tokenizer.from_file(path)
    with add_special_tokens=False.

    For a byte-level BPE file whose ids are its merge ranks (checked), words are encoded by tiktoken and remembered:
    a single space between characters that aren't white space always starts a new word of PATTERN, so a text is parted
    there first. Other files, and texts with white space next to a space, are encoded as a whole."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, merges, pre = spec["model"]["vocab"], spec["model"].get("merges", []), spec.get("pre_tokenizer") or {}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    byte = {c: b for b, c in sign.items()}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
    ranked = spec["model"].get("type") == "BPE" and all(vocab.get("".join(m)) == 256 + i for i, m in enumerate(pairs)) and all(c in byte for w in vocab for c in w)
    plain = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    if not (ranked and plain and not spec["model"].get("ignore_merges")):
        return lambda text: array("I", whole.encode(text, add_special_tokens=False).ids).tobytes()
    import tiktoken

    ranks = {bytes(byte[c] for c in w): i for w, i in vocab.items() if i < 256 + len(pairs)}
    fast = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    words = _Words(fast.encode_ordinary)
    wide = re.compile(r" \s|\s ")
    added = [t["content"] for t in spec.get("added_tokens", [])]

    def encode(text: str) -> bytes:
        if any(t in text for t in added):
            return array("I", whole.encode(text, add_special_tokens=False).ids).tobytes()
        if wide.search(text):
            return array("I", fast.encode_ordinary(text)).tobytes()
        first, *rest = text.split(" ")
        return b"".join([words[first], *map(words.__getitem__, map(" ".__add__, rest))])

    return encode


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = True) -> DataFrame:
    """docs (doc_id, text, ...) -> pieces: doc_id, piece, start, length, ids_crc32, ids (null unless keep_ids), and the task
    that made it with its number among the task's pieces of that length. A document has its ids and `end`; a longer one
    than capacity is cut into pieces of capacity from its end backwards, so that the first piece may be shorter."""

    def run(batches):
        encode, task, seen = encoder(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        last = array("I", [end]).tobytes()
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for doc, text in zip(ids, batch.column(1).to_pylist(), strict=True):
                data = (encode(text) if text else b"") + last
                n = len(data) // 4
                at, piece = 0, 0
                while at < n:
                    size = min((n - at - 1) % capacity + 1 if at == 0 else capacity, n - at)
                    own = data[4 * at : 4 * (at + size)]
                    out.append((doc, piece, at, size, zlib.crc32(own), own if keep_ids else None, task, int(seen[size])))
                    seen[size] += 1
                    at += size
                    piece += 1
                if len(out) > 5000:
                    yield _pieces(out)
                    out = []
            if out:
                yield _pieces(out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, task int, number long")


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "task", "number"])


def dominating(counts: dict[int, int], a: int, capacity: int) -> tuple[int, ...] | None:
    """The pieces that go with a piece a in a set that is at least as good as any other set for it, None if no such set is
    known: nothing, if nothing fits; the largest that fits, if it fills the sequence, if no two fit, or if no two together
    are larger; and, if no three fit, the largest with its largest partner, if no pair's smaller piece is larger than that."""
    room, left = capacity - a, {x: n - (x == a) for x, n in counts.items() if n > (x == a)}
    sizes = sorted(x for x in left if x <= room)
    if not sizes:
        return ()
    b = sizes[-1]
    least = [x for x in sizes[:3] for _ in range(min(3, left[x]))][:3]
    if b == room or len(least) < 2 or least[0] + least[1] > room:
        return (b,)
    if len(least) == 3 and sum(least) <= room:
        return None
    pair = smaller = partner = 0
    low, high = 0, len(sizes) - 1
    while low <= high:  # for each larger piece, from the largest, the largest partner that fits
        if sizes[low] + sizes[high] > room:
            high -= 1
            continue
        while low < high and sizes[low + 1] + sizes[high] <= room:
            low += 1
        mate = sizes[low] if low < high or left[sizes[low]] > 1 else sizes[low - 1] if low else 0
        if mate:
            pair, smaller = max(pair, mate + sizes[high]), max(smaller, mate)
            partner = mate if sizes[high] == b else partner
        if low == high:
            break
        high -= 1
    if b >= pair:
        return (b,)
    return (b, partner) if partner and partner >= smaller else None


def reduce(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Sets (with how often) that dominate all other sets for one of their pieces; counts keeps what is left. Passes are repeated
    until one fixes nothing, since what is fixed may leave other pieces fewer sets."""
    fixed, before = [], -1
    while len(fixed) > before:
        before = len(fixed)
        for a in sorted(counts, reverse=True):
            while counts.get(a) and (others := dominating(counts, a, capacity)) is not None:
                need = Counter((a, *others))
                n = min(counts[x] // m for x, m in need.items())
                fixed.append(((a, *others), n))
                for x, m in need.items():
                    counts[x] -= n * m
                    if not counts[x]:
                        del counts[x]
    return fixed


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit of pieces in descending length, on counts."""
    open_: dict[int, list[list]] = defaultdict(list)  # room left -> [pieces as (length, times, before), sequences]
    rooms: list[int] = []

    def put(room, pieces, n):
        if n:
            if not open_[room]:
                bisect.insort(rooms, room)
            open_[room].append([pieces, n])

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            i = bisect.bisect_left(rooms, size)
            if i < len(rooms):
                room = rooms[i]
                pieces, n = open_[room].pop()
                if not open_[room]:
                    rooms.pop(i)
            else:
                room, pieces, n = capacity, None, left
            each = room // size
            full = min(n, left // each)
            put(room - each * size, (size, each, pieces), full)
            left -= full * each
            n -= full
            if left and n:
                put(room - left * size, (size, left, pieces), 1)
                left, n = 0, n - 1
            if pieces is not None:
                put(room, pieces, n)
    out = []
    for groups in open_.values():
        for pieces, n in groups:
            sizes = []
            while pieces is not None:
                sizes[:0] = [pieces[0]] * pieces[1]
                pieces = pieces[2]
            out.append((tuple(sizes), n))
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Sets of lengths and how many sequences hold each; deterministic."""
    counts = {k: n for k, n in counts.items() if n}
    fixed = reduce(counts, capacity)
    return fixed + best_fit(counts, capacity)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces of tokenize(), written once -> with sequence_id and offset, without task and number."""
    each = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    total = {r.length: r.n for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots, at, sequence = defaultdict(list), defaultdict(int), 0
    for sizes, n in plan(total, capacity):
        offset = 0
        for size in sizes:
            slots[size].append((at[size], sequence, offset))
            at[size] += n
            offset += size
        sequence += n
    table = {size: np.array(rows, np.int64) for size, rows in slots.items()}
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    ranks = each.select("task", "length", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = pieces.join(small_side(ranks, 200_000), ["task", "length"]).withColumn("rank", F.col("before") + F.col("number"))
    names = [c for c in pieces.columns if c not in ("task", "number")]

    def run(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            seq, off = np.zeros((2, len(length)), np.int64)
            for size in np.unique(length):
                own = length == size
                rows = table[int(size)]
                i = np.searchsorted(rows[:, 0], rank[own], "right") - 1
                seq[own], off[own] = rows[i, 1] + rank[own] - rows[i, 0], rows[i, 2]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(seq), pa.array(off)], [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in names)
    return ranked.select(*names, "rank").mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = True) -> DataFrame:
    """docs (doc_id, text, ...) -> a row for each piece: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    A null or empty text is a document of `end` alone. Equal rows are documents of their own; a null doc_id is kept as it is.
    Further columns are ignored, an empty table gives an empty one. ids are little-endian unsigned 32-bit numbers."""
    return place(cut(tokenize(docs, path, capacity, end, keep_ids), "pieces"), capacity)
