"""Large JSON arrays of objects, read by byte ranges.

Spark's text source splits a file at a separator; with "}" as the separator a document of any size is a sequence of short pieces,
and each split a segment of it. Whether a segment starts inside a string, and how deep, isn't known until those before it are
read, so the structure is scanned in two passes: the first notes for both cases (inside a string or not) how a segment ends, how
its depth changes and at which depths objects close; what that adds up to from segment to segment is a row for each. The
second pass then knows where each element starts. An element that lies in one segment never moves; those that a border cuts
are put together by a small shuffle.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_BETWEEN = b" \t\r\n,[]"


class Scan:
    """Reads pieces in order. inside: whether the last one ended inside a string; depth: how many brackets are open."""

    def __init__(self, inside: bool, depth: int):
        self.inside, self.depth = inside, depth

    def piece(self, text: bytes, first: bool) -> bool:
        """The next piece (the "}" before it left out; the first has none). Whether that "}" closed an object."""
        closed = not first and not self.inside
        self.depth -= closed
        self.after = self.depth  # after the "}"
        parts = _ESCAPE.sub(b"", text).split(b'"')
        out = parts[1::2] if self.inside else parts[0::2]
        for x in out:
            self.depth += x.count(b"{") + x.count(b"[") - x.count(b"]")
        self.inside ^= len(parts) % 2 == 0
        return closed


def _segments(batches):
    """(file, start, pieces) of consecutive rows (value, file, start, line); pieces are (text, first of its file, line)."""
    now, pieces = None, []
    for batch in batches:
        for value, file, start, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, start) != now:
                if now is not None:
                    yield *now, pieces
                now, pieces = (file, start), []
            pieces.append((value.encode(), not pieces and start == 0, line))
    if now is not None:
        yield *now, pieces


def _ends(batches):
    for file, start, pieces in _segments(batches):
        for inside in (False, True):
            scan, closes = Scan(inside, 0), Counter()
            for text, first, _ in pieces:
                if scan.piece(text, first):
                    closes[scan.after] += 1
            rows = [(file, start, inside, scan.inside, scan.depth, list(closes.items()))]
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.map_(pa.int64(), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "start", "inside", "inside_after", "depth", "closes"])


def _starts(rows) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """(file, start) -> inside, depth, elements before, of each segment; a file that doesn't end as an array is an error."""
    by_file: dict[str, dict[int, dict[bool, tuple]]] = {}
    for r in rows:
        by_file.setdefault(r.file, {}).setdefault(r.start, {})[r.inside] = (r.inside_after, r.depth, r.closes)
    out = {}
    for file, segments in by_file.items():
        inside, depth, done = False, 0, 0
        for start in sorted(segments):
            out[file, start] = inside, depth, done
            after, change, closes = segments[start][inside]
            inside, depth, done = after, depth + change, done + closes.get(1 - depth, 0)
        if inside or depth:
            raise ValueError(f"{file} is no whole JSON array")
    return out


def _elements(batches, starts):
    for file, start, pieces in _segments(batches):
        inside, depth, number = starts[file, start]
        scan, held, at, whole, rows = Scan(inside, depth), [], None, depth <= 1 and not inside, []

        def put(done, held, whole, number, at):
            text = b"".join(held)
            if not text.strip(_BETWEEN):
                return
            rows.append((file, number, at, text, whole and done))

        for text, first, line in pieces:
            closed = scan.piece(text, first)
            if not first:
                held.append(b"}")
            at = line if at is None else at
            if closed and scan.after == 1:
                put(True, held, whole, number, at)
                held, at, whole, number = [], line, True, number + 1
            if first or scan.after <= 1:  # between elements
                before, brace, _ = text.partition(b"{")
                if before.strip(_BETWEEN) or before.count(b"[") != first or brace and b"]" in before:
                    raise ValueError(f"{file}: element {number} is no object of one array")
            held.append(text)
        put(False, held, whole, number, at)
        for i in range(0, len(rows), 1000):
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows[i : i + 1000], strict=True), kinds, strict=True)], ["file", "number", "line", "text", "whole"])


def elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, text): the objects of JSON arrays, one array a file, with their positions from 0. A document that doesn't end
    as an array, or an element that is no object, is an error; a file without text has none."""
    rows = spark.read.text(path, lineSep="}").select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    ends = rows.mapInArrow(_ends, "file string, start long, inside boolean, inside_after boolean, depth long, closes map<long, long>")
    starts = _starts(ends.collect())  # two rows for each split
    found = rows.mapInArrow(lambda b: _elements(b, starts), "file string, number long, line long, text binary, whole boolean")
    cut = found.where("not whole").groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("line", "text"))).alias("x"))
    cut = cut.select("file", "number", F.aggregate("x", F.lit(b""), lambda s, x: F.concat(s, x["text"])).alias("text"))
    both = found.where("whole").select("file", "number", "text").unionByName(cut)
    text = F.decode("text", "UTF-8")
    return both.select("file", "number", F.substr(text, F.instr(text, "{")).alias("text"))
