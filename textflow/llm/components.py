"""Connected components of an undirected link table, by alternating large-star and small-star steps."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.llm._shared import cut, remove, with_group

#: Edges of a contracted forest that one task may finish.
SMALL = 1_000_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) with u > v. Large: each larger neighbour of a node is linked with its smallest one (itself included);
    small: so are its smaller neighbours and the node itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = cut(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("m", "u")), "least")
    out = with_group(both, least, ["u"], F.col("v"), ["m"])  # a hub's edges are dealt to many tasks
    if large:
        out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def _contract(edges: DataFrame) -> DataFrame:
    """The edges of each partition replaced by (node, smallest node that its edges reach): no more rows than nodes."""

    def run(batches):
        top: dict[int, int] = {}

        def root(x):
            while (y := top.setdefault(x, x)) != x:
                top[x] = x = top[y]
            return x

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root(u), root(v)
                if x != y:
                    top[max(x, y)] = min(x, y)
        rows = [(x, r) for x in top if (r := root(x)) != x]
        for i in range(0, len(rows), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + 50_000], strict=True)], ["u", "v"])

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """links (a, b), any order, nulls and loops ignored -> (node, component): component is the smallest node that can be
    reached; nodes without a link are absent.

    Each partition first contracts its own links to a forest. While more than SMALL (counted) are left, rounds of large-star
    and small-star steps follow, their number growing with the logarithm of the longest path, with minima combined before
    each shuffle; a forest of up to SMALL edges, which is 16 MB, is finished by one more contraction in one task."""
    edges = links.where("a is not null and b is not null and a <> b")
    edges = cut(_contract(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), "edges")
    sign = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == sign or not now[0]:
            break
        if now[0] <= SMALL:
            edges = cut(_contract(edges.coalesce(1)), "edges")
            break
        sign = now
        new = cut(_star(_star(edges, True), False), "edges")
        remove(edges.sparkSession, edges)
        edges = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
