"""Mixing sources to target weights by temperature, in DataFrame operations only.

A source's weight is its token share to the power of an exponent, normalised; 1 keeps the shares, 0 makes all equal. The
exponent is found by bisection (each round parts the bracket into SECTIONS, evaluated in one aggregation over the table
of sources) so that the weights have a target entropy, or no source repeats more than a limit. The weights are realised
in a budget of tokens: a source is used in whole epochs and a part of one more, which takes documents in the order of a
seeded permutation while they fit.

That order is dealt into blocks: the cut is found from the blocks' token sums, and only the block it falls into is
sorted. So a source with a third of all documents is no task's burden, and documents themselves are never shuffled; they
meet one row for each source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textflow.llm._shared import cut, with_group

SECTIONS, ROUNDS = 64, 6
#: Documents in a block, about.
BLOCK = 4096
SEED = 7
PLACES = 2.0**60


def token_count(text: Column) -> Column:
    """Words between white space; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def _source(column: Column) -> Column:
    """A key that is never null: a null source is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


def _number(text: Column) -> Column:
    """The first 60 bits of a text's MD5: the same number in any engine."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _key(doc_id: Column, text: Column) -> Column:
    return _number(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit(""))))


def _order(epoch: Column, key: Column) -> Column:
    """A document's place in an epoch's permutation, from 0 to PLACES - 1."""
    return _number(F.concat_ws("|", F.lit(str(SEED)), epoch.cast("string"), key.cast("string")))


def exponent(sources: DataFrame, entropy: float | None = None, max_repeat: float | None = None, budget: float | None = None) -> tuple[float, float, float]:
    """sources (share > 0) -> (exponent, sum of share ** exponent, least of share ** (exponent - 1)).

    entropy: the largest exponent whose weights have this part of the largest possible entropy. max_repeat: the smallest
    exponent with which no source is used more often; budget: tokens to draw as a multiple of all, else the least with
    which every source is used once. Both are monotone in the exponent. Where even 0 has too little entropy (or 1 repeats
    too often), that end is taken."""
    low, high = 0.0, 1.0
    found = (1.0, 1.0, 1.0)
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
        points = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(x).alias("x")) for i, x in enumerate(grid))))
        power = F.pow("share", F.col("at.x"))
        each = sources.select("share", points.alias("at")).groupBy("at.i").agg(F.sum(power).alias("z"), F.sum(power * F.log("share")).alias("l"), F.max(power / F.col("share")).alias("most"), F.min(power / F.col("share")).alias("least"), F.count("*").alias("n"))
        rows = {r.i: r for r in each.collect()}  # SECTIONS + 1 rows
        if not rows:
            return found
        good = []
        for i, x in enumerate(grid):
            r = rows[i]
            if entropy is not None:
                h = math.log(r.z) - x * r.l / r.z
                good.append(h >= entropy * math.log(r.n) - 1e-12)
            else:
                good.append(max_repeat is None or (r.most / r.least if budget is None else r.most / r.z * budget) <= max_repeat + 1e-12)
        if entropy is not None:  # true up to some exponent
            k = max((i for i, ok in enumerate(good) if ok), default=0)
            low, high, found = grid[k], grid[min(k + 1, SECTIONS)], (grid[k], rows[k].z, rows[k].least)
        else:  # true from some exponent on
            k = min((i for i, ok in enumerate(good) if ok), default=SECTIONS)
            low, high, found = grid[max(k - 1, 0)], grid[k], (grid[k], rows[k].z, rows[k].least)
    return found


def decisions(docs: DataFrame, entropy: float | None = None, max_repeat: float | None = 4.0, budget: float | None = None) -> DataFrame:
    """docs (doc_id, text, source) -> source key, weight, epochs, last: a document is used in `epochs` whole epochs, and in
    one more if its place there is at most `last` (null: none)."""
    key = _key(F.col("doc_id"), F.col("text"))
    small = cut(docs.select(_source(F.col("source")).alias("s"), key.alias("key"), token_count(F.col("text")).alias("n")), "tokens")
    sums = small.groupBy("s").agg(F.sum("n").alias("tokens"), F.count("*").alias("docs"))
    total = small.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sources = cut(sums.withColumn("share", F.col("tokens") / F.lit(float(max(total, 1)))), "sources")
    x, z, least = exponent(sources.where("tokens > 0"), entropy, max_repeat, budget)
    power = F.pow("share", F.lit(x))
    uses = power / F.col("share") / F.lit(least) if budget is None else power / F.col("share") / F.lit(z) * F.lit(budget)
    sources = sources.withColumn("weight", F.when(F.col("tokens") > 0, power / F.lit(z)).otherwise(F.lit(0.0))).withColumn("uses", F.when(F.col("tokens") > 0, uses).otherwise(F.lit(1.0)))
    sources = sources.withColumn("epochs", F.floor("uses")).withColumn("rest", F.floor((F.col("uses") - F.col("epochs")) * F.col("tokens")))
    sources = cut(sources.withColumn("blocks", F.ceil(F.col("docs") / BLOCK)), "sources")
    ordered = with_group(small, sources.select("s", "epochs", "blocks", F.col("docs").alias("n")), ["s"], F.col("key"), ["epochs", "blocks"])
    place = _order(F.col("epochs"), F.col("key"))
    ordered = cut(ordered.select("s", "n", place.alias("place"), F.floor(place / F.lit(PLACES) * F.col("blocks")).alias("block")), "places")
    blocks = ordered.groupBy("s", "block").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("s").orderBy("block")) - F.col("n")
    cuts = blocks.withColumn("before", before).join(sources.select("s", "rest"), "s").where("before <= rest and before + n > rest")
    cuts = cut(cuts.select("s", "block", "before", "rest"), "cuts")  # a row for each source at most
    inside = ordered.join(cuts, ["s", "block"]).withColumn("sum", F.col("before") + F.sum("n").over(Window.partitionBy("s", "block").orderBy("place")))
    within = inside.where(F.col("sum") <= F.col("rest")).groupBy("s").agg(F.max("place").alias("inner"))
    start = cuts.join(sources.select("s", "blocks"), "s").select("s", F.lit(True).alias("is_cut"), (F.ceil(F.col("block") / F.col("blocks") * F.lit(PLACES)) - 1).alias("outer"))
    last = sources.join(start, "s", "left").join(within, "s", "left")
    # blocks before the cut are used in full; places of the cut block that fit follow; without a cut nothing is left over
    upto = F.when(F.col("inner").isNotNull(), F.col("inner")).when(F.coalesce("is_cut", F.lit(False)), F.col("outer"))
    return cut(last.select("s", "weight", "epochs", F.when(F.col("rest") > 0, upto).alias("last"), "docs"), "decisions")


def mix(docs: DataFrame, entropy: float | None = None, max_repeat: float | None = 4.0, budget: float | None = None) -> DataFrame:
    """docs (doc_id, text, source, ...) -> the same rows with weight (of the source) and copies (how often to use the row).

    Without a budget every document is used once at least, and none more than max_repeat (rounded up) times. Tokens are
    words. A source without tokens has weight 0 and its documents one copy; so has everything in an empty corpus. A null
    source is a source of its own; equal rows have equal places and are used equally often. Columns of docs named weight
    or copies are replaced."""
    names = [c for c in docs.columns if c not in ("weight", "copies")]
    return _mixed(docs, names, entropy, max_repeat, budget).withColumnsRenamed({"__mix_weight": "weight", "__mix_copies": "copies"})


def _mixed(docs: DataFrame, names: list[str], entropy: float | None, max_repeat: float | None, budget: float | None) -> DataFrame:
    """The named columns of docs with __mix_weight and __mix_copies."""
    rows = docs.select(*names, _source(F.col("source")).alias("__mix_s"), _key(F.col("doc_id"), F.col("text")).alias("__mix_key"))
    chosen = decisions(docs, entropy, max_repeat, budget)
    found = with_group(rows, chosen.select(F.col("s").alias("__mix_s"), *(F.col(c).alias(f"__mix_{c}") for c in ("weight", "epochs", "last")), F.col("docs").alias("n")), ["__mix_s"], F.col("__mix_key"), ["__mix_weight", "__mix_epochs", "__mix_last"])
    more = F.coalesce(_order(F.col("__mix_epochs"), F.col("__mix_key")) <= F.col("__mix_last"), F.lit(False)).cast("int")
    return found.select(*names, F.col("__mix_weight"), (F.col("__mix_epochs").cast("int") + more).alias("__mix_copies"))


def repeated(docs: DataFrame, entropy: float | None = None, max_repeat: float | None = 4.0, budget: float | None = None) -> DataFrame:
    """The rows of docs, each as often as its copies in mix() say, with all columns of docs (weight and copies too, if it has
    such) and no others. Columns named __mix_... are reserved."""
    copies = F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))
    return _mixed(docs, docs.columns, entropy, max_repeat, budget).where("__mix_copies > 0").withColumn("__mix_copy", copies).select(*docs.columns)
