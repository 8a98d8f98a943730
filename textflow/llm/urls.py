"""URL filters: rules on host and path prefix, joined to URLs by a sorted sweep.

A host's canonical key is its labels from the last to the first, each ended by a dot, so that a rule's host and all its
subdomains are the keys that start with the rule's key: an interval of the sorted keys. URLs are sorted by key and path
within their partition (Spark's sort, which spills) and merged with the sorted rules. The sweep keeps a stack of the rule
hosts whose intervals hold the current key, each nested in the one below; a host on the stack has its path prefixes
sorted, each with the next shorter prefix that it extends, so the longest that fits is one search away.

Up to RULES rules go to every task, and URLs are not shuffled at all. More rules are a table: URLs and rules are dealt out to
ranges of keys by splitters from a bounded sample of both, so that each range is one sorted sweep over its own URLs and rules.
A rule goes to the range of its key, and also to each range that starts inside its interval, which is where a label prefix of
the range's first key is the rule's. The driver sees the sample only.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules that go to every task, at 100 bytes each 10 MB; and rows in the sample for each range.
RULES, SAMPLED = 100_000, 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z in lower case. Path: then up to ?, # or the end. Both are
    empty where url is null or has no ://."""
    part = lambda i: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit(""))
    return F.translate(part(1), _UPPER, _LOWER), part(2)


def host_key(host: str) -> str:
    return "".join(f"{label}." for label in reversed(host.split(".")))


class Sweep:
    """Rules (rule, verdict), where rule is a host with a path prefix such as example.com/en/, over URLs sorted by
    (host key, path)."""

    def __init__(self, rules: list[tuple[str, str]]):
        by_host: dict[str, dict[str, tuple[str, str]]] = {}
        for rule, verdict in sorted(rules, key=lambda x: (x[0], x[1] != "block")):  # of a rule with two verdicts, block holds
            host, slash, path = rule.partition("/")
            if host:
                by_host.setdefault(host_key(host), {}).setdefault(slash + path, (rule, verdict))
        self.hosts = sorted(by_host)
        self.paths = []
        for host in self.hosts:
            names, parents, stack = sorted(by_host[host]), [], []
            for i, name in enumerate(names):
                while stack and not name.startswith(names[stack[-1]]):
                    stack.pop()
                parents.append(stack[-1] if stack else -1)
                stack.append(i)
            self.paths.append((names, parents, [by_host[host][n] for n in names]))
        self.next, self.stack = 0, []

    def longest(self, entry: int, path: str) -> tuple[str, str] | None:
        names, parents, rules = self.paths[entry]
        i = bisect.bisect_right(names, path) - 1
        while i >= 0 and not path.startswith(names[i]):
            i = parents[i]
        return rules[i] if i >= 0 else None

    def judge(self, key: str, path: str) -> tuple[str | None, str | None]:
        """The longest rule that fits, and its verdict; keys must not decrease from call to call."""
        while self.stack and not key.startswith(self.hosts[self.stack[-1]]):
            self.stack.pop()
        while self.next < len(self.hosts) and self.hosts[self.next] <= key:
            if key.startswith(self.hosts[self.next]):
                self.stack.append(self.next)
            self.next += 1
        found = [x for entry in self.stack if (x := self.longest(entry, path))]
        return max(found, key=lambda x: (len(x[0]), x[0].find("/") if "/" in x[0] else len(x[0]))) if found else (None, None)


def _key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _judged(sweep: Sweep, keys: list[str], paths: list[str]) -> list[pa.Array]:
    found = [sweep.judge(k, p) for k, p in zip(keys, paths, strict=True)]
    return [pa.array([x[i] for x in found], pa.string()) for i in range(2)]


def _swept(keyed: DataFrame, rules: list[tuple[str, str]], kind: str) -> DataFrame:
    """The sweep in each partition of keyed (page_id, host, path, key), with all rules."""
    names = ["page_id", "host", "path"]

    def run(batches):
        sweep = Sweep(rules)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *_judged(sweep, batch.column(3).to_pylist(), batch.column(2).to_pylist())], [*names, "rule", "verdict"])

    return keyed.select(*names, "key").sortWithinPartitions("key", "path").mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")


def _splitters(keyed: DataFrame, rules: DataFrame, ranges: int) -> list[tuple[str, str, int]]:
    """Up to ranges - 1 places (key, path, hash) that part URLs and rules into about equal ranges."""
    rows = keyed.select("key", "path", "h").unionByName(rules.select("key", "path", "h"))
    n = rows.count()
    share = min(1.0, SAMPLED * ranges / max(n, 1))
    some = rows.where(F.pmod(F.xxhash64("key", "path", "h"), F.lit(1 << 30)) < int(share * (1 << 30)))
    places = sorted({(r.key, r.path, r.h) for r in some.collect()})
    return [places[len(places) * i // ranges] for i in range(1, ranges)] if len(places) > ranges else places[1:]


def _dealt_sweep(keyed: DataFrame, rules: DataFrame, kind: str) -> DataFrame:
    """The sweep in each range of keys, with the rules that may fit there."""
    ranges = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rules = rules.withColumns({"key": _key(F.substring_index("rule", "/", 1)), "path": F.substring(F.col("rule"), F.lit(1) + F.length(F.substring_index("rule", "/", 1)), F.length("rule")), "h": F.lit(-(1 << 63))})  # before all URLs
    keyed = keyed.withColumn("h", F.xxhash64("page_id"))
    places = _splitters(keyed, rules, ranges)
    first = [("", "", -(1 << 63)), *places]
    inside: dict[str, list[int]] = {}  # rule key -> the ranges that start inside its interval
    for i, (key, _, _) in enumerate(first):
        labels = key.split(".")[:-1]
        for n in range(1, len(labels) + 1):
            inside.setdefault("".join(f"{x}." for x in labels[:n]), []).append(i)

    def place(key: pa.Array, path: pa.Array, h: pa.Array) -> pa.Array:
        return pa.array([bisect.bisect_right(places, x) for x in zip(key.to_pylist(), path.to_pylist(), h.to_pylist(), strict=True)], pa.int32())

    def everywhere(key: pa.Array, path: pa.Array, h: pa.Array) -> pa.Array:
        own = place(key, path, h).to_pylist()
        return pa.array([sorted({i, *inside.get(k, ())}) for i, k in zip(own, key.to_pylist(), strict=True)], pa.list_(pa.int32()))

    urls = keyed.select(F.arrow_udf(place, "int")("key", "path", "h").alias("pid"), F.lit(1).alias("kind"), "key", "path", "page_id", "host", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    dealt = rules.select(F.explode(F.arrow_udf(everywhere, "array<int>")("key", "path", "h")).alias("pid"), F.lit(0).alias("kind"), "key", "path", F.lit(None).cast(kind).alias("page_id"), F.lit(None).cast("string").alias("host"), "rule", "verdict")

    def run(batches):
        own, sweep = [], None
        for batch in batches:
            n = pa.compute.sum(pa.compute.equal(batch.column(0), 0)).as_py() or 0  # rules stand first
            own += zip(batch.column(5).slice(0, n).to_pylist(), batch.column(6).slice(0, n).to_pylist(), strict=True)
            rest = batch.slice(n)
            if rest.num_rows:
                sweep = sweep or Sweep(own)
                yield pa.RecordBatch.from_arrays([rest.column(3), rest.column(4), rest.column(2), *_judged(sweep, rest.column(1).to_pylist(), rest.column(2).to_pylist())], ["page_id", "host", "path", "rule", "verdict"])

    rows = urls.unionByName(dealt).repartitionById(len(first), "pid").sortWithinPartitions("kind", "key", "path")
    return rows.select("kind", "key", "path", "page_id", "host", "rule", "verdict").mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")


def judge(pages: DataFrame, rules: DataFrame | list[tuple[str, str]], default: str = "allow", most: int = RULES) -> DataFrame:
    """pages (page_id, url, ...) -> (page_id, host, path, rule, verdict), a row for each row; rules: (rule, verdict), as a list or
    a table of any size.

    A rule fits its host and all subdomains, if the url's path starts with the rule's path. The longest rule that fits
    wins (of equally long ones that with the longer host; block before allow); without one, rule is null and the verdict
    is `default`. A null url, or one without ://, has an empty host and path and no rule; a rule or verdict that is null is none. More
    than `most` rules (counted) of a table are dealt out with the URLs. Repeated rows are judged one by one; further columns
    are ignored; an empty table gives an empty one."""
    host, path = host_and_path(F.col("url"))
    kind = pages.schema["page_id"].dataType.simpleString()
    keyed = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("key", _key(F.col("host")))
    if isinstance(rules, DataFrame):
        rules = rules.select("rule", "verdict").where("rule is not null and verdict is not null")
        few = rules.limit(most + 1).collect() if rules.limit(most + 1).count() <= most else None
        out = _dealt_sweep(keyed, rules, kind) if few is None else _swept(keyed, [tuple(r) for r in few], kind)
    else:
        out = _swept(keyed, list(rules), kind)
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
