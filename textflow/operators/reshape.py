"""Groups to items and back: one row for each text, keyed (group_idx, role, idx), and nested forms rebuilt from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = ("query", "positive", "negative")


def item_id(group: Column, role: Column, idx: Column) -> Column:
    """q_000001_query, q_000001_p_000, q_000001_n_0000: positions from 0; larger numbers have more digits."""
    head = F.format_string("q_%06d", group)
    return F.when(role == "query", F.concat(head, F.lit("_query"))).when(role == "positive", F.concat(head, F.format_string("_p_%03d", idx))).otherwise(F.concat(head, F.format_string("_n_%04d", idx)))


def expand(groups: DataFrame) -> DataFrame:
    """groups (group_idx, query, positive, negative) -> group_idx, item_id, role, idx (from 0 on each side; 0 for the query), source."""

    def side(column: str) -> Column:
        return F.transform(F.coalesce(column, F.array().cast("array<string>")), lambda x, i: F.struct(F.lit(column).alias("role"), i.alias("idx"), x.alias("source")))

    rows = F.concat(F.array(F.struct(F.lit("query").alias("role"), F.lit(0).alias("idx"), F.col("query").alias("source"))), side("positive"), side("negative"))
    flat = groups.select("group_idx", F.explode(rows).alias("x")).select("group_idx", "x.*")
    return flat.select("group_idx", item_id(F.col("group_idx"), F.col("role"), F.col("idx")).alias("item_id"), "role", "idx", "source")


def ordered(value: str, where: Column, order: str = "idx") -> Column:
    """An aggregate: the values of rows that meet a condition, by `order`."""
    rows = F.array_sort(F.collect_list(F.when(where, F.struct(order, value))))
    return F.transform(rows, lambda x: x[value])


def renest(items: DataFrame, value: str = "source") -> DataFrame:
    """The inverse of expand(), whatever the order of the rows."""
    role = F.col("role")
    return items.groupBy("group_idx").agg(F.max(F.when(role == "query", F.col(value))).alias("query"), ordered(value, role == "positive").alias("positive"), ordered(value, role == "negative").alias("negative"))


def renest_accepted(items: DataFrame, value: str = "source", status: str = "status", drop_failing_positives: bool = False) -> DataFrame:
    """renest() of accepted items only. A group is kept if its query and every positive is accepted; or, with
    drop_failing_positives, if its query and some positive is."""
    role, ok = F.col("role"), F.col(status) == "accepted"
    out = items.groupBy("group_idx").agg(
        F.max(F.when((role == "query") & ok, F.col(value))).alias("query"), ordered(value, (role == "positive") & ok).alias("positive"), ordered(value, (role == "negative") & ok).alias("negative"),
        F.bool_and(F.when(role != "negative", F.coalesce(ok, F.lit(False)))).alias("all_ok"), F.count_if((role == "positive") & ok).alias("n_positive"), F.count_if((role == "query") & ok).alias("n_query"),
    )
    keep = (F.col("n_query") > 0) & (F.col("n_positive") > 0) if drop_failing_positives else F.col("all_ok")
    return out.where(keep).select("group_idx", "query", "positive", "negative")


def group_summary(items: DataFrame) -> DataFrame:
    """items (group_idx, item_id, role, status, hard_pass, semantic_pass, relation_preserved, retry_rounds) -> one row a
    group. A missing hard_pass is a failure, a missing semantic or relation verdict is not; queries have no relation."""
    return items.groupBy("group_idx").agg(
        F.bool_and(F.coalesce("hard_pass", F.lit(False))).alias("hard_pass"),
        F.bool_and(F.coalesce("semantic_pass", F.lit(True))).alias("semantic_pass"),
        F.bool_and(F.when(F.col("role") != "query", F.coalesce("relation_preserved", F.lit(True))).otherwise(F.lit(True))).alias("relation_preserved"),
        F.max("retry_rounds").alias("repair_rounds"),
        F.array_sort(F.collect_list(F.when(F.col("status") != "accepted", F.col("item_id")))).alias("failed_items"),
    )


def qa_report(summary: DataFrame) -> DataFrame:
    """One row over group_summary()."""
    ready = F.col("hard_pass") & F.col("semantic_pass") & F.col("relation_preserved") & (F.size("failed_items") == 0)
    return summary.agg(F.count("*").alias("total_groups"), F.count_if(ready).alias("accepted_groups"), F.count_if(~ready).alias("failed_groups"), F.sum(F.size("failed_items")).alias("failed_items"), F.max("repair_rounds").alias("max_rounds"))


def precheck(groups: DataFrame) -> DataFrame:
    """groups with errors: empty_query, empty_positive, empty_negative, duplicate_positive."""
    few = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    checks = [(F.trim(F.coalesce("query", F.lit(""))) == "", "empty_query"), (few("positive"), "empty_positive"), (few("negative"), "empty_negative"), (F.size(F.array_distinct("positive")) != F.size("positive"), "duplicate_positive")]
    return groups.withColumn("errors", F.array_compact(F.array(*(F.when(c, n) for c, n in checks))))


def structure_errors(items: DataFrame, expected: DataFrame) -> DataFrame:
    """items against expected (group_idx, role, n): group_idx, role, expected, found where they differ; and rows of role
    `duplicate` for item ids that repeat."""
    found = items.groupBy("group_idx", "role").agg(F.count("*").alias("found"))
    counts = expected.join(found, ["group_idx", "role"], "full").select("group_idx", "role", F.coalesce("n", F.lit(0)).cast("long").alias("expected"), F.coalesce("found", F.lit(0)).cast("long").alias("found")).where("expected <> found")
    again = items.groupBy("group_idx", "item_id").agg(F.count("*").alias("found")).where("found > 1").groupBy("group_idx").agg(F.sum("found").alias("found"), F.count("*").alias("expected"))
    return counts.unionByName(again.select("group_idx", F.lit("duplicate").alias("role"), "expected", "found"))


def sanity(groups: DataFrame, residue: list[str]) -> DataFrame:
    """groups with problems: empties, positives that are negatives too, placeholders, residue words."""
    texts = F.concat(F.array("query"), F.coalesce("positive", F.array().cast("array<string>")), F.coalesce("negative", F.array().cast("array<string>")))
    word = r"(?iU)\b(" + "|".join(residue) + r")\b"
    checks = [
        ("empty", F.exists(texts, lambda x: F.trim(F.coalesce(x, F.lit(""))) == "")), ("overlap", F.size(F.array_intersect("positive", "negative")) > 0),
        ("placeholder", F.exists(texts, lambda x: F.coalesce(x.rlike("(?i)<ENT[^>]*>"), F.lit(False)))), ("residue", F.exists(texts, lambda x: F.coalesce(x.rlike(word), F.lit(False)))),
    ]
    return groups.withColumn("problems", F.array_compact(F.array(*(F.when(c, n) for n, c in checks))))


def turns(dialogues: DataFrame) -> DataFrame:
    """dialogues (dialogue_id, turns) -> a row for each turn; dialogue_id a long, turn an int (0 where there is none), roles and
    texts trimmed, null ones empty. Rows have no order but that of their column turn."""
    flat = dialogues.select(F.col("dialogue_id").cast("long").alias("dialogue_id"), F.explode("turns").alias("t")).select("dialogue_id", "t.*")
    texts = {c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in flat.columns if c.startswith("content") or c == "role"}
    return flat.withColumns(texts | ({"turn": F.coalesce(F.col("turn").cast("int"), F.lit(0))} if "turn" in flat.columns else {}))


def from_debug(debug: DataFrame) -> DataFrame:
    """Nested debug groups (group_idx, query_id, query_idn, query_msa, positive, negative arrays of struct(id, idn, msa, ...)) ->
    items (group_idx, role, idx, id, idn, msa, ...): the query, with idx 0 and null for what only candidates have, and all
    candidates; idx is the number after the last _ of the id. A missing side has no items."""
    kind = debug.schema["positive"].dataType
    given = {"id": F.concat("query_id", F.lit("_query")), "idn": F.col("query_idn"), "msa": F.col("query_msa")}
    query = F.struct(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.elementType.fields))

    def side(role: str) -> Column:
        return F.transform(F.coalesce(role, F.array().cast(kind)), lambda x: F.struct(F.lit(role).alias("role"), x.alias("item")))

    rows = debug.select("group_idx", F.explode(F.concat(F.array(F.struct(F.lit("query").alias("role"), query.alias("item"))), side("positive"), side("negative"))).alias("x"))
    idx = F.when(F.col("x.role") == "query", 0).otherwise(F.element_at(F.split("x.item.id", "_"), -1).cast("int"))
    return rows.select("group_idx", "x.role", idx.alias("idx"), "x.item.*")


def write_back(dialogues: DataFrame, translations: DataFrame, content: str = "content", to: str = "content_msa", key: str = "dialogue_id") -> DataFrame:
    """dialogues (dialogue_id, turns array<struct>, ...) with `to` of a turn replaced by the target of its trimmed content in
    translations (source, target), only where there is one; other turns and fields, and the turns' order, stay as they are.
    dialogue_id is unique; a dialogue without turns stays as it is."""
    kind = dialogues.schema["turns"].dataType
    flat = dialogues.select(key, F.posexplode("turns").alias("pos", "t"))
    one = translations.groupBy("source").agg(F.max("target").alias("target"))
    flat = flat.withColumn("source", F.trim(F.coalesce(F.col("t")[content], F.lit("")))).join(one, "source", "left")
    old = F.col("t")[to] if to in kind.elementType.names else F.lit(None).cast("string")
    turn = F.col("t").withField(to, F.coalesce("target", old))
    nested = flat.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", turn.alias("t"))), lambda a, b: a["pos"] - b["pos"]), lambda x: x["t"]).alias("new"))
    empty = F.transform("turns", lambda t: t.withField(to, t[to] if to in kind.elementType.names else F.lit(None).cast("string")))
    return dialogues.join(nested, key, "left").withColumn("turns", F.coalesce("new", empty)).drop("new")


def assembly_summary(groups: DataFrame, misses: DataFrame, cache: DataFrame, new_queries: int = 0) -> DataFrame:
    """One row over assembled groups (query, positive, negative), the texts without a cache entry and the cache: complete
    means that nothing misses and no placeholder is left."""
    texts = F.concat(F.array("query"), F.coalesce("positive", F.array().cast("array<string>")), F.coalesce("negative", F.array().cast("array<string>")))
    left = F.size(F.filter(texts, lambda x: F.coalesce(x.rlike("(?i)<ENT[^>]*>"), F.lit(False))))
    each = groups.agg(F.count("*").alias("total_groups"), F.coalesce(F.sum(left), F.lit(0)).cast("long").alias("placeholders_left"))
    counts = cache.agg(F.count("*").alias("cache_entries")).crossJoin(misses.agg(F.count("*").alias("cache_misses")))  # one row each
    out = each.crossJoin(counts).withColumn("new_queries", F.lit(new_queries).cast("long"))
    return out.withColumn("complete", (F.col("cache_misses") == 0) & (F.col("placeholders_left") == 0))


def same_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: whether two tables have the same set of keys, and how many keys only one of them has."""
    marked = a.select(key, F.lit(1).alias("side")).unionByName(b.select(key, F.lit(2).alias("side")))
    each = marked.groupBy(key).agg(F.bit_or("side").alias("sides"))
    return each.agg(F.count_if(F.col("sides") == 1).alias("only_left"), F.count_if(F.col("sides") == 2).alias("only_right")).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))
