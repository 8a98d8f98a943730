"""Catalogue queries over grouped records, lookups and logs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.operators import judges, lookup, reshape, textcache

QUERIES, ORACLE_SQL = {}, {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def conversation_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as groups: turn 0 is the query, assistant turns are positives, other user turns negatives."""
    c = table(spark, sf_dir, "conversations")
    first, answer = F.col("turn") == 0, F.col("role") == "assistant"
    items = c.select(F.col("conv_id").alias("group_idx"), F.when(first, "query").when(answer, "positive").otherwise("negative").alias("role"), F.col("turn").alias("idx"), F.col("text").alias("source"))
    return reshape.renest(items)


_GROUPS = """groups AS (SELECT conv_id AS group_idx, max(CASE WHEN turn = 0 THEN text END) AS query,
  coalesce(list(text ORDER BY turn) FILTER (WHERE turn > 0 AND role = 'assistant'), []) AS positive,
  coalesce(list(text ORDER BY turn) FILTER (WHERE turn > 0 AND role <> 'assistant'), []) AS negative FROM conversations GROUP BY conv_id)"""
_ITEMS = f"""{_GROUPS},
flat AS (SELECT group_idx, 'query' AS role, 0 AS idx, query AS source FROM groups
  UNION ALL SELECT group_idx, 'positive', unnest(range(len(positive))), unnest(positive) FROM groups
  UNION ALL SELECT group_idx, 'negative', unnest(range(len(negative))), unnest(negative) FROM groups),
items AS (SELECT group_idx, printf('q_%06d', group_idx) || CASE role WHEN 'query' THEN '_query' WHEN 'positive' THEN printf('_p_%03d', idx) ELSE printf('_n_%04d', idx) END AS item_id, role, idx, source FROM flat)"""
_STATUS = "CASE WHEN length(source) % 7 = 0 THEN 'failed' ELSE 'accepted' END"


def _status():
    return F.when(F.length("source") % 7 == 0, "failed").otherwise("accepted")


@query(f"WITH {_ITEMS} SELECT * FROM items")
def expand_items(spark, sf_dir):
    return reshape.expand(conversation_groups(spark, sf_dir))


@query(f"WITH {_GROUPS} SELECT group_idx, query, array_to_string(positive, '|') AS positive, array_to_string(negative, '|') AS negative FROM groups")
def renest_simple(spark, sf_dir):
    out = reshape.renest(reshape.expand(conversation_groups(spark, sf_dir)))
    return out.select("group_idx", "query", F.array_join("positive", "|").alias("positive"), F.array_join("negative", "|").alias("negative"))


@query(f"""WITH {_ITEMS}, s AS (SELECT *, {_STATUS} AS status FROM items)
SELECT group_idx, max(source) FILTER (WHERE role = 'query') AS query, coalesce(string_agg(source, '|' ORDER BY idx) FILTER (WHERE role = 'positive'), '') AS positive,
  coalesce(string_agg(source, '|' ORDER BY idx) FILTER (WHERE role = 'negative' AND status = 'accepted'), '') AS negative
FROM s GROUP BY group_idx HAVING bool_and(status = 'accepted') FILTER (WHERE role <> 'negative')""")
def renest_partial(spark, sf_dir):
    items = reshape.expand(conversation_groups(spark, sf_dir)).withColumn("status", _status())
    out = reshape.renest_accepted(items)
    return out.select("group_idx", "query", F.array_join("positive", "|").alias("positive"), F.array_join("negative", "|").alias("negative"))


@query(f"""WITH {_ITEMS}, s AS (SELECT *, {_STATUS} AS status FROM items)
SELECT group_idx, max(source) FILTER (WHERE role = 'query') AS query, coalesce(string_agg(source, '|' ORDER BY idx) FILTER (WHERE role = 'positive' AND status = 'accepted'), '') AS positive
FROM s GROUP BY group_idx HAVING bool_or(role = 'query' AND status = 'accepted') AND bool_or(role = 'positive' AND status = 'accepted')""")
def renest_drop_failing(spark, sf_dir):
    items = reshape.expand(conversation_groups(spark, sf_dir)).withColumn("status", _status())
    return reshape.renest_accepted(items, drop_failing_positives=True).select("group_idx", "query", F.array_join("positive", "|").alias("positive"))


def _judged(spark, sf_dir):
    n = F.length("source")
    return reshape.expand(conversation_groups(spark, sf_dir)).select(
        "*", _status().alias("status"), F.when(n % 5 != 0, n % 7 != 0).alias("hard_pass"), F.when(n % 3 == 0, n % 6 == 0).alias("semantic_pass"), F.when(n % 2 == 0, n % 4 == 0).alias("relation_preserved"), (n % 3).alias("retry_rounds"),
    )


_SUMMARY = f"""{_ITEMS}, j AS (SELECT *, length(source) AS n, {_STATUS} AS status FROM items),
summary AS (SELECT group_idx, bool_and(CASE WHEN n % 5 <> 0 THEN n % 7 <> 0 ELSE false END) AS hard_pass, bool_and(CASE WHEN n % 3 = 0 THEN n % 6 = 0 ELSE true END) AS semantic_pass,
  bool_and(CASE WHEN role <> 'query' AND n % 2 = 0 THEN n % 4 = 0 ELSE true END) AS relation_preserved, max(n % 3) AS repair_rounds,
  coalesce(string_agg(item_id, ',' ORDER BY item_id) FILTER (WHERE status <> 'accepted'), '') AS failed_items, count(*) FILTER (WHERE status <> 'accepted') AS n_failed FROM j GROUP BY group_idx)"""


@query(f"WITH {_SUMMARY} SELECT group_idx, hard_pass, semantic_pass, relation_preserved, repair_rounds, failed_items FROM summary")
def group_debug_summary(spark, sf_dir):
    return reshape.group_summary(_judged(spark, sf_dir)).withColumn("failed_items", F.array_join("failed_items", ","))


@query(f"""WITH {_SUMMARY}, r AS (SELECT *, hard_pass AND semantic_pass AND relation_preserved AND n_failed = 0 AS ready FROM summary)
SELECT count(*) AS total_groups, count(*) FILTER (WHERE ready) AS accepted_groups, count(*) FILTER (WHERE NOT ready) AS failed_groups, CAST(sum(n_failed) AS BIGINT) AS failed_items, max(repair_rounds) AS max_rounds FROM r""")
def qa_report(spark, sf_dir):
    return reshape.qa_report(reshape.group_summary(_judged(spark, sf_dir)))


@query(f"""WITH {_GROUPS} SELECT group_idx, array_to_string(list_filter([CASE WHEN trim(coalesce(query, '')) = '' THEN 'empty_query' END, CASE WHEN len(positive) = 0 THEN 'empty_positive' END,
  CASE WHEN len(negative) = 0 THEN 'empty_negative' END, CASE WHEN len(list_distinct(positive)) <> len(positive) THEN 'duplicate_positive' END], lambda x: x IS NOT NULL), ',') AS errors FROM groups""")
def precheck_groups(spark, sf_dir):
    return reshape.precheck(conversation_groups(spark, sf_dir)).select("group_idx", F.array_join("errors", ",").alias("errors"))


@query(f"""WITH {_ITEMS}, expected AS (SELECT DISTINCT group_idx, r.role, 2 AS n FROM items, (VALUES ('query'), ('positive'), ('negative')) r(role)),
found AS (SELECT group_idx, role, count(*) AS found FROM items GROUP BY ALL)
SELECT e.group_idx, e.role, CAST(e.n AS BIGINT) AS expected, coalesce(f.found, 0) AS found FROM expected e LEFT JOIN found f USING (group_idx, role) WHERE e.n <> coalesce(f.found, 0)""")
def structure_check(spark, sf_dir):
    items = reshape.expand(conversation_groups(spark, sf_dir))
    expected = items.select("group_idx").distinct().select("group_idx", F.explode(F.array(*map(F.lit, reshape.ROLES))).alias("role"), F.lit(2).alias("n"))
    return reshape.structure_errors(items, expected)


@query(f"""WITH {_GROUPS}, t AS (SELECT group_idx, positive, negative, list_concat([query], positive, negative) AS texts FROM groups)
SELECT group_idx, array_to_string(list_filter([CASE WHEN len(list_filter(texts, lambda x: trim(coalesce(x, '')) = '')) > 0 THEN 'empty' END, CASE WHEN len(list_intersect(positive, negative)) > 0 THEN 'overlap' END,
  CASE WHEN len(list_filter(texts, lambda x: regexp_matches(x, '(?i)<ENT[^>]*>'))) > 0 THEN 'placeholder' END, CASE WHEN len(list_filter(texts, lambda x: regexp_matches(x, '(?i)\\b(the|and)\\b'))) > 0 THEN 'residue' END], lambda x: x IS NOT NULL), ',') AS problems FROM t""")
def sanity_groups(spark, sf_dir):
    return reshape.sanity(conversation_groups(spark, sf_dir), ["the", "and"]).select("group_idx", F.array_join("problems", ",").alias("problems"))


@query("SELECT text AS source, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, arg_min(source, doc_id) AS origin FROM documents GROUP BY text")
def distinct_first_wins(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("text").alias("source"), "doc_id", "lang", F.col("source").alias("origin"))
    return lookup.first_wins(docs, ["source"], "doc_id")


@query("SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id, event_type")
def log_last_wins(spark, sf_dir):
    return lookup.last_wins(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


def _texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("source"))


def _cache(spark, sf_dir):
    """Every third document's text, last row wins, reversed."""
    rows = table(spark, sf_dir, "documents").where("doc_id % 3 = 0").select(F.col("text").alias("source"), F.reverse("text").alias("target"), F.col("doc_id").alias("seq"))
    return lookup.last_wins(rows, ["source"], "seq").select("source", "target")


def _log(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where("doc_id % 3 = 1")
    return rows.select(F.col("text").alias("source"), F.concat(F.lit("log "), "text").alias("target"), F.when(F.col("doc_id") % 2 == 0, "accepted").otherwise("failed").alias("status"), F.col("doc_id").alias("seq"))


_CACHE = "cache AS (SELECT text AS source, reverse(text) AS target FROM documents WHERE doc_id % 3 = 0 GROUP BY text)"
_LOG = "log AS (SELECT text AS source, 'log ' || text AS target, CASE WHEN max(doc_id) % 2 = 0 THEN 'accepted' ELSE 'failed' END AS status FROM documents WHERE doc_id % 3 = 1 GROUP BY text)"


def _all_rows(spark, sf_dir):
    """Every third document as a row of a cache that keeps all its versions: copies of a text have several, the last counts."""
    rows = table(spark, sf_dir, "documents").where("doc_id % 3 = 0")
    return rows.select(F.col("text").alias("source"), F.concat(F.col("doc_id").cast("string"), F.lit(" "), F.reverse("text")).alias("target"), F.col("doc_id").alias("seq"))


_ALL_ROWS = "cache AS (SELECT text AS source, max(doc_id) || ' ' || reverse(text) AS target FROM documents WHERE doc_id % 3 = 0 GROUP BY text)"


@query(f"WITH {_CACHE} SELECT d.doc_id, c.target, c.target IS NOT NULL AS hit FROM documents d LEFT JOIN cache c ON d.text = c.source")
def cache_left_join(spark, sf_dir):
    return lookup.cached(_texts(spark, sf_dir), _cache(spark, sf_dir)).select("doc_id", "target", "hit")


@query(f"WITH {_ALL_ROWS} SELECT d.doc_id, c.target, c.target IS NOT NULL AS hit FROM documents d LEFT JOIN cache c ON d.text = c.source")
def bucketed_lookup(spark, sf_dir):
    """All documents looked up in a cache that is bucketed by the digest of its texts."""
    name = f"texts_{uuid.uuid4().hex}"
    textcache.save(_all_rows(spark, sf_dir), name, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return textcache.looked_up(_texts(spark, sf_dir), name).select("doc_id", "target", "hit")


@query(f"WITH {_CACHE}, {_LOG} SELECT DISTINCT text AS source FROM documents WHERE text NOT IN (SELECT source FROM cache) AND text NOT IN (SELECT source FROM log)")
def pending_anti(spark, sf_dir):
    return lookup.pending(_texts(spark, sf_dir), _cache(spark, sf_dir), _log(spark, sf_dir))


@query(f"""WITH {_ALL_ROWS}, {_LOG}, t AS (SELECT DISTINCT text AS source FROM documents), s AS (SELECT DISTINCT text AS source FROM documents WHERE n_chars < 200)
SELECT t.source, CASE WHEN s.source IS NOT NULL THEN t.source WHEN c.target IS NOT NULL THEN c.target WHEN l.status = 'accepted' THEN l.target END AS target,
  CASE WHEN s.source IS NOT NULL THEN 'skip' WHEN c.target IS NOT NULL THEN 'cache' WHEN l.status = 'accepted' THEN 'log' WHEN l.status = 'failed' THEN 'failed' ELSE 'missing' END AS origin
FROM t LEFT JOIN s USING (source) LEFT JOIN cache c USING (source) LEFT JOIN log l USING (source)""")
def translation_map(spark, sf_dir):
    skipped = table(spark, sf_dir, "documents").where("n_chars < 200").select(F.col("text").alias("source"))
    return lookup.translation_map(_texts(spark, sf_dir), skipped, _all_rows(spark, sf_dir), _log(spark, sf_dir))


@query(f"WITH {_CACHE}, {_LOG} SELECT source, coalesce(l.target, c.target) AS target FROM cache c FULL JOIN log l USING (source)")
def overlay_repairs(spark, sf_dir):
    return lookup.overlay(_cache(spark, sf_dir), lookup.last_wins(_log(spark, sf_dir), ["source"], "seq"))


@query(f"WITH {_CACHE}, {_LOG} SELECT source, coalesce(c.target, l.target) AS target FROM cache c FULL JOIN log l USING (source)")
def cache_backfill(spark, sf_dir):
    return lookup.backfill(_cache(spark, sf_dir), _log(spark, sf_dir))


@query(f"WITH {_CACHE} SELECT doc_id FROM documents WHERE text NOT IN (SELECT source FROM cache)")
def lookup_misses(spark, sf_dir):
    return lookup.misses(_texts(spark, sf_dir), _cache(spark, sf_dir)).select("doc_id")


@query(f"""WITH {_ITEMS}, cache AS (SELECT source, max(item_id) || reverse(source) AS target FROM items WHERE length(source) % 11 <> 0 GROUP BY source),
f AS (SELECT i.*, c.target FROM items i LEFT JOIN cache c USING (source))
SELECT group_idx, max(target) FILTER (WHERE role = 'query') AS query, coalesce(string_agg(target, '|' ORDER BY idx) FILTER (WHERE role = 'positive'), '') AS positive FROM f
GROUP BY group_idx HAVING bool_and(target IS NOT NULL) FILTER (WHERE role <> 'negative')""")
def all_or_nothing_lookup(spark, sf_dir):
    groups = conversation_groups(spark, sf_dir)
    items = reshape.expand(groups).where("length(source) % 11 <> 0")  # a source as often as it is found, the last item wins
    cache = items.select("source", F.concat("item_id", F.reverse("source")).alias("target"), F.col("item_id").alias("seq"))
    return lookup.all_or_nothing(groups, "group_idx", ["query"], ["positive"], cache).select("group_idx", "query", F.array_join("positive", "|").alias("positive"))


@query(f"""WITH {_GROUPS} SELECT group_idx, unnest(range(least(len(positive), len(negative)))) AS pos, unnest(positive[:least(len(positive), len(negative))]) AS "left", unnest(negative[:least(len(positive), len(negative))]) AS "right" FROM groups""")
def zip_align(spark, sf_dir):
    g = conversation_groups(spark, sf_dir)
    return lookup.zipped(g, g, ["group_idx"], "positive", "negative")


@query("SELECT text FROM benchmark UNION ALL SELECT DISTINCT text FROM documents WHERE text IS NOT NULL AND text NOT IN (SELECT text FROM benchmark)")
def append_new_only(spark, sf_dir):
    return lookup.append_new(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


@query(f"WITH {_GROUPS} SELECT group_idx, len(list_intersect(string_split(array_to_string(positive, ' '), ' '), string_split(array_to_string(negative, ' '), ' '))) AS overlap FROM groups")
def pos_neg_overlap(spark, sf_dir):
    """Words that stand on both sides of a group."""
    words = lambda c: F.split(F.array_join(c, " "), " ")
    return conversation_groups(spark, sf_dir).select("group_idx", F.size(F.array_intersect(words("positive"), words("negative"))).cast("long").alias("overlap"))


@query(f"WITH {_ITEMS} SELECT group_idx, source, CASE WHEN role = 'positive' THEN 1 ELSE 0 END AS label FROM items WHERE role <> 'query'")
def labelled_union(spark, sf_dir):
    items = reshape.expand(conversation_groups(spark, sf_dir))
    positive = items.where("role = 'positive'").select("group_idx", "source", F.lit(1).alias("label"))
    return positive.unionByName(items.where("role = 'negative'").select("group_idx", "source", F.lit(0).alias("label")))


@query("""WITH want AS (SELECT conv_id, unnest(range(8)) AS turn FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT conv_id, turn FROM want EXCEPT SELECT conv_id, turn FROM conversations""")
def missing_turns_except(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    want = c.select("conv_id").distinct().select("conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("turn"))
    return want.exceptAll(c.select("conv_id", "turn").distinct())


_TURNS = """turns AS (SELECT conv_id, turn, text, trim(text) AS source, CASE WHEN turn = 0 THEN 'old' END AS old FROM conversations)"""


@query(f"""WITH {_TURNS} SELECT conv_id AS dialogue_id, count(*) AS n, string_agg(turn || '=' || coalesce(CASE WHEN length(source) % 3 = 0 THEN reverse(source) END, old, '-'), '|' ORDER BY turn) AS turns FROM turns GROUP BY conv_id""")
def write_back_nested(spark, sf_dir):
    """Translations of a third of the texts put back into nested dialogues; other turns keep what they had."""
    c = table(spark, sf_dir, "conversations")
    turn = F.struct("turn", "role", F.col("text").alias("content"), F.when(F.col("turn") == 0, "old").alias("content_msa"))
    nested = c.groupBy(F.col("conv_id").alias("dialogue_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    source = F.trim("text")
    translations = c.where(F.length(source) % 3 == 0).select(source.alias("source"), F.reverse(source).alias("target")).distinct()
    out = reshape.write_back(nested, translations)
    shown = F.transform("turns", lambda t: F.concat(t["turn"].cast("string"), F.lit("="), F.coalesce(t["content_msa"], F.lit("-"))))
    return out.select("dialogue_id", F.size("turns").cast("long").alias("n"), F.array_join(shown, "|").alias("turns"))


@query(f"""WITH {_ITEMS}, cache AS (SELECT DISTINCT source FROM items WHERE length(source) % 11 <> 0), m AS (SELECT count(*) AS n FROM items WHERE source NOT IN (SELECT source FROM cache))
SELECT count(DISTINCT group_idx) AS total_groups, count(*) FILTER (WHERE regexp_matches(source, '(?i)<ENT[^>]*>')) AS placeholders_left, (SELECT count(*) FROM cache) AS cache_entries, (SELECT n FROM m) AS cache_misses,
  CAST(7 AS BIGINT) AS new_queries, (SELECT n FROM m) = 0 AND count(*) FILTER (WHERE regexp_matches(source, '(?i)<ENT[^>]*>')) = 0 AS complete FROM items""")
def assembly_summary(spark, sf_dir):
    groups = conversation_groups(spark, sf_dir)
    items = reshape.expand(groups)
    cache = items.where("length(source) % 11 <> 0").select("source").distinct()
    return reshape.assembly_summary(groups, lookup.misses(items, cache), cache, new_queries=7)


@query("SELECT DISTINCT text AS source FROM documents WHERE doc_id % 3 = 1 AND doc_id % 2 <> 0")
def failure_set(spark, sf_dir):
    return lookup.failed_sources(_log(spark, sf_dir))


@query("""WITH a AS (SELECT DISTINCT conv_id FROM conversations WHERE turn = 2), b AS (SELECT DISTINCT conv_id FROM conversations WHERE turn = 4),
n AS (SELECT (SELECT count(*) FROM a WHERE conv_id NOT IN (SELECT conv_id FROM b)) AS only_left, (SELECT count(*) FROM b WHERE conv_id NOT IN (SELECT conv_id FROM a)) AS only_right)
SELECT only_left, only_right, only_left + only_right = 0 AS equal FROM n""")
def key_set_equality(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return reshape.same_keys(c.where("turn = 2"), c.where("turn = 4"), "conv_id")


@query(f"WITH {_ITEMS}, t AS (SELECT DISTINCT source AS text FROM items WHERE role <> 'query') SELECT row_number() OVER (ORDER BY text) - 1 AS cand_id, text FROM t")
def canonical_candidates(spark, sf_dir):
    from textflow.operators.retrieval import canonical

    return canonical(conversation_groups(spark, sf_dir))


def _translated(spark, sf_dir):
    return reshape.expand(conversation_groups(spark, sf_dir)).withColumn("target", F.reverse("source"))


@query(f"""WITH {_ITEMS}, j AS (SELECT item_id, length(source) AS n FROM items), e AS (SELECT *, n % 11 = 0 AS critical, n % 13 = 0 AS entity FROM j),
p AS (SELECT *, 2 + n % 5 >= 4 AND n % 7 <> 0 AND NOT critical AND NOT entity AS semantic_pass FROM e)
SELECT item_id, CAST(2 + n % 5 AS INT) AS score, semantic_pass, CASE WHEN critical AND entity THEN 'lost,name' WHEN critical THEN 'lost' WHEN entity THEN 'name' WHEN NOT semantic_pass THEN 'semantic_check_failed' ELSE '' END AS errors FROM p""")
def semantic_gate(spark, sf_dir):
    judged = judges.meaning(_translated(spark, sf_dir), judges.StubJudge())
    return judged.select("item_id", "score", "semantic_pass", F.array_join("semantic_errors", ",").alias("errors"))


@query(f"""WITH {_ITEMS}, c AS (SELECT *, row_number() OVER (PARTITION BY group_idx ORDER BY CASE role WHEN 'positive' THEN 0 ELSE 1 END, idx) - 1 AS place FROM items WHERE role <> 'query'),
r AS (SELECT item_id, place >= 3 AND role = 'negative' AS relation_skipped, place >= 3 AND role = 'negative' OR (2 * length(source) + length(role)) % 9 <> 0 AS relation_preserved FROM c
  UNION ALL SELECT item_id, NULL, NULL FROM items WHERE role = 'query')
SELECT item_id, relation_preserved, relation_skipped, CASE WHEN NOT relation_preserved THEN 'failed' ELSE 'accepted' END AS status, CASE WHEN NOT relation_preserved THEN false ELSE true END AS semantic_pass FROM r""")
def relation_gate(spark, sf_dir):
    judged = judges.relation(_translated(spark, sf_dir), judges.StubJudge(), limit=3)
    out = judges.gate(judged.withColumn("status", F.lit("accepted")).withColumn("semantic_pass", F.lit(True)))
    return out.select("item_id", "relation_preserved", "relation_skipped", "status", "semantic_pass")
