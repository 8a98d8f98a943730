"""Catalogue queries of payloads, answers, samples and encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from textflow.functions import vectors as V
from textflow.operators import encoders, payloads, reshape
from textflow.plans.groups import _ITEMS, conversation_groups, table
from textflow.plans.texts import _TRIAGE, _failed
from textflow.operators import qa
from textflow.plans.rule_pack import PACK
from textflow.sources import versions
from textflow.sources.shared import new_path

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"""WITH {_ITEMS}, n AS (SELECT *, row_number() OVER (PARTITION BY group_idx ORDER BY item_id) - 1 AS k FROM items)
SELECT group_idx, CAST(k // 4 AS INT) AS batch, count(*) AS n, '[' || string_agg('{{"item_id":"' || item_id || '","length":' || length(source) || '}}', ',' ORDER BY k) || ']' AS payload FROM n GROUP BY 1, 2""")
def payload_batches(spark, sf_dir):
    items = reshape.expand(conversation_groups(spark, sf_dir)).withColumn("length", F.length("source"))
    return payloads.batches(items, "group_idx", "item_id", 4, ["item_id", "length"])


@query(f"""WITH {_ITEMS} SELECT item_id, CASE WHEN length(source) % 4 <> 0 THEN reverse(source) END AS target, length(source) % 4 = 0 OR trim(source) = '' AS missing FROM items""")
def answers_aligned(spark, sf_dir):
    items = reshape.expand(conversation_groups(spark, sf_dir))
    answers = items.where("length(source) % 4 <> 0").select("item_id", F.reverse("source").alias("target"), F.lit(0).alias("seq"))
    return payloads.aligned(items, answers).select("item_id", "target", "missing")


@query("""WITH e AS (SELECT conv_id AS cluster_id, turn, text AS content, CASE WHEN length(text) % 5 <> 0 THEN 'filled ' || text END AS filled FROM conversations)
SELECT cluster_id, coalesce(string_agg(turn || '=' || filled, ';' ORDER BY turn) FILTER (WHERE filled IS NOT NULL), '') AS turns,
  CASE WHEN count(*) FILTER (WHERE filled IS NULL) > 0 THEN 'missing_turns:' || string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) FILTER (WHERE filled IS NULL) END AS error FROM e GROUP BY cluster_id""")
def filled_turns(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "cluster_id")
    out = payloads.filled_turns(c.select("cluster_id", "turn", F.col("text").alias("content")), c.where("length(text) % 5 <> 0").select("cluster_id", "turn", F.concat(F.lit("filled "), "text").alias("filled")))
    return out.select("cluster_id", F.array_join(F.transform("turns", lambda x: F.concat(x.turn.cast("string"), F.lit("="), x.filled)), ";").alias("turns"), "error")


@query("""SELECT item_id, CASE item_id % 4 WHEN 0 THEN 'Instruct: find it' || chr(10) || 'Query: ' || text WHEN 1 THEN 'query: ' || text WHEN 2 THEN 'task: find it | query: ' || text ELSE text END AS styled FROM benchmark""")
def query_styles(spark, sf_dir):
    style = F.element_at(F.array(*map(F.lit, ("instruct", "prefix", "task", "plain"))), (F.col("item_id") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "benchmark").select("item_id", payloads.styled(F.col("text"), style, F.lit("find it")).alias("styled"))


@query("SELECT lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sha1('0|' || doc_id), doc_id) <= 5")
def hash_sample(spark, sf_dir):
    return payloads.sample(table(spark, sf_dir, "documents").select("lang", "doc_id"), ["lang"], "doc_id", 5)


@query("SELECT source, count(*) AS n, array_to_string(list(doc_id ORDER BY doc_id)[1:8], ',') AS samples FROM documents GROUP BY source")
def capped_samples(spark, sf_dir):
    out = payloads.capped(table(spark, sf_dir, "documents").select("source", "doc_id"), ["source"], "doc_id", 8)
    return out.select("source", "n", F.array_join(F.transform("samples", lambda x: x.cast("string")), ",").alias("samples"))


@query(f"""WITH {_TRIAGE} SELECT t.doc_id AS item_id, 'low_value' AS reason FROM t WHERE repair_priority = 'P2_DROP'
UNION ALL SELECT t.doc_id, 'repair_failed' FROM t JOIN f USING (doc_id) WHERE repair_priority IN ('P0', 'P1') AND t.doc_id % 7 = 0 AND role = 'negative'""")
def dropped_items(spark, sf_dir):
    triaged = qa.triage(_failed(spark, sf_dir).withColumnRenamed("doc_id", "item_id"), PACK)
    repaired = payloads.by_priority(triaged)[0].withColumn("repair_status", F.when(F.col("item_id") % 7 == 0, "failed").otherwise("accepted"))
    return payloads.dropped(triaged, repaired)


@query()
def encode_distinct(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    v = F.col("vector")
    largest = F.array_max(v)
    return encoders.encode(docs, "text", "hashed").select("doc_id", F.round(V.norm(v), 6).alias("norm"), F.round(largest, 6).alias("largest"), F.array_position(v, largest).alias("place"))


@query("""WITH w AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM benchmark) SELECT item_id, token, CAST(count(*) AS DOUBLE) AS weight FROM w GROUP BY ALL""")
def encode_sparse(spark, sf_dir):
    """The lexical output of an encoder with several outputs."""
    out = encoders.encode_parts(table(spark, sf_dir, "benchmark"), "text", "counted", ("sparse",))
    return out.select("item_id", F.explode("sparse").alias("token", "weight"))


@query(f"""WITH {_TRIAGE}, r AS (SELECT t.*, role FROM t JOIN f USING (doc_id)), s AS (SELECT *, repair_priority IN ('P0', 'P1') AS sent, doc_id % 7 = 0 AS lost FROM r)
SELECT count(*) AS failed_before, count(*) FILTER (WHERE repair_priority = 'RULE') AS rule_false_positive, count(*) FILTER (WHERE sent) AS sent_to_repair, count(*) FILTER (WHERE sent AND NOT lost) AS repair_accepted,
  count(*) FILTER (WHERE sent AND lost) AS repair_failed, count(*) FILTER (WHERE repair_priority = 'P2_DROP') + count(*) FILTER (WHERE sent AND lost AND role = 'negative') AS dropped FROM s""")
def repair_summary(spark, sf_dir):
    triaged = qa.triage(_failed(spark, sf_dir).withColumnRenamed("doc_id", "item_id"), PACK)
    repaired = payloads.by_priority(triaged)[0].withColumn("repair_status", F.when(F.col("item_id") % 7 == 0, "failed").otherwise("accepted"))
    return payloads.repair_summary(triaged, repaired)


@query("SELECT CAST(0 AS INT) AS version, count(*) AS n_rows, count(*) FILTER (WHERE text IS NULL) AS nulls, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents")
def gated_version(spark, sf_dir):
    """The documents as a version of a table, measured while they are written; gates hold back a version without rows or with
    more than a tenth of texts missing."""
    docs = table(spark, sf_dir, "documents")
    metrics = {"n_rows": F.count("*"), "nulls": F.count_if(F.col("text").isNull()), "chars": F.sum(F.length("text"))}
    done = versions.commit(docs, new_path(spark, "versions"), metrics=metrics, gates={"rows": "n_rows > 0", "texts": "nulls <= 0.1 * n_rows"})
    return spark.createDataFrame([(done.number, *(done.metrics[c] for c in metrics))], "version int, n_rows long, nulls long, chars long")
