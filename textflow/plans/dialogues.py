"""Catalogue queries over turns of conversations and events. A turn counts as token-bearing if its text is long, since the
tables have no redactions; its tokens are its words of 12 letters or more."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textflow.operators import payloads, qa, sessions
from textflow.plans.groups import table
from textflow.sources.shared import new_path

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


LONG = 500


def _turns(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("dialogue_id"), "turn", "role", "text")


def _clusters(spark, sf_dir) -> DataFrame:
    return sessions.clusters(_turns(spark, sf_dir), F.length("text") > LONG, gap=1)


def _tokens():
    return F.regexp_extract_all("text", F.lit("[a-z]{12,}"), F.lit(0))


_CLUSTERS = f"""t AS (SELECT conv_id AS dialogue_id, turn, role, text, regexp_extract_all(text, '[a-z]{{12,}}') AS tokens FROM conversations WHERE length(text) > {LONG}),
g AS (SELECT *, CASE WHEN turn - lag(turn) OVER w <= 1 THEN 0 ELSE 1 END AS new FROM t WINDOW w AS (PARTITION BY dialogue_id ORDER BY turn)),
c AS (SELECT * EXCLUDE new, CAST(sum(new) OVER (PARTITION BY dialogue_id ORDER BY turn) - 1 AS INT) AS cluster_idx FROM g)"""


@query(f"WITH {_CLUSTERS} SELECT dialogue_id, turn, cluster_idx, dialogue_id || '_c' || cluster_idx AS cluster_id FROM c")
def gap_clusters(spark, sf_dir):
    return _clusters(spark, sf_dir).select("dialogue_id", "turn", "cluster_idx", "cluster_id")


@query(f"""WITH {_CLUSTERS}, e AS (SELECT dialogue_id, cluster_idx, count(*) AS n, sum(len(tokens)) AS t FROM c GROUP BY ALL)
SELECT count(*) AS clusters, CAST(sum(n) AS BIGINT) AS turns, CAST(sum(t) AS BIGINT) AS tokens, min(n) AS least, max(n) AS largest, round(avg(n), 2) AS mean FROM e""")
def gap_cluster_stats(spark, sf_dir):
    return sessions.scan_report(_clusters(spark, sf_dir), _tokens())


@query(f"""WITH {_CLUSTERS}, n AS (SELECT dialogue_id, cluster_idx, role, count(*) AS n, min(turn) AS first FROM c GROUP BY ALL)
SELECT dialogue_id, cluster_idx, role AS topic FROM n QUALIFY row_number() OVER (PARTITION BY dialogue_id, cluster_idx ORDER BY n DESC, first) = 1""")
def cluster_topic_mode(spark, sf_dir):
    return sessions.topic(_clusters(spark, sf_dir), "role")


@query(f"""WITH {_CLUSTERS}, s AS (SELECT dialogue_id, cluster_idx, turn, unnest(range(len(tokens))) AS pos, unnest(tokens) AS token FROM c)
SELECT dialogue_id, cluster_idx, turn, pos, token, row_number() OVER (PARTITION BY dialogue_id, cluster_idx ORDER BY turn, pos) AS token_index FROM s""")
def slot_ordinals(spark, sf_dir):
    return sessions.slots(_clusters(spark, sf_dir), _tokens()).select("dialogue_id", "cluster_idx", "turn", F.col("pos").cast("long").alias("pos"), "token", "token_index")


@query(f"WITH {_CLUSTERS} SELECT dialogue_id, CAST(sum(len(tokens)) AS BIGINT) AS tokens FROM c GROUP BY 1 ORDER BY tokens DESC, dialogue_id LIMIT 20")
def heavy_topn(spark, sf_dir):
    return sessions.heaviest(_clusters(spark, sf_dir), _tokens())


@query(f"""WITH {_CLUSTERS} SELECT dialogue_id, cluster_idx, CASE max(CASE WHEN length(text) % 7 = 0 THEN 2 WHEN length(text) % 3 = 0 THEN 1 ELSE 0 END) WHEN 2 THEN 'failed' WHEN 1 THEN 'warning' ELSE 'accepted' END AS status FROM c GROUP BY 1, 2""")
def cluster_status_rollup(spark, sf_dir):
    n = F.length("text")
    rows = _clusters(spark, sf_dir).withColumn("status", F.when(n % 7 == 0, "failed").when(n % 3 == 0, "warning").otherwise("accepted"))
    return sessions.worst_status(rows, ["dialogue_id", "cluster_idx"])


@query(f"""WITH {_CLUSTERS}, b AS (SELECT dialogue_id, cluster_idx, min(turn) AS low, max(turn) AS high FROM c GROUP BY ALL)
SELECT b.dialogue_id, b.cluster_idx, v.turn, CASE WHEN v.turn < low THEN 'before' ELSE 'after' END AS side FROM b JOIN conversations v ON v.conv_id = b.dialogue_id AND (v.turn BETWEEN low - 3 AND low - 1 OR v.turn BETWEEN high + 1 AND high + 3)""")
def band_context(spark, sf_dir):
    return sessions.context(_turns(spark, sf_dir), _clusters(spark, sf_dir))


@query(f"""WITH {_CLUSTERS}, s AS (SELECT dialogue_id, cluster_idx, dialogue_id || '_c' || cluster_idx AS cluster_id, turn, unnest(range(len(tokens))) AS pos, unnest(tokens) AS token FROM c),
n AS (SELECT *, row_number() OVER (PARTITION BY dialogue_id, cluster_idx ORDER BY turn, pos) AS token_index FROM s)
SELECT cluster_id, token_index, 'random_digits' AS policy, list_extract(['1','2','3','4','5','6','7','8','9'], (seed % 9 + 1)::INT) || substr(translate(sha1(CAST(seed AS VARCHAR)), 'abcdef', '012345'), 1, 1) AS suggested_value
FROM (SELECT *, ('0x' || substr(sha1(cluster_id || '|' || turn || '|' || token_index || '|' || token || '|unknown'), 1, 8))::BIGINT AS seed FROM n WHERE length(regexp_replace(token, '[^xX]', '', 'g')) < 3)""")
def slot_suggestions(spark, sf_dir):
    slots = sessions.slots(_clusters(spark, sf_dir), _tokens())
    out = sessions.slot_hints(slots, F.lit("unknown"))
    return out.where(F.regexp_count("token", F.lit("(?i)x")) < 3).select("cluster_id", "token_index", "policy", "suggested_value")


@query(f"""WITH f AS (SELECT conv_id AS dialogue_id, turn, reverse(text) AS filled, CASE WHEN turn % 3 = 0 THEN 'failed' WHEN turn % 3 = 1 THEN 'warning' ELSE 'accepted' END AS s FROM conversations WHERE turn % 4 <> 3)
SELECT v.conv_id AS dialogue_id, v.turn, CASE WHEN len(regexp_extract_all(text, '[a-z]{{12,}}')) > 0 THEN coalesce(s, 'failed') END AS fill_status, CASE WHEN len(regexp_extract_all(text, '[a-z]{{12,}}')) > 0 AND s IN ('accepted', 'warning') THEN filled END AS filled
FROM conversations v LEFT JOIN f ON f.dialogue_id = v.conv_id AND f.turn = v.turn""")
def merge_back(spark, sf_dir):
    t = _turns(spark, sf_dir)
    status = F.when(F.col("turn") % 3 == 0, "failed").when(F.col("turn") % 3 == 1, "warning").otherwise("accepted")
    fills = t.where("turn % 4 <> 3").select("dialogue_id", "turn", F.reverse("text").alias("filled"), status.alias("status"))
    return sessions.merge_back(t, fills, _tokens()).select("dialogue_id", "turn", "fill_status", "filled")


@query("SELECT conv_id, turn, CAST((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 3 AS INT) AS batch FROM conversations")
def chunk_batches(spark, sf_dir):
    return sessions.chunked(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], 3).select("conv_id", "turn", "batch")


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 >= 3 AND role = 'user' AS skipped FROM conversations WHERE turn > 0")
def relation_sample_flags(spark, sf_dir):
    """Turns as candidates in their own order: user turns from the fourth candidate on are skipped."""
    c = table(spark, sf_dir, "conversations").where("turn > 0")
    w = Window.partitionBy("conv_id").orderBy("turn")
    items = c.select(F.col("conv_id").alias("group_idx"), "turn", F.when(F.col("role") == "user", "negative").otherwise("other").alias("role"), F.row_number().over(w).alias("idx"))
    return sessions.sampled_relations(items, 3).select(F.col("group_idx").alias("conv_id"), "turn", "skipped")


@query(r"""SELECT conv_id, turn, CASE WHEN trim(regexp_replace(text, '\s+', ' ', 'g')) = '' THEN 'empty_content' WHEN upper(trim(text)) IN ('IT.', 'THE.', 'DER.') THEN 'exact_skip'
  WHEN regexp_matches(trim(regexp_replace(text, '\s+', ' ', 'g')), '(?i)^(?:[a-z]+ [a-z]+\.)$') THEN 'pattern_skip:[a-z]+ [a-z]+\.' END AS reason FROM conversations""")
def skip_filter(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", sessions.skip_reason(F.col("text"), ["It.", "The.", "Der."], [r"[a-z]+ [a-z]+\."]).alias("reason"))


@query()
def fill_quality(spark, sf_dir):
    from textflow.operators.external import preservation

    rows = _turns(spark, sf_dir).select("dialogue_id", "turn", F.col("text").alias("original"), F.regexp_replace("text", "[a-z]{12,}", "12").alias("filled"), F.lit("unknown").alias("hint_type"))
    return qa.fill_qa(rows, preservation(F.col("original"), F.col("filled")), ["the", "und"]).select("dialogue_id", "turn", "status", F.array_join("errors", "|").alias("errors"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS events FROM s GROUP BY user_id, k""")
def events_session_batch(spark, sf_dir):
    from textflow.streaming.sessions import event_sessions

    return event_sessions(table(spark, sf_dir, "events")).select("user_id", F.unix_micros("start").alias("start_us"), "events")


@query("""WITH q AS (SELECT event_id AS item_id, ts, event_type FROM events WHERE event_id % 2 = 0), a AS (SELECT event_id - 1 AS item_id, ts, event_type FROM events WHERE event_id % 2 = 1)
SELECT q.item_id, q.event_type, a.event_type AS target, CASE WHEN a.item_id IS NULL THEN 'missing_answer' END AS error FROM q LEFT JOIN a ON a.item_id = q.item_id AND a.ts >= q.ts AND a.ts <= q.ts + INTERVAL 5 MINUTE""")
def answers_in_time(spark, sf_dir):
    """Every second event as a question, the event after it as its answer if it comes within five minutes."""
    from textflow.streaming.answers import answered

    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    asked = e.where("event_id % 2 = 0").select(F.col("event_id").alias("item_id"), F.col("ts").alias("asked_at"), "event_type")
    told = e.where("event_id % 2 = 1").select((F.col("event_id") - 1).alias("item_id"), F.col("ts").alias("answered_at"), F.col("event_type").alias("target"))
    return answered(asked, told, "5 minutes").select("item_id", "event_type", "target", "error")


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def events_last_by_user(spark, sf_dir):
    """The events as a stream, the last of each user kept as keyed state."""
    from textflow.streaming import cache

    one = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    stream = spark.readStream.schema(one.schema).parquet(f"{sf_dir}/events.parque[t]")  # a pattern may also name one file
    path = new_path(spark, "keyed")
    cache.follow(stream, f"{path}/out", f"{path}/progress", ["user_id"], "event_id").awaitTermination()
    return cache.current(spark, f"{path}/out", ["user_id"])


@query(f"""WITH {_CLUSTERS}, f AS (SELECT *, regexp_replace(text, '[a-z]{{12,}}', CASE turn % 3 WHEN 0 THEN ' XXXX ' ELSE '12' END, 'g') AS filled, CASE turn % 3 WHEN 0 THEN 'failed' WHEN 1 THEN 'warning' ELSE 'accepted' END AS status FROM c WHERE len(tokens) > 0)
SELECT (SELECT count(*) FROM conversations WHERE len(regexp_extract_all(text, '[a-z]{{12,}}')) > 0) AS turns_with_tokens, count(*) FILTER (WHERE status = 'accepted') AS accepted, count(*) FILTER (WHERE status = 'warning') AS warning, count(*) FILTER (WHERE status = 'failed') AS failed,
  count(*) FILTER (WHERE status <> 'failed') AS filled, count(*) FILTER (WHERE len(regexp_extract_all(filled, '(?i)\\b[A-Z0-9]*X{{2,}}[A-Z0-9]*\\b')) > 0) AS tokens_left, count(*) FILTER (WHERE turn % 5 = 0) AS personal_shapes FROM f""")
def fill_report(spark, sf_dir):
    k = F.col("turn") % 3
    fills = _clusters(spark, sf_dir).where(F.size(_tokens()) > 0).select(
        "turn", F.when(k == 0, F.regexp_replace("text", "[a-z]{12,}", " XXXX ")).otherwise(F.regexp_replace("text", "[a-z]{12,}", "12")).alias("filled"), F.when(k == 0, "failed").when(k == 1, "warning").otherwise("accepted").alias("status"),
        F.when(F.col("turn") % 5 == 0, F.array(F.lit("pii_shape_email_shape"))).otherwise(F.array().cast("array<string>")).alias("errors"),
    )
    return sessions.fill_report(_turns(spark, sf_dir), fills, _tokens())


@query(f"WITH {_CLUSTERS} SELECT dialogue_id, cluster_idx, count(*) AS turns, CAST(sum(len(tokens)) AS BIGINT) AS tokens FROM c GROUP BY 1, 2")
def cluster_tokens(spark, sf_dir):
    return sessions.cluster_tokens(_clusters(spark, sf_dir), _tokens())


@query(f"WITH {_CLUSTERS} SELECT CASE WHEN contains(text, '?') THEN 'question' ELSE role END AS hint, count(*) AS n FROM c GROUP BY 1")
def cluster_hint_histogram(spark, sf_dir):
    return sessions.hint_histogram(_clusters(spark, sf_dir), F.when(F.col("text").contains("?"), "question").otherwise(F.col("role")))


@query(r"""SELECT conv_id, turn FROM conversations WHERE trim(text) <> '' AND len(regexp_extract_all(regexp_replace(text, '[a-z]{12,}', ' XXXX ', 'g'), '(?i)\b[A-Z0-9]*X{2,}[A-Z0-9]*\b')) > 0""")
def fill_eligible(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumn("redacted", F.regexp_replace("text", "[a-z]{12,}", " XXXX "))
    return payloads.to_fill(c, "text", "redacted").select("conv_id", "turn")
