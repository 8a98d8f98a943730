"""Catalogue queries of retrieval evaluation over the embeddings table: a label's smallest vec_id is a query, vectors of the
same label are its positives, all others are candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.functions import vectors as V
from textflow.functions.text import rounded
from textflow.operators import dense, reports, retrieval, sparse
from textflow.plans.groups import table
from textflow.sources.shared import cut

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cand_id"), "label", F.col("embedding").cast("array<double>").alias("v"))


def _queries(v: DataFrame) -> DataFrame:
    return v.groupBy("label").agg(F.min_by(F.struct("cand_id", "v"), "cand_id").alias("q")).select(F.col("q.cand_id").alias("query_id"), F.col("label").alias("query_label"), F.col("q.v").alias("qv"))


#: Runs that the comparisons use: cosine over all dimensions, over the first half, and plain dot product.
RUNS = ("full", "half", "plain")


def _scores(spark, sf_dir, run: str = "full") -> DataFrame:
    v = _vectors(spark, sf_dir)
    q = _queries(v)
    if run == "half":
        v, q = v.withColumn("v", F.slice("v", 1, 32)), q.withColumn("qv", F.slice("qv", 1, 32))
    if run != "plain":
        v, q = v.withColumn("v", V.normalized(F.col("v"))), q.withColumn("qv", V.normalized(F.col("qv")))
    return retrieval.score_all(q, v, V.dot(F.col("v"), F.col("qv"))).select("query_id", "cand_id", rounded(F.col("score"), 9).alias("score"), (F.col("label") == F.col("query_label")).alias("positive"))


def _sides(spark, sf_dir, run: str = "full") -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """Queries, candidates and positives of a run for dense search, and whether vectors are scaled."""
    v = _vectors(spark, sf_dir)
    q = _queries(v)
    positives = v.join(q, v.label == q.query_label).where("query_id <> cand_id").select("query_id", "cand_id")
    part = (lambda c: F.slice(c, 1, 32)) if run == "half" else F.col
    return q.select("query_id", part("qv").alias("v")), v.select("cand_id", part("v").alias("v")), positives, run != "plain"


def _evaluated(spark, sf_dir, run: str = "full") -> DataFrame:
    q, v, positives, normalized = _sides(spark, sf_dir, run)
    return dense.evaluate(q, v, positives, normalized=normalized, digits=9)


def _top(spark, sf_dir, k: int, run: str = "full") -> DataFrame:
    q, v, _, normalized = _sides(spark, sf_dir, run)
    return dense.search(q, v, k, normalized=normalized, digits=9)


def _sql_scores(run: str = "full", name: str = "scores") -> str:
    cut = "CAST(embedding AS DOUBLE[])" + ("[1:32]" if run == "half" else "")
    unit = "list_transform(v, lambda x: x / greatest(sqrt(list_sum(list_transform(v, lambda y: y * y))), 1e-12))" if run != "plain" else "v"
    return f"""{name}_v AS (SELECT vec_id, label, {cut} AS v FROM embeddings), {name}_u AS (SELECT vec_id, label, {unit} AS v FROM {name}_v),
{name}_q AS (SELECT label, min(vec_id) AS query_id FROM embeddings GROUP BY label),
{name} AS (SELECT q.query_id, c.vec_id AS cand_id, round(list_dot_product(c.v, a.v), 9) AS score, c.label = q.label AS positive
  FROM {name}_q q JOIN {name}_u a ON a.vec_id = q.query_id JOIN {name}_u c ON c.vec_id <> q.query_id)"""


_RANKED = "ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, cand_id) AS rank FROM scores)"


def _recall_sql(scores: str = "ranked") -> str:
    return f"""SELECT query_id, count(*) FILTER (WHERE positive) AS n_positive, {", ".join(f"count(*) FILTER (WHERE positive AND rank <= {k}) / count(*) FILTER (WHERE positive) AS recall_{k}" for k in (1, 3, 5))},
{", ".join(f"count(*) FILTER (WHERE positive AND rank <= {k}) > 0 AS hit_{k}" for k in (1, 3, 5))}, min(rank) FILTER (WHERE positive) AS best_rank FROM {scores} GROUP BY query_id HAVING count(*) FILTER (WHERE positive) > 0"""


@query(f"WITH {_sql_scores()}, {_RANKED} {_recall_sql()}")
def retrieval_dense_recall(spark, sf_dir):
    return _evaluated(spark, sf_dir)


@query(f"WITH {_sql_scores()}, {_RANKED} SELECT query_id, rank, cand_id, round(score, 6) AS score FROM ranked WHERE rank <= 10")
def retrieval_dense_topk(spark, sf_dir):
    return _top(spark, sf_dir, 10).select("query_id", "rank", "cand_id", rounded(F.col("score"), 6).alias("score"))


@query(f"""WITH {_sql_scores()}, {_RANKED}, firsts AS (SELECT query_id, min(cand_id) AS cand_id FROM scores WHERE positive GROUP BY query_id)
SELECT query_id, rank AS pos_rank FROM ranked JOIN firsts USING (query_id, cand_id)""")
def retrieval_first_rank(spark, sf_dir):
    q, v, positives, _ = _sides(spark, sf_dir)
    firsts = positives.groupBy("query_id").agg(F.min("cand_id").alias("cand_id"))
    return dense.ranks_of(q, v, firsts, digits=9).withColumnRenamed("rank", "pos_rank")


@query(f"""WITH {_sql_scores()}, m AS (SELECT query_id, label AS cand_id, round(avg(score), 6) AS score FROM scores JOIN embeddings ON vec_id = cand_id GROUP BY 1, 2)
SELECT query_id, cand_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, cand_id) AS rank FROM m""")
def retrieval_cluster_avg(spark, sf_dir):
    variants = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cand_id"), F.col("label").alias("cluster"))
    means = retrieval.cluster_mean(_scores(spark, sf_dir), variants).withColumn("score", rounded(F.col("score"), 6))
    return retrieval.top_k(means, 1 << 30).select("query_id", "cand_id", "score", "rank")


@query("""WITH v AS (SELECT vec_id, label, list_transform(range(8), lambda i: CAST(embedding AS DOUBLE[])[8 * i + 1 : 8 * i + 8]) AS m FROM embeddings),
q AS (SELECT label, min(vec_id) AS query_id FROM embeddings GROUP BY label),
s AS (SELECT q.query_id, c.vec_id AS cand_id, round(list_sum(list_transform(a.m, lambda x: list_max(list_transform(c.m, lambda y: list_dot_product(x, y))))) / 8, 9) AS score
  FROM q JOIN v a ON a.vec_id = q.query_id JOIN v c ON c.vec_id <> q.query_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, cand_id) AS rank FROM s)
SELECT query_id, cand_id, rank, round(score, 6) AS score FROM r WHERE rank <= 10""")
def retrieval_multivector(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    q = _queries(v).withColumn("qm", V.split(F.col("qv"), 8, 8)).drop("qv")
    scores = retrieval.score_all(q, v.withColumn("m", V.split(F.col("v"), 8, 8)), rounded(V.multi(F.col("qm"), F.col("m")), 9)).select("query_id", "cand_id", "score")
    return retrieval.top_k(scores, 10).select("query_id", "cand_id", "rank", rounded(F.col("score"), 6).alias("score"))


_SPARSE = """bt AS (SELECT item_id AS query_id, w AS token, count(*)::DOUBLE AS wq FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM benchmark) GROUP BY ALL),
dt AS (SELECT doc_id AS cand_id, w AS token, count(*)::DOUBLE AS wd FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents) GROUP BY ALL),
sp AS (SELECT query_id, cand_id, sum(wq * wd) AS score FROM bt JOIN dt USING (token) GROUP BY ALL)"""


@query(f"""WITH {_SPARSE}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, cand_id) AS rank FROM sp) SELECT query_id, cand_id, score, rank FROM r WHERE rank <= 5""")
def retrieval_sparse(spark, sf_dir):
    q = retrieval.term_weights(table(spark, sf_dir, "benchmark"), "item_id", "text").withColumnRenamed("item_id", "query_id")
    d = retrieval.term_lists(table(spark, sf_dir, "documents"), "doc_id", "text", only=q).withColumnRenamed("doc_id", "cand_id")
    return sparse.search(q, cut(sparse.index(d), "index"), 5).select("query_id", "cand_id", "score", "rank")


@query(f"""WITH {_sql_scores("full", "a")}, {_sql_scores("half", "b")}, {_sql_scores("plain", "c")},
w(weights, x, y, z) AS (VALUES ('0.4/0.2/0.4', 0.4::DOUBLE, 0.2::DOUBLE, 0.4::DOUBLE), ('1.0/0.3/0.0', 1.0, 0.3, 0.0)),
h AS (SELECT weights, a.query_id, a.cand_id, round(x * a.score + y * b.score + z * c.score, 6) AS score FROM w, a JOIN b USING (query_id, cand_id) JOIN c USING (query_id, cand_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY weights, query_id ORDER BY score DESC, cand_id) AS rank FROM h)
SELECT weights, query_id, cand_id, score, rank FROM r WHERE rank <= 5""")
def retrieval_hybrid_weights(spark, sf_dir):
    parts = {run: _scores(spark, sf_dir, run) for run in RUNS}
    out = None
    for weights in ((0.4, 0.2, 0.4), (1.0, 0.3, 0.0)):
        mixed = retrieval.hybrid(parts, dict(zip(RUNS, weights, strict=True))).withColumn("score", rounded(F.col("score"), 6))
        top = retrieval.top_k(mixed, 5).withColumn("weights", F.lit("/".join(map(str, weights))))
        out = top if out is None else out.unionByName(top)
    return out.select("weights", "query_id", "cand_id", "score", "rank")


def _all_runs(spark, sf_dir, of) -> DataFrame:
    """The rows of each run, with its name."""
    out = None
    for run in RUNS:
        one = of(run).withColumn("run", F.lit(run))
        out = one if out is None else out.unionByName(one)
    return out


_ALL = ", ".join(_sql_scores(run, f"s_{run}") for run in RUNS) + ", scores AS (" + " UNION ALL ".join(f"SELECT '{run}' AS run, * FROM s_{run}" for run in RUNS) + """),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run, query_id ORDER BY score DESC, cand_id) AS rank FROM scores)"""


@query(f"""WITH {_ALL}, t AS (SELECT run, query_id, list(cand_id ORDER BY rank) AS top FROM ranked WHERE rank <= 10 GROUP BY ALL)
SELECT a.run AS run_a, b.run AS run_b, count(*) AS queries, count(*) FILTER (WHERE a.top = b.top) AS same_topk, count(*) FILTER (WHERE a.top[1] = b.top[1]) AS same_top1,
  round(count(*) FILTER (WHERE a.top = b.top) / count(*), 4) AS topk_ratio, round(count(*) FILTER (WHERE a.top[1] = b.top[1]) / count(*), 4) AS top1_ratio
FROM t a JOIN t b USING (query_id) WHERE a.run < b.run GROUP BY a.run, b.run""")
def topk_agreement(spark, sf_dir):
    return retrieval.agreement(_all_runs(spark, sf_dir, lambda run: _top(spark, sf_dir, 10, run)))


def _per_query(spark, sf_dir) -> DataFrame:
    return _all_runs(spark, sf_dir, lambda run: _evaluated(spark, sf_dir, run))


_PER_QUERY = f"{_ALL}, per_query AS ({_recall_sql().replace('SELECT query_id', 'SELECT run, query_id').replace('GROUP BY query_id', 'GROUP BY run, query_id')})"


@query(f"WITH {_PER_QUERY} SELECT run, round(avg(recall_1), 9) AS recall_1, round(avg(recall_3), 9) AS recall_3, round(avg(recall_5), 9) AS recall_5, count(*) AS queries FROM per_query GROUP BY run")
def leaderboard(spark, sf_dir):
    board = reports.leaderboard(reports.summary(_per_query(spark, sf_dir), ["run"]), ["run"])
    return board.select("run", *(rounded(F.col(f"recall_{k}"), 9).alias(f"recall_{k}") for k in (1, 3, 5)), "queries")


@query(f"""WITH {_PER_QUERY} SELECT o.query_id, o.run, CASE WHEN o.hit_1 THEN 'gain' ELSE 'regression' END AS change
FROM per_query o JOIN per_query r ON r.run = 'full' AND r.query_id = o.query_id WHERE o.run <> 'full' AND o.hit_1 <> r.hit_1""")
def badcase_vs_reference(spark, sf_dir):
    return reports.against_reference(_per_query(spark, sf_dir), "run", "full")


@query(f"""WITH {_PER_QUERY} SELECT query_id, count(*) FILTER (WHERE hit_1) AS hits, count(*) FILTER (WHERE NOT hit_1) AS misses, count(*) FILTER (WHERE NOT hit_1) = (SELECT count(DISTINCT run) FROM per_query) AS universal_miss
FROM per_query GROUP BY query_id""")
def universal_miss(spark, sf_dir):
    return reports.universal_misses(_per_query(spark, sf_dir), "run")


@query("""WITH r AS (SELECT label AS alias, vec_id % 2 AS mode, vec_id AS ordinal, embedding[1]::DOUBLE AS value FROM embeddings)
SELECT alias, mode, max(ordinal) AS ordinal, round(arg_max(value, ordinal), 6) AS value FROM r GROUP BY ALL""")
def report_merge(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").alias("alias"), (F.col("vec_id") % 2).alias("mode"), F.col("vec_id").alias("ordinal"), F.col("embedding")[0].cast("double").alias("value"))
    return reports.merge(rows).withColumn("value", rounded(F.col("value"), 6))
