"""Values are rounded as SQL rounds doubles, also where the digit after the last is an exact five."""

import duckdb
import pytest
from pyspark.sql import functions as F

from textflow import catalogue
from textflow.functions import text as T
from textflow.operators import qa, sessions
from textflow.plans.rule_pack import PACK


def _shown(rows):
    return {k: repr(v) for k, v in rows}


def test_script_ratio_of_ties_and_no_text_equals_sql(spark, tmp_path):
    texts = ["a" * k + "." * (n - k) for k, n in ((41, 640), (323, 640), (333, 640), (1, 128), (99, 3200), (82, 1280))]
    rows = list(enumerate([*texts, None, "", " ", "é\U0001f468", "×\n"]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = _shown(db.sql(catalogue.ORACLE_SQL["script_ratio"]).fetchall())
    got = _shown(tuple(r) for r in catalogue.QUERIES["script_ratio"](spark, str(tmp_path)).collect())
    assert got == want and len(got) == len(rows)


@pytest.mark.parametrize("digits", [2, 4, 6, 9])
def test_rounded_equals_sql(spark, digits):
    odd = [2 * i + 1 for i in range(3000)]  # halves of the last digit, of both signs, and what lies beside them
    values = [x for i in odd for h in (i / (2 * 10**digits), -i / (2 * 10**digits), i * 7919 / 10**digits / 2) for x in (h, h * (1 + 2**-52), h / 3)]
    values += [0.0, 1.0, 1e15 + 0.5, 123456789.987654321, float("inf"), float("nan")]
    db = duckdb.connect()
    want = [r[0] for r in db.execute(f"SELECT round(unnest(?::DOUBLE[]), {digits})", [values]).fetchall()]
    df = spark.createDataFrame(list(enumerate(values)), "i long, x double")
    got = [r.r for r in df.select("i", T.rounded(F.col("x"), digits).alias("r")).orderBy("i").collect()]
    # a zero's sign doesn't count
    assert [repr(x + 0.0) for x in got] == [repr(x + 0.0) for x in want]
    assert spark.range(1).select(T.rounded(F.lit(None).cast("double"), digits).alias("r")).first().r is None


def test_reports_round_as_sql(spark):
    db = duckdb.connect()
    # 41 turns in 40 clusters
    turns = spark.createDataFrame([(f"d{i}", 0) for i in range(40)] + [("d0", 1)], "dialogue_id string, turn int")
    clustered = sessions.clusters(turns.withColumn("text", F.lit("XX")), F.lit(True))
    assert sessions.scan_report(clustered, T.redacted_tokens(F.col("text"))).first().mean == db.sql("SELECT round(41 / 40, 2)").fetchall()[0][0] == 1.02
    # 57 letters in 800 characters
    items = spark.createDataFrame([("source", "a" * 57 + "." * 743, [], [])], "source string, target string, entities array<string>, actions array<string>")
    assert qa.hard_qa(items, PACK).first().script_ratio == db.sql("SELECT round(57 / 800, 4)").fetchall()[0][0]
