"""Answers to a stream of questions, as an outer join of two streams: what isn't answered in time is a row with its error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING = "missing_answer"


def answered(questions: DataFrame, answers: DataFrame, within: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """questions (item_id, asked_at, ...), answers (item_id, answered_at, target) -> the questions with target, answered_at and error,
    null if there is an answer no earlier than the question and no later than `within` after it, else missing_answer.

    Of several answers in time the earliest counts; in a stream the first that comes. Streams keep questions and answers as state
    until the watermark, `late` behind the times seen, rules out their counterparts; a question without an answer comes out
    then. A question without id or time has no answer; in a stream one that is later than the watermark is dropped."""
    told = answers.select(F.col("item_id").alias("__item"), "answered_at", "target").where("__item is not null")
    limit = F.col("asked_at") + F.expr(f"INTERVAL {within}")
    match = (F.col("item_id") == F.col("__item")) & (F.col("answered_at") >= F.col("asked_at")) & (F.col("answered_at") <= limit)
    names = questions.columns
    if questions.isStreaming:
        told = told.withWatermark("answered_at", late).dropDuplicatesWithinWatermark(["__item"])
        out = questions.withWatermark("asked_at", late).join(told, match, "left_outer")
    else:
        rows = questions.withColumn("__row", F.monotonically_increasing_id())
        inside = rows.select("__row", "item_id", "asked_at").join(told, match).groupBy("__row").agg(F.min(F.struct("answered_at", "target")).alias("a"))
        out = rows.join(inside, "__row", "left").select(*names, F.col("a.answered_at").alias("answered_at"), F.col("a.target").alias("target"))
    return out.select(*names, "target", "answered_at", F.when(F.col("answered_at").isNull(), MISSING).alias("error"))


def follow(questions: DataFrame, answers: DataFrame, path: str, checkpoint: str, within: str = "1 hour", late: str = "10 minutes"):
    """Starts a query that writes answered() of two streams; a micro-batch has a folder of its own, which a replay writes again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    told = answered(questions, answers, within, late)
    return told.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
