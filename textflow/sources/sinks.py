"""Writers: logs are appended with a run and a sequence, caches are rewritten by version, gates raise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.operators import lookup, reshape
from textflow.sources.shared import hadoop_path


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def report(df: DataFrame, path: str) -> None:
    """A small table (a report of a few rows) as one file of JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str, run_id: str) -> None:
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)


def save_cache(df: DataFrame, path: str, version: int, for_people: bool = False) -> str:
    """A new version beside the old ones; readers take the largest. Sorted only if people compare versions."""
    to = f"{path}/version={version:08d}"
    (df.orderBy("source") if for_people else df).write.mode("overwrite").parquet(to)
    return to


def failures(df: DataFrame, path: str) -> None:
    """What failed; if nothing did, what an earlier run left there is removed."""
    if df.limit(1).count():
        df.write.mode("overwrite").json(path)
    else:
        system, place = hadoop_path(df.sparkSession, path)
        system.delete(place, True)


def rebuilt(log: DataFrame, path: str, seq: str = "seq") -> dict[str, DataFrame]:
    """All outputs made again from the log of items (group_idx, item_id, role, idx, target, status, hard_pass, semantic_pass,
    relation_preserved, retry_rounds, seq): the last row of each item counts. Writes strict, partial, debug and report under
    path and returns them."""
    items = lookup.last_wins(log, ["item_id"], seq)
    debug = reshape.group_summary(items)
    ready = debug.where("hard_pass and semantic_pass and relation_preserved and size(failed_items) = 0").select("group_idx")
    out = {"strict": reshape.renest(items, "target").join(ready, "group_idx", "left_semi"), "partial": reshape.renest_accepted(items, "target"), "debug": debug, "report": reshape.qa_report(debug)}
    for name, df in out.items():
        df.write.mode("overwrite").json(f"{path}/{name}")
    return out


def scores(df: DataFrame, path: str) -> None:
    """Score vectors in long form, partitioned by run."""
    df.write.mode("append").partitionBy("run").parquet(path)


def gate(df: DataFrame, condition: str, message: str) -> DataFrame:
    """df, or an error if a row meets the condition."""
    if df.where(condition).limit(1).count():
        raise ValueError(message)
    return df


def in_batches(stream: DataFrame, path: str, checkpoint: str):
    """A streaming sink with durable progress: a micro-batch has a folder of its own, which a replay writes again, so that
    each counts once. Readers find its number in the column batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
