"""Answers joined with questions: the stream after restarts and a replay gives the rows of the batch form."""

import shutil
from datetime import datetime, timedelta

from textflow.streaming import answers

Q, A = "item_id long, asked_at timestamp, source string", "item_id long, answered_at timestamp, target string"
START = datetime(2024, 1, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


def put(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_batch(spark):
    q = spark.createDataFrame([(1, at(0), "a"), (2, at(0), "b"), (3, at(0), "c"), (None, at(0), "d"), (4, None, "e"), (5, at(9), "f")], Q)
    a = spark.createDataFrame([(1, at(5), "first"), (1, at(6), "second"), (2, at(61), "late"), (3, None, "x"), (None, at(1), "y"), (4, at(1), "z"), (5, at(8), "before")], A)
    got = {r.source: (r.target, r.error) for r in answers.answered(q, a).collect()}
    assert got == {"a": ("first", None)} | dict.fromkeys("bcdef", (None, "missing_answer"))


def test_stream_equals_batch(spark, tmp_path):
    q, a, out, progress = (str(tmp_path / x) for x in ("q", "a", "out", "progress"))

    def run():
        stream = lambda path, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        answers.follow(stream(q, Q), stream(a, A), out, progress).awaitTermination()

    for k in range(4):
        put(spark, q, [(10 * k + i, at(30 * k + i), f"s{i}") for i in range(10)], Q)
        put(spark, a, [(10 * k + i, at(30 * k + i + (3 if i % 3 else 70)), f"t{i}") for i in range(10) if i % 4], A)
        run()  # another query each time, from the checkpoint
    last = max(int(x.name.partition("=")[2]) for x in (tmp_path / "out").iterdir() if x.name.startswith("batch="))
    shutil.rmtree(f"{out}/batch={last}")
    for name in (str(last), f".{last}.crc"):
        (tmp_path / "progress" / "commits" / name).unlink()  # the batch runs again
    for k in (5, 6):  # time goes on
        put(spark, q, [(1000 + k, at(1000 * k), "end")], Q), put(spark, a, [(2000 + k, at(1000 * k), "end")], A)
        run()
    got = sorted(str((r.item_id, r.source, r.target, r.error)) for r in spark.read.parquet(out).where("item_id < 1000").collect())
    want = answers.answered(spark.read.schema(Q).parquet(q), spark.read.schema(A).parquet(a)).where("item_id < 1000").collect()
    assert got == sorted(str((r.item_id, r.source, r.target, r.error)) for r in want)
    assert sum("missing" in x for x in got) not in (0, 40) and len(got) == 40
