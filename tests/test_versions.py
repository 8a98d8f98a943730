"""Versions: whole or not there, one of two writers wins, gates on what was written."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from textflow.sources import versions


def test_versions_and_conflicts(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.newest(spark, path) is None and versions.read(spark, path) is None
    first = versions.commit(spark.range(3), path, base=None)
    assert first.number == 0 and versions.commit(spark.range(5), path, base=0).number == 1
    with pytest.raises(versions.Conflict):
        versions.commit(spark.range(9), path, base=0)
    assert versions.read(spark, path).count() == 5 and versions.read(spark, path, at=0).count() == 3 and versions.read(spark, path, at=7) is None
    assert len(os.listdir(f"{path}/data")) == 2  # what lost is gone


def test_one_of_many_writers_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.commit(spark.range(1), path)

    def write(n):
        try:
            return versions.commit(spark.range(n + 2).coalesce(1), path, base=0), n
        except versions.Conflict:
            return None

    with ThreadPoolExecutor(6) as threads:
        won = [x for x in threads.map(write, range(6)) if x]
    assert len(won) == 1 and won[0][0].number == 1
    assert versions.read(spark, path).count() == won[0][1] + 2 and len(os.listdir(f"{path}/data")) == 2
    assert not [f for f in os.listdir(f"{path}/_versions") if f.endswith(".tmp")]


def test_gates_take_one_pass_and_hide_what_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.range(100).mapInArrow(count, "id long").withColumn("text", F.when(F.col("id") % 10 != 0, "x"))
    metrics = {"rows": F.count("*"), "nulls": F.count_if(F.col("text").isNull())}
    done = versions.commit(df, path, metrics=metrics, gates={"some": "rows > 0", "few": "nulls <= 0.2 * rows"})
    assert done.metrics == {"rows": 100, "nulls": 10} and reads.value == 100
    with pytest.raises(versions.Refused) as e:
        versions.commit(df, path, metrics=metrics, gates={"some": "rows > 0", "none": "nulls = 0", "odd": "null"})
    assert e.value.failed == ["none", "odd"] and e.value.metrics["nulls"] == 10
    assert versions.newest(spark, path) == versions.newest(spark, path, at=0) and len(os.listdir(f"{path}/data")) == 1
    assert versions.newest(spark, path).metrics == {"rows": 100, "nulls": 10}


def test_half_written_data_and_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        versions.commit(spark.range(n + 1), path)
    os.makedirs(f"{path}/data/half")
    (tmp_path / "t" / "_versions" / "00000009.json.abc.tmp").write_text("{")
    assert versions.newest(spark, path).number == 3
    versions.prune(spark, path, keep=2)
    assert len(os.listdir(f"{path}/data")) == 2 and versions.read(spark, path).count() == 4 and versions.read(spark, path, at=1) is None
