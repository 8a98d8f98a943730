"""JSON arrays in many splits: equal to reading them whole, broken ones are errors."""

import json
import random

import pytest
from pyspark.sql import functions as F

from textflow.sources import json_arrays, readers


def odd(r, depth=0):
    kind = r.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return r.choice([None, True, 3, -1.5e3, "", "}", "{", "\\", '"', "\\\"}", "[{", "é}日", "a\nb", "\\\\"]) 
    if kind < 4:
        return "".join(r.choice('{}[]",:\\ aé日\n') for _ in range(r.randrange(30)))
    if kind == 4:
        return [odd(r, depth + 1) for _ in range(r.randrange(4))]
    return {r.choice(["a", "}", '"', "b\\"]) + str(i): odd(r, depth + 1) for i in range(r.randrange(4))}


@pytest.mark.parametrize("size", [64, 300, 1 << 20])
def test_elements_by_ranges(spark, tmp_path, size):
    r = random.Random(size)
    docs = [[{"x": odd(r), "y": odd(r)} if r.random() < 0.95 else {} for _ in range(n)] for n in (60, 0, 1, 25)]
    for i, d in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(json.dumps(d, indent=[None, 1, 2, None][i], ensure_ascii=bool(i % 2)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)), spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = json_arrays.elements(spark, str(tmp_path))
        parts = spark.read.text(str(tmp_path), lineSep="}").rdd.getNumPartitions()
        got = {(x.file.rsplit("/", 1)[1], x.number): json.loads(x.text) for x in found.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes"), spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {(f"{i}.json", k): x for i, d in enumerate(docs) for k, x in enumerate(d)}
    assert parts > 20 or size > 64


def test_broken_documents(spark, tmp_path):
    for i, text in enumerate(['[{"a": 1}, {"a": ', '[{"a": "x}]', '{"a": 1}]', '[{"a": 1}, 5, {"a": 2}]', '[{"a": 1}] ]', '[{"a": 1}, "x", {"a": 2}]', '[[{"a": 1}]]', '[{"a": 1}] [{"a": 2}]']):
        path = tmp_path / f"{i}.json"
        path.write_text(text)
        with pytest.raises(Exception):  # noqa: B017
            readers.json_array(spark, str(path), "a int").collect()
    bad = tmp_path / "bad.json"
    bad.write_text('[{"a": 1}, {"a": oops}]')
    with pytest.raises(Exception):  # noqa: B017
        readers.json_array(spark, str(bad), "a int").collect()
    (tmp_path / "empty.json").write_text(" [ ] \n")
    assert readers.json_array(spark, str(tmp_path / "empty.json"), "a int").count() == 0


def test_positions_are_those_of_the_document(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text(json.dumps([{"a": i, "s": "}" * (i % 3), "l": [{"q": i}]} for i in range(500)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000"), spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = readers.json_array(spark, str(path), "a int, s string, l array<struct<q: int>>").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes"), spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = spark.read.text(str(path), wholetext=True).select(F.posexplode(F.from_json("value", "array<struct<a: int, s: string, l: array<struct<q: int>>>>")).alias("idx", "r")).select("idx", "r.*").collect()
    assert sorted(map(str, rows)) == sorted(map(str, whole)) and len(rows) == 500
