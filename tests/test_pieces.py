"""Python functions over large batches hold a piece of them at a time."""

import tracemalloc

import pyarrow as pa
import pytest

from textflow.operators import dictionary, external, restore


def _peak(matcher, n: int) -> int:
    column = pa.array(["the MIT License" + " more words" * 300] * n)
    tracemalloc.start()
    rows = sum(len(x) for x in matcher.pieces(column))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == n
    return peak


@pytest.mark.parametrize("make", [lambda: dictionary.Mask(["MIT License"]), lambda: dictionary.Unmask(["MIT"]), lambda: dictionary.Groups({"g": ["MIT"]})])
def test_memory_does_not_grow_with_the_batch(make):
    assert _peak(make(), 6000) < 1.3 * _peak(make(), 2500)


def test_pieces_are_the_whole_column():
    texts = [f"GNU {i} " + "x" * (i % 3000) + (" MIT" if i % 7 else "") for i in range(6000)] + [None, ""]
    mask = dictionary.Mask(["GNU", "MIT"])
    parts = list(mask.pieces(pa.array(texts)))
    assert len(parts) > 1 and pa.concat_arrays(parts).equals(mask(pa.array(texts)))
    assert mask(pa.array([], pa.string())).to_pylist() == []


def test_placeholders_are_restored_in_pieces(spark):
    n = 3 * restore.ROWS + 1
    df = spark.range(0, n, 1, 1).selectExpr("id", "if(id % 5 = 0, null, concat('pay by Visa ', id)) source", "if(id % 3 = 0, null, concat('a <ENT_00> ', id)) target")
    out = restore.restore_placeholders(df, "source", "target", ["Visa"], notes="notes")
    assert ", 251" in out._jdf.queryExecution().executedPlan().toString()  # a function of an iterator
    assert {r.id: r.restored for r in out.collect()} == {i: None if i % 3 == 0 else f"a Visa {i}" for i in range(n)}


def test_calls_take_one_python_process(spark):
    df = spark.range(0, 205, 1, 1).selectExpr("cast(id as string) source")
    out = external.call(df, external.Stub(raises=5), ["source"], external.Limits(attempts=1, batch=7))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    rows = out.collect()
    assert [r.source for r in rows] == [str(i) for i in range(205)]
    assert all(r.target == "" and r.call_error == "ValueError: refused" if r.call_error else r.target == f"[t] {r.source}" for r in rows) and any(r.call_error for r in rows)
