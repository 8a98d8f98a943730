"""Catalogue queries without SQL read texts to their end."""

import difflib
import re

import numpy as np
import pytest

from textflow import catalogue
from textflow.functions.text import REDACTED
from textflow.operators import encoders

HEAD = "one beginning of several hundred characters for all of them " * 6
TEXTS = [HEAD.strip(), HEAD + "Zebra quartz 17", HEAD + "XXXX jumps" * 30, "short"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("whole")
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(str(path / "documents.parquet"))
    return str(path)


def test_preservation_ratio(spark, folder):
    def bare(x):
        return re.sub(r"\s+", " ", re.sub(REDACTED, "", x)).strip()

    want = {i: round(difflib.SequenceMatcher(None, bare(t), bare(t[::-1])).ratio(), 6) for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.ratio for r in catalogue.QUERIES["preservation_ratio"](spark, folder).collect()} == want


def test_bounded_repair_loop(spark, folder):
    got = catalogue.QUERIES["bounded_repair_loop"](spark, folder).collect()
    assert {(r.item_id, r.source, r.target) for r in got} == {(i, t, f"[t] {t}") for i, t in enumerate(TEXTS)}


def test_encode_distinct(spark, folder, monkeypatch):
    class Length:
        def encode(self, texts):
            return np.array([[float(len(t))] for t in texts])

    monkeypatch.setitem(encoders.REGISTRY, "hashed", Length)
    assert {r.doc_id: r.norm for r in catalogue.QUERIES["encode_distinct"](spark, folder).collect()} == {i: float(len(t)) for i, t in enumerate(TEXTS)}
