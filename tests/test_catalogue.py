"""Every query of the catalogue against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from textflow import catalogue

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def _rows(df):
    cols = sorted(df.columns)
    df = df[cols].astype(object).where(df[cols].notna(), None).map(lambda v: v.item() if hasattr(v, "item") else v)
    return cols, sorted(tuple(map(str, r)) for r in df.itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_equals_sql(spark, db, name):
    assert _rows(catalogue.QUERIES[name](spark, DIR).toPandas()) == _rows(db.sql(catalogue.ORACLE_SQL[name]).df())


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_gives_rows(spark, name):
    assert catalogue.QUERIES[name](spark, DIR).limit(1).count() == 1
