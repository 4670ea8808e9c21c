"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from parcela.plans import catalog
from parcela.sources.tables import TEST_TABLES

SF = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES            # the optional operators have tests of their own in tests/llm
ORACLE = catalog.ORACLE


# Spark simple type name -> DuckDB type name
TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
            "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4)
    return v


def _rows(records):
    return sorted((tuple(_norm(x) for x in r) for r in records), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    dcols = rel.columns
    assert sorted(cols) == sorted(dcols)
    dtypes = dict(zip(dcols, [str(t) for t in rel.types]))
    for f in df.schema.fields:
        assert TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString()) == dtypes[f.name], f.name
    idx = [dcols.index(c) for c in cols]
    want = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "discount_pct" in df.columns
