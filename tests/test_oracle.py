"""Every registered query against its DuckDB oracle on the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from townpull.catalog import ORACLE, QUERIES
from conftest import SF_SMALL
from scripts_compare import normalise



@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("customer", "nation", "region"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = normalise(got), normalise(want)
    assert len(a) == len(b)
    assert (a.values == b.values).all()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 121  # populated places at sf0.001
    assert "assigned_metro_id" in df.columns
