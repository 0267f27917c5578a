"""Every SQL-expressible query against its DuckDB twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

SLUGS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("slug", SLUGS)
def test_query_matches_oracle(spark, con, slug):
    sp = E.queries()[slug](spark, SF_SMALL).toPandas()
    od = con.execute(E.oracle_sql()[slug]).df()
    assert digest(sp) == digest(od)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["id", "split", "y"]
