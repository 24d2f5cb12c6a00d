"""Every registered query against its DuckDB SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from eddyline.plans.queries import QUERIES
from eddyline.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import digest

NAMES = sorted(QUERIES)  # the training-data queries are tested in tests/llm


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) and set(NAMES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "cnt"] and df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    exp = con.sql(E.oracle_sql()[name]).df()
    n1, c1, h1, _ = digest(got)
    n2, c2, h2, _ = digest(exp)
    assert (n1, c1) == (n2, c2)
    assert h1 == h2
