"""Every registered query equals its DuckDB SQL (rows, names, types, values)."""

import duckdb
import pytest

import __spark_entry__ as E
from peerlens.plans.oracle import ORACLE_SQL
from peerlens.plans.registry import QUERIES
from check_oracle import SPARK_TO_DUCK, TABLES, _rows
from tests.conftest import SF_SMOKE


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMOKE)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    s_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in sdf.dtypes}
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert s_types == d_types
    assert _rows([tuple(r) for r in sdf.collect()], sdf.columns) == _rows(rel.fetchall(), rel.columns)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 226  # overlap rows at sf0.001
    assert "risk_score" in df.columns
