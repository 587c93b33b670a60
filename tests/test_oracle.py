"""Every registered query against its DuckDB oracle on the sf0.001 tables,
plus the driver's smoke entry."""

import os

import pytest

import __spark_entry__ as E
from trafficlens.plans import registered
from tests.oracle_compare import compare, duck

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
# Spark type -> DuckDB type of the same column (schemas must agree too)
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
         "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
KEYS = sorted(registered.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["title", "dt", "views"]
    assert df.count() >= 0


def test_every_key_has_oracle():
    missing = set(KEYS) - set(E.oracle_sql())
    assert not missing, missing
    assert set(KEYS) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    verdict = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert verdict.startswith("ok"), verdict
    rel = con.sql(E.oracle_sql()[key])
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: TYPES.get(t) for c, t in df.dtypes} == duck_types
