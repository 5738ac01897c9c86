"""Every registered query against its DuckDB oracle on the smallest driver tables.

Compares row count, column names and an order-insensitive digest of the values
(floats to 6 significant digits).  Queries without an oracle must still run.
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as ENTRY
from strata.sources.tables import TEST_TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.6g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ENTRY.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = ENTRY.queries()[name](spark, SF)
    got_rows = [tuple(r) for r in df.collect()]
    oracle = ENTRY.oracle_sql().get(name)
    if oracle is None:
        return
    cur = duck.execute(oracle)
    cols = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got_rows) == len(want_rows)
    assert canon(df.columns, got_rows) == canon(cols, want_rows)


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0
    assert df.columns == ["entity_id", "entity_name", "entity_type", "geo_name",
                          "n_level_1", "n_level_2", "n_level_3"]


def test_every_query_of_the_library_has_an_oracle():
    from strata.plans.catalog import ORACLES, QUERIES
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(ENTRY.queries()) and set(ENTRY.oracle_sql()) <= set(ENTRY.queries())
