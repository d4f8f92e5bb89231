"""Every registered query equals its DuckDB SQL (rows, columns, values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tripstats.plans import registry

from .conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()
NAMES = sorted(registry.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(x)) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_of_the_reference_has_sql():
    assert set(registry.queries()) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    want = sorted((tuple(_norm(r[i]) for i in order) for r in res.fetchall()), key=_key)
    assert cols == sorted(dcols)
    assert len(got) == len(want)
    assert got == want


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["l_suppkey", "exact_trip_count", "sampled_trip_count", "cms_estimated_count"]
    assert 0 < len(rows) <= 20
