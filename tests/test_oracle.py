"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import datetime
import decimal
from pathlib import Path

import duckdb
import pytest

from terrace.plans.catalog import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return round(v, 9)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    found = duck.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    expected = sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in found.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr) == expected


@pytest.mark.parametrize("name", ["prefix_enrich", "point_in_polygon", "radius_search", "name_match_quarantine"])
def test_plans_hold_no_nested_loop(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
