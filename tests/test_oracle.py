"""Every value-checked query against its DuckDB twin on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from strider.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = ["supplier", "events"]


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else ("num", repr(v))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", repr(float(v)))
    return ("str", str(v))


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    rel = duck.sql(entry.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())
