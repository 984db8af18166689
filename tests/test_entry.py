"""Driver contract and a differential check against the SQL oracle."""

from __future__ import annotations

import math
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
HAVE_DATA = os.path.isdir(SF)


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


@pytest.mark.skipif(not HAVE_DATA, reason="driver tables not present")
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns


def _norm(v):
    import datetime
    import pandas as pd

    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, pd.Timestamp):
        return v.date().isoformat() if v == v.normalize() else v.isoformat()
    if isinstance(v, datetime.datetime):
        return _norm(pd.Timestamp(v))
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted("|".join(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")), cols


@pytest.mark.skipif(not HAVE_DATA, reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, name):
    import duckdb

    from stratum.sources.tables import DRIVER_TABLES

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, gcols = _rows(E.queries()[name](spark, SF).toPandas())
    want, wcols = _rows(con.execute(E.oracle_sql()[name]).fetchdf())
    assert gcols == wcols
    assert got == want
