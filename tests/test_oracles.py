"""Every query with SQL gives that SQL's rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from tidemark.queries import ORACLES, QUERIES


def rows(df):
    clean = lambda v: None if pd.isna(v) else round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted((tuple(clean(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, data, name):
    con = duckdb.connect()
    for file in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got, want = QUERIES[name](spark, data).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_flagship(spark, data):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
