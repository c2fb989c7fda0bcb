"""Every registered query at the smallest scale, against its SQL."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points

DATA = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def tidy(df):
    columns = sorted(df.columns)
    df = df[columns].copy()
    for c in columns:
        if c in ("evaluation_date", "evaluated_at", "period"):
            df[c] = pd.to_datetime(df[c]).astype("datetime64[us]").astype(str)
        elif pd.api.types.is_numeric_dtype(df[c]) and not pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype("float64")
    return df.sort_values(columns).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name not in ORACLE:
        assert len(got) > 0
        return
    want = con.execute(ORACLE[name]).df()
    pd.testing.assert_frame_equal(tidy(got), tidy(want), check_exact=True, check_dtype=False)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 99


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
