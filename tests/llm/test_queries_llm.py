"""Every registered text query at a small scale against its SQL."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from ledgerwatch.llm.oracle import ORACLE
from ledgerwatch.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name not in ORACLE:
        assert len(got) > 0
        return
    want = con.execute(ORACLE[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    got, want = (df[columns].sort_values(columns).reset_index(drop=True) for df in (got, want))
    pd.testing.assert_frame_equal(got, want, check_exact=True, check_dtype=False)
