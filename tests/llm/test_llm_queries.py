"""The registered queries against their SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from haltwise.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS FROM '{path}'")
    found = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in found.description]
    want = sorted(map(str, found.fetchall()))
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in df.select(columns).collect()) == want
