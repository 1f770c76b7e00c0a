import duckdb
import pytest

from parlance.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in "lineitem orders events documents labels conversations".split():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    order = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
    rel = con.sql(ORACLES[name])
    at = [rel.columns.index(c) for c in order]
    assert sorted(rel.columns) == order
    assert got == sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())
