import os

import duckdb
import pytest

from mktpanel.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in os.listdir(sf):
        con.execute(f"create view {t.split('.')[0]} as select * from read_parquet('{sf}/{t}')")
    df = QUERIES[name](spark, sf)
    res = con.execute(ORACLE[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(res.fetchall())


def test_every_operator_has_a_query():
    assert [q for n in range(1, 14) for q in QUERIES if q.startswith(f"op{n}_")] == sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0]))
