import os

import pytest

from quire.llm import queries as Q

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
def test_queries_match_their_sql(spark):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SMALL}/{f}'")
    sql, queries = Q.oracle_sql(), Q.queries()
    assert set(sql) <= set(queries)
    for name in sql:
        df = queries[name](spark, SMALL)
        cols = sorted(df.columns)
        r = con.sql(sql[name])
        assert sorted(r.columns) == cols, name
        at = [r.columns.index(c) for c in cols]
        got, want = sorted(repr(tuple(x)) for x in df.select(*cols).collect()), sorted(repr(tuple(x[i] for i in at)) for x in r.fetchall())
        assert got == want, name
