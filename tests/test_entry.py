import os

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_need_the_llm_part():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, names in os.walk(os.path.join(root, "quire")):
        if os.path.basename(folder) == "llm":
            continue
        for n in names:
            if n.endswith(".py"):
                assert "quire.llm" not in open(os.path.join(folder, n)).read(), n


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
def test_queries_match_their_sql(spark):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SMALL}/{f}'")
    from quire import queries as core

    sql = core.oracle_sql()
    for name, q in core.queries().items():
        if name not in sql:
            continue
        df = q(spark, SMALL)
        cols = sorted(df.columns)
        r = con.sql(sql[name])
        assert sorted(r.columns) == cols, name
        at = [r.columns.index(c) for c in cols]
        got, want = sorted(repr(tuple(x)) for x in df.select(*cols).collect()), sorted(repr(tuple(x[i] for i in at)) for x in r.fetchall())
        assert got == want, name
