"""Every registered query against its SQL in DuckDB, at sf0.001 and sf0.01."""

import duckdb
import pytest

from vitrine.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations embeddings benchmark".split()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = catalog.queries()[name](spark, sf)
    sql = catalog.oracle_sql()[name]
    rel = con.execute(sql)
    names = [x[0] for x in rel.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in sorted(names)]
    want = sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=str)
    got = sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)
    assert got == want
