"""Queries of this subpackage against their SQL on a whole small table."""

import duckdb
import pytest

from skyledger.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    found = con.execute(queries.ORACLES[name])
    names = sorted(d[0] for d in found.description)
    want = [dict(zip([d[0] for d in found.description], r, strict=True)) for r in found.fetchall()]
    df = queries.QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == names
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=str)
    assert got == sorted((tuple(r[n] for n in names) for r in want), key=str)
