"""The contract queries: all registered, and equal to their SQL where there is one."""

from pathlib import Path

import duckdb
import pytest

from graphloom.llm import queries as Q

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got, want = Q.QUERIES[name](spark, DATA).toArrow(), con.sql(Q.ORACLE[name]).to_arrow_table()
    cols = sorted(got.schema.names)

    def rows(t):
        return sorted(map(str, zip(*[t.column(c).to_pylist() for c in cols], strict=True)))

    assert cols == sorted(want.schema.names) and rows(got) == rows(want)


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))
