"""Every registered query of the engine against its SQL in DuckDB, on whole tables."""

import math
from pathlib import Path

import duckdb
import pytest

from graphloom.plans import mixed_queries
from graphloom.plans import catalog_queries as Q

DATA = "/root/testdata/sf0.001"


def rows(table):
    columns = sorted(table.schema.names)

    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else float(f"{v:.9g}")
        return v

    found = [tuple(map(plain, r)) for r in zip(*[table.column(c).to_pylist() for c in columns], strict=True)]
    return columns, sorted(found, key=lambda r: [(x is None, str(x)) for x in r])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_equals_sql(spark, duck, name):
    got, want = rows(Q.QUERIES[name](spark, DATA).toArrow()), rows(duck.sql(Q.ORACLE[name]).to_arrow_table())
    assert got == want


@pytest.mark.parametrize("name", sorted(Q.QUERIES.keys() - Q.ORACLE.keys()))
def test_runs(spark, name):
    assert Q.QUERIES[name](spark, DATA).count() > 0


def test_batch_queries_are_registered():
    assert mixed_queries.QUERIES is Q.QUERIES and {"m6_batch_decode", "c18_mixed_depths"} <= Q.ORACLE.keys()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()
