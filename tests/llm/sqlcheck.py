"""A registered query beside its registered SQL."""

import math

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]


def cells(rows):
    return sorted((tuple(None if isinstance(x, float) and math.isnan(x) else round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=str)


def equals_sql(spark, name, sf=SF):
    from clonelens.llm import queries

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    rows = cells(map(tuple, got.select(*want.columns).collect()))
    assert rows and rows == cells(want.fetchall())
