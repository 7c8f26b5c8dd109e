import math

import duckdb
import pytest

from clonelens.operators import diversity
from clonelens.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ["part", "events", "embeddings"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(rows):
    def cell(x):
        if isinstance(x, float):
            return None if math.isnan(x) else round(x, 6) + 0.0
        return x

    return sorted((tuple(map(cell, r)) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = plain(map(tuple, df.select(*want.columns).collect()))
    assert got == plain(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_combined_distance_pairs_the_whole_view(spark, tmp_path):
    """600 reads: pairs of late reads are there."""
    spark.read.parquet("/root/testdata/sf0.01/part.parquet").where("p_partkey < 600").write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    con.sql(f"create view part as select * from '{tmp_path}/part.parquet/*.parquet'")
    want = con.sql(registry.oracle_sql()["combined_distance"]).fetchall()
    got = registry.queries()["combined_distance"](spark, str(tmp_path)).select("a", "b", "dist").collect()
    assert max(r[0] for r in want) >= 300
    assert plain(map(tuple, got)) == plain(want)


def test_uniformity_of_every_cluster(spark):
    got = registry.queries()["uniformity_by_size"](spark, SF).collect()
    assert any(r.uniformity > 0 for r in got if r.cluster_id % 5 == 0)


def test_uniformity_of_a_cluster_without_one(spark):
    sizes, some = spark.createDataFrame([(1, 4), (2, 7)], "cluster_id long, n long"), spark.createDataFrame([(2, 0.5)], "cluster_id long, uniformity double")
    assert sorted(map(tuple, diversity.uniformity_by_size(sizes, some).collect())) == [(1, 4, 0.0), (2, 7, 0.5)]
