"""Every query that has SQL gives the same rows as DuckDB; every other one runs and keeps its columns."""

import pytest

from terrasift import plans

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = plans.queries(), plans.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, compare, name):
    compare(QUERIES[name](spark, SMALL), SQL[name], SMALL)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, SMALL)
    px = spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
    least = {"whittaker_gaps": 32 * px, "rf_large": px, "pipeline": 1, "aoi_pixels": 3}.get(name, 1)
    assert df.count() >= least


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
