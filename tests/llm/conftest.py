import pytest


@pytest.fixture(scope="session")
def tables(spark):
    """Reads a table of the smallest test data."""
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
