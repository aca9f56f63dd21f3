import pytest


@pytest.fixture(scope="package", autouse=True)
def few_partitions(spark):
    """These tests run many small jobs; fewer shuffle partitions make them quicker."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
