import pytest


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Small tables need few tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
