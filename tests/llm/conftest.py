import pytest


@pytest.fixture
def many_slices(spark):
    """Small shuffles stay in all their partitions, so that keys really are cut."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield spark
    spark.conf.set(name, before)
