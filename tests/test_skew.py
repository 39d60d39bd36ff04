"""Hot keys: the joins must be split at run time, with the same result."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from opticlake.operators import enrich as J
from opticlake.operators import filters as P
from opticlake.operators import timeseries as W
from opticlake.operators.joins import join_per_key
from opticlake.session import spread

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def eager_splitting(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SETTINGS:
        spark.conf.unset(key)


@pytest.fixture
def hot(spark):
    """200,000 rows, a third of them of one interface."""
    rows = spark.range(0, 200_000, 1, 8)
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5_000)
    return rows.select(
        F.concat(F.lit("dev-"), (key % 50).cast("string")).alias("device"),
        F.concat(F.lit("et-0/0/"), key.cast("string")).alias("if_name"), F.col("id").alias("ts"),
        F.rand(1).alias("value"), F.uuid().alias("pad"))


def is_split(df):
    df.foreach(lambda _: None)
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def ports(hot):
    return hot.groupBy("device", "if_name").agg(
        *[F.max("pad").alias(c) for c in ("vendor", "part_number", "serial_number", "cable_type", "media_type",
                                          "wavelength", "fiber_type", "firmware_version")])


def test_enrichment_is_split(eager_splitting, hot):
    out = J.enrich_transceiver(hot, ports(hot))
    assert is_split(out)
    assert out.count() == hot.count() and out.where("vendor is null").isEmpty()


def test_scores_are_split(eager_splitting, hot):
    assert is_split(W.anomaly_score(hot, ["value"]))


def test_failed_devices_are_split(eager_splitting, hot):
    named = hot.withColumn("if_name", F.when(F.col("ts") != 1, F.col("if_name")))
    kept, failed = P.fail_device_on_missing_name({"interfaces": named, "lanes": hot})
    assert is_split(kept["lanes"])
    bad = [r["device"] for r in failed.collect()]
    assert kept["lanes"].where(F.col("device").isin(bad)).isEmpty()


def test_plain_join_to_an_aggregate_would_not_be_split(eager_splitting, hot):
    centre = hot.groupBy("device", "if_name").agg(F.avg("value").alias("mean"))
    assert not is_split(hot.join(centre, ["device", "if_name"]))
    assert is_split(join_per_key(hot, centre, ["device", "if_name"], "inner"))


def test_rows_in_one_of_many_partitions_are_spread(spark):
    # As a file of one row group that is cut into many splits: only one of them has rows.
    lumped = spark.range(0, 8000, 1, 1).unionByName(spark.range(0, 8, 1, 16).where(F.col("id") < 0))
    counts = spread(lumped).groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count"), F.sum("count")).first()
    assert counts[0] >= 8 and counts[1] <= 2000 and counts[2] == 8000


def test_even_partitions_stay(spark):
    even = spark.range(0, 8000, 1, 8)
    assert spread(even) is even and spread(even.where("id < 0")).count() == 0
