"""The bucket-split measured heat equals a plain per-host lag (brute force)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from heatwise.operators import telemetry as TM
from heatwise.sources import star


def brute(samples):
    w = Window.partitionBy("host").orderBy("ts_us", "event_id")
    s = samples.select("host", "event_id", "ts_us", "cpu", F.lag("ts_us").over(w).alias("p_ts"),
                       F.lag("cpu").over(w).alias("p_cpu")).filter(F.col("p_ts").isNotNull())
    return s.select("host", "event_id", "ts_us", ((F.col("ts_us") - F.col("p_ts")) / 1e6).alias("elapsed_s"),
                    ((F.col("p_cpu") + F.col("cpu")) / 2).alias("avg_cpu"))


@pytest.mark.parametrize("bucket_us", [3_600_000_000, TM.DAY_US, 7 * TM.DAY_US])
def test_split_lag_equals_plain_lag(spark, sf_dir, bucket_us):
    samples = TM.samples_from_events(star.read_table(spark, sf_dir, "events"))
    got = TM.measured_heat(samples, bucket_us).drop("heat")
    want = brute(samples)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_host(spark, sf_dir):
    """One host holding every sample still gives one output row per sample but the first."""
    ev = star.read_table(spark, sf_dir, "events").withColumn("user_id", F.lit(1).cast("bigint"))
    samples = TM.samples_from_events(ev)
    got = TM.measured_heat(samples, 3_600_000_000)
    assert got.count() == ev.count() - 1
    assert got.exceptAll(brute(samples).withColumn("heat", F.col("avg_cpu") * F.col("elapsed_s"))).count() == 0


@pytest.mark.parametrize("partitions", [1, 7, 64, None])
def test_ranges_equal_plain_lag(spark, sf_dir, partitions):
    samples = TM.samples_from_events(star.read_table(spark, sf_dir, "events"))
    got = TM.measured_heat(samples, partitions=partitions).drop("heat")
    want = brute(samples)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_one_host_and_day_is_spread_over_the_ranges(spark, sf_dir):
    """All samples are one host's of one day: no range holds much more than its share."""
    ev = star.read_table(spark, sf_dir, "events").select(
        F.lit(1).cast("bigint").alias("host"), "event_id", (F.col("event_id") * 86_000).alias("ts_us"), F.col("value").alias("cpu"))
    got = TM.measured_heat(ev, partitions=10)
    assert got.count() == ev.count() - 1
    assert got.exceptAll(brute(ev).withColumn("heat", F.col("avg_cpu") * F.col("elapsed_s"))).count() == 0
    ranges = ev.repartitionByRange(10, "host", "ts_us", "event_id").groupBy(F.spark_partition_id()).count()
    assert ranges.agg(F.max("count")).first()[0] < 3 * ev.count() / 10


def test_null_hosts_times_and_readings(spark):
    rows = [(None, 1, 10, 0.5), (None, 2, 20, 0.7), (1, 3, 5, None), (1, 4, 8, 0.1), (1, 5, None, 0.3), (1, 6, 9, 0.2), (2, 7, 1, 0.1)]
    s = spark.createDataFrame(rows, "host long, event_id long, ts_us long, cpu double")
    for partitions in (1, 4):
        got = TM.measured_heat(s, partitions=partitions).drop("heat")
        assert sorted(map(str, got.collect())) == sorted(map(str, brute(s).filter("ts_us IS NOT NULL").collect()))
    assert TM.measured_heat(s.limit(0)).count() == 0
