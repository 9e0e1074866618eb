"""Streams equal the batch query when files arrive in event-time order; late rows drop."""

import os
import time

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from heatwise.plans.catalog import r6
from heatwise.streaming import live as L
from tests._compare import assert_same


def _split_in_time_order(sf_dir, out, parts=4):
    t = pq.read_table(f"{sf_dir}/events.parquet")
    t = t.take(pc.sort_indices(t, [("ts", "ascending"), ("event_id", "ascending")]))
    n = t.num_rows
    for i in range(parts):
        pq.write_table(t.slice(i * n // parts, (i + 1) * n // parts - i * n // parts), f"{out}/events_{i}.parquet")
        time.sleep(0.05)
    return t


def _batch_events(spark, src):
    ev = spark.read.parquet(src)
    return ev.withColumn("ts", F.timestamp_micros(F.timestamp_diff(
        "MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))))


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    src = str(tmp_path / "src")
    os.makedirs(src)
    _split_in_time_order(sf_dir, src)
    got_roll = r6(L.stream_rollup(spark, src, files_per_trigger=1)).toPandas()
    got_win = r6(L.stream_heat_windows(spark, src, files_per_trigger=1)).toPandas()
    batch = _batch_events(spark, f"{sf_dir}/events.parquet")
    assert_same(got_roll, r6(L.rollup_of(batch)).toPandas())
    assert_same(got_win, r6(L.heat_windows_of(batch, watermark=None)).toPandas())


def test_late_row_is_dropped(spark, sf_dir, tmp_path):
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    os.makedirs(src)
    t = _split_in_time_order(sf_dir, src)
    q = L.start_heat_windows(L.event_stream(spark, src, files_per_trigger=1), sink, ckpt,
                             trigger={"availableNow": True})
    L.run_until_caught_up(q)
    before = L.latest_windows(spark, sink).toPandas()
    # one sample from the first day, arriving after the watermark passed it
    late = t.slice(0, 1)
    pq.write_table(late, f"{src}/events_late.parquet")
    q = L.start_heat_windows(L.event_stream(spark, src, files_per_trigger=1), sink, ckpt,
                             trigger={"availableNow": True})
    L.run_until_caught_up(q)
    after = L.latest_windows(spark, sink).toPandas()
    assert_same(after, before)


def test_a_table_of_part_files_streams(spark, sf_dir, scratch):
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(4).write.parquet(f"{scratch}/tables/events.parquet")
    got = {r.event_type: r.events for r in L.stream_rollup(spark, f"{scratch}/tables", "events.parquet").collect()}
    want = {r.event_type: r["count"] for r in spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()}
    assert got == want
