"""Sinks of the streams: interrupted batches, bounded folders, late rows, any order of arrival."""

import glob
import os
import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from heatwise.operators import clean as C
from heatwise.operators import rollup as U
from heatwise.operators import telemetry as TM
from heatwise.plans import catalog as K
from heatwise.plans.catalog import r6
from heatwise.streaming import live as L
from heatwise.streaming import versions as V
from tests._compare import assert_same


def events_table(sf_dir):
    t = pq.read_table(f"{sf_dir}/events.parquet")
    return t.take(pa.array(np.lexsort((t["event_id"].to_numpy(), t["ts"].to_numpy().astype("int64")))))


def write_files(table, cuts, folder, name="events"):
    os.makedirs(folder, exist_ok=True)
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        pq.write_table(table.slice(a, b - a), f"{folder}/{name}_{i:03d}.parquet")
        time.sleep(0.02)  # files are taken in the order of their times


def as_events(spark, table, folder):
    os.makedirs(folder)
    pq.write_table(table, f"{folder}/all.parquet")
    ev = spark.read.parquet(f"{folder}/all.parquet")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return ev.withColumn("ts", F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col("ts"))))


def run_windows(spark, src, sink, ckpt, **more):
    q = L.start_heat_windows(L.event_stream(spark, src, files_per_trigger=1), sink, ckpt,
                             trigger={"availableNow": True}, **more)
    L.run_until_caught_up(q)
    return q


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small streams: two state partitions instead of eight."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("broken", ["Versions.write", "Spans.write", "Spans.compact"])
def test_a_batch_that_breaks_off_loses_and_repeats_nothing(spark, sf_dir, tmp_path, monkeypatch, broken):
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    table = events_table(sf_dir)
    write_files(table, np.linspace(0, table.num_rows, 6, dtype=int), src)
    kind, method = broken.split(".")
    plain, calls = getattr(getattr(V, kind), method), []

    def breaks(self, *args):
        calls.append(args)
        if len(calls) in (2, 5):
            if kind == "Spans" and method == "write":  # its rows are there, the version is not
                plain(self, *args)
            raise RuntimeError("lost")
        return plain(self, *args)

    monkeypatch.setattr(getattr(V, kind), method, breaks)
    lost = 0
    for _ in range(4):
        try:
            run_windows(spark, src, sink, ckpt, keep=3)
            break
        except Exception as e:
            assert "lost" in str(e)
            lost += 1
    assert lost == 2
    got = L.latest_windows(spark, sink)
    assert got.groupBy("window_start", "event_type").count().filter("count > 1").isEmpty()
    assert_same(r6(got).toPandas(), r6(L.heat_windows_of(as_events(spark, table, str(tmp_path / "t")), watermark=None)).toPandas())


def test_folders_stay_few(spark, sf_dir, tmp_path):
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    table = events_table(sf_dir)
    write_files(table, np.linspace(0, table.num_rows, 15, dtype=int), src)
    run_windows(spark, src, sink, ckpt, window="6 hours", keep=3)
    assert len(glob.glob(f"{sink}/open/batch=*")) <= 3
    assert len(glob.glob(f"{sink}/closed/span=*")) <= 3 * 3
    _, closed = L._window_tables(spark, sink)
    rows = closed.read(1 << 40)
    assert rows.count() > 30 and rows.groupBy("window_start", "event_type").count().filter("count > 1").isEmpty()
    want = L.heat_windows_of(as_events(spark, table, str(tmp_path / "t")), "6 hours", None)
    assert_same(r6(L.latest_windows(spark, sink)).toPandas(), r6(want).toPandas())


def test_late_rows_are_counted_one_by_one(spark, sf_dir, tmp_path):
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    table = events_table(sf_dir)
    n = table.num_rows
    write_files(table, [0, n // 2, n], src)
    pq.write_table(table.slice(0, 37), f"{src}/zz_late.parquet".replace("zz", "events_zz"))
    q = run_windows(spark, src, sink, ckpt)
    assert L.late_rows(q) == 37
    want = L.heat_windows_of(as_events(spark, table, str(tmp_path / "t")), watermark=None)
    assert_same(r6(L.latest_windows(spark, sink)).toPandas(), r6(want).toPandas())


def heat_pairs(spark, table, folder, hours):
    samples = TM.samples_from_events(spark.read.parquet(folder).select("user_id", "event_id", "ts", "value"))
    top = int(pa.compute.max(table["ts"]).as_py().replace(tzinfo=__import__("datetime").timezone.utc).timestamp() * 1000)
    return TM.measured_heat(samples).filter(F.floor(F.col("ts_us") / 1000) < top - hours * 3_600_000)


def test_stream_heat_in_any_order_within_the_watermark(spark, sf_dir, tmp_path):
    import pyarrow.compute  # noqa: F401
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    table = events_table(sf_dir)
    times = table["ts"].to_numpy().astype("datetime64[us]").astype("int64")
    rnd = np.random.default_rng(1)
    shuffled = table.take(pa.array(np.argsort(times + rnd.integers(0, 47 * 3_600_000_000, len(times)))))
    write_files(shuffled, np.linspace(0, table.num_rows, 5, dtype=int), src)
    q = L.start_measured_heat(L.event_stream(spark, src, files_per_trigger=1), sink, ckpt, "48 hours",
                              trigger={"availableNow": True}, keep=2)
    L.run_until_caught_up(q)
    assert L.late_rows(q) == 0 and len(glob.glob(f"{sink}/span=*")) <= 8
    assert_same(r6(L.read_heat(spark, sink)).toPandas(), r6(heat_pairs(spark, table, src, 48)).toPandas())


def test_stream_heat_late_rows_and_restart(spark, sf_dir, tmp_path, monkeypatch):
    import pyarrow.compute  # noqa: F401
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    table = events_table(sf_dir)
    n = table.num_rows
    write_files(table, [0, n // 3, 2 * n // 3, n], src)
    plain, calls = V.Spans.write, []

    def breaks(self, rows, epoch):
        calls.append(epoch)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return plain(self, rows, epoch)

    monkeypatch.setattr(V.Spans, "write", breaks)
    for turn in range(2):
        q = L.start_measured_heat(L.event_stream(spark, src, files_per_trigger=1), sink, ckpt, trigger={"availableNow": True})
        try:
            L.run_until_caught_up(q)
        except Exception as e:
            assert turn == 0 and "lost" in str(e)
    want = r6(heat_pairs(spark, table, src, 1)).toPandas()
    assert_same(r6(L.read_heat(spark, sink)).toPandas(), want)
    pq.write_table(table.slice(5, 11), f"{src}/events_late.parquet")
    q = L.start_measured_heat(L.event_stream(spark, src, files_per_trigger=1), sink, ckpt, trigger={"availableNow": True})
    L.run_until_caught_up(q)
    assert L.late_rows(q) == 11
    assert_same(r6(L.read_heat(spark, sink)).toPandas(), want)


def test_a_still_host_is_forgotten(spark, tmp_path):
    day = 86_400_000_000
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    rows = [(1, 1, 0, 1.0), (2, 1, day, 2.0), (3, 2, 10 * day, 1.0), (4, 2, 11 * day, 1.0), (5, 1, 12 * day, 3.0), (6, 1, 13 * day, 5.0),
            (7, 2, 20 * day, 1.0)]
    table = pa.table({"event_id": [r[0] for r in rows], "user_id": [r[1] for r in rows],
                      "ts": pa.array([r[2] + 1000 * day for r in rows], pa.timestamp("us")), "value": [r[3] for r in rows]})
    write_files(table, range(len(rows) + 1), src)
    q = L.start_measured_heat(L.event_stream(spark, src, files_per_trigger=1), sink, ckpt, expiry="5 days", trigger={"availableNow": True})
    L.run_until_caught_up(q)
    got = sorted((r.event_id, r.elapsed_s, r.avg_cpu) for r in L.read_heat(spark, sink).collect())
    assert got == [(2, 86_400.0, 1.5), (4, 86_400.0, 1.0), (6, 86_400.0, 4.0)]  # sample 5 begins anew


@pytest.mark.parametrize("seed", [1])
def test_composite_rollup_of_any_order(spark, sf_dir, tmp_path, seed):
    raw = K.dirty(spark, sf_dir)
    folder = str(tmp_path / "trace")
    raw.orderBy(F.rand(seed)).repartition(7).write.parquet(folder)
    got = L.stream_composite_rollup(spark, folder, files_per_trigger=2)
    assert_same(r6(got).toPandas(), r6(U.composite_rollup(C.with_composite(C.parse_composite(raw)))).toPandas())


def test_spans_ignore_what_a_broken_merge_left(spark, tmp_path):
    path = str(tmp_path / "s")
    spans = V.Spans(spark, path, spark.range(0).schema, keep=2)
    for i in range(3):
        spans.write(spark.range(i, i + 1), i)
    spark.range(0, 2).write.parquet(f"{path}/span=0_1_1")  # merged, the parts not yet removed
    os.makedirs(f"{path}/span=2_3_1")  # begun, not complete
    assert sorted(r.id for r in spans.read(9).collect()) == [0, 1, 2]
    spans.write(spark.range(0), 3)
    spans.compact(3)
    assert sorted(os.listdir(path)) == ["span=0_1_1", "span=2_2_0", "span=2_3_1"]
    assert sorted(r.id for r in spans.read(1).collect()) == [0, 1]
