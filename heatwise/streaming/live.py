"""Structured Streaming jobs over telemetry samples and traces (L1, L2, H7).

* L1 ``live_rollup``: samples and mean load per event type, kept current (complete mode;
  the state is one row per event type).  ``composite_rollup`` keeps the five-way rollup of
  a task trace current: each batch of new part files adds its sums and counts to those of
  the last version, so any order of arrival gives the same rollup.
* L2 ``heat_windows``: per tumbling window and event type the samples, mean CPU, seconds
  covered (last - first sample) and heat = mean CPU × seconds, with a watermark so that
  state of closed windows is dropped.  Update mode emits a window again whenever it
  changes; the sink has two sides: windows the watermark has passed are written once,
  open ones are a small table that each batch replaces.
* H7 ``measured_heat``: heat between consecutive samples of a host.  A host's state is its
  last sample and those the watermark has not reached; event-time timers let samples out
  in order, whatever order they came in, and forget a host that has been still too long.

All write through ``foreachBatch`` into numbered folders (``versions``) and keep their
streaming checkpoints below the shared folder, so a restarted query resumes where it
stopped, also from the middle of a batch.
"""

from __future__ import annotations

import threading
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import _parse_datatype_string as parse_schema

from heatwise.operators import clean as C
from heatwise.operators import rollup as U
from heatwise.session import scratch_path
from heatwise.streaming.versions import Spans, Versions


def _epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _is_folder(spark: SparkSession, path: str) -> bool:
    if "*" in path:
        return False
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def event_stream(spark: SparkSession, source_dir: str, glob: str = "events*.parquet",
                 files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of ``events`` arriving in ``source_dir`` as a stream.

    ``glob`` names the files, or the table's folder, whose part files are then streamed.

    By default a micro-batch takes every new file; ``files_per_trigger`` caps it
    (tests use 1 to force many batches).

    The schema is taken from the files' footers once; ``ts`` (TIMESTAMP_NTZ in the
    files) becomes a TIMESTAMP via epoch microseconds, independent of the session
    time zone, so it can carry a watermark.
    """
    if _is_folder(spark, f"{source_dir.rstrip('/')}/{glob}"):
        source_dir, glob = f"{source_dir.rstrip('/')}/{glob}", "*.parquet"  # a table of part files
    schema = spark.read.option("pathGlobFilter", glob).parquet(source_dir).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    ev = reader.parquet(source_dir)
    return ev.withColumn("ts", F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), F.col("ts"))))


def rollup_of(events: DataFrame) -> DataFrame:
    """L1 aggregate (same expression for a stream and for a table)."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.avg("value").alias("avg_value"))


WINDOW = "window_start long, event_type string, samples long, avg_cpu double, seconds double, heat double"
KEPT_WINDOW = WINDOW + ", end_us long, last_us long"
_WINDOW_COLS = [f.split()[0] for f in WINDOW.split(", ")]


def _windows(events: DataFrame, window: str, watermark: str | None) -> DataFrame:
    if watermark:
        events = events.withWatermark("ts", watermark)
    g = events.groupBy(F.window("ts", window).alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("samples"), F.avg("value").alias("avg_cpu"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    seconds = (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 1e6
    return g.select(F.unix_seconds(F.col("w.start")).alias("window_start"), "event_type", "samples", "avg_cpu",
                    seconds.alias("seconds"), (F.col("avg_cpu") * seconds).alias("heat"),
                    F.unix_micros("w.end").alias("end_us"), F.unix_micros("last_ts").alias("last_us"))


def heat_windows_of(events: DataFrame, window: str = "1 day", watermark: str | None = "1 hour") -> DataFrame:
    """L2 aggregate; ``watermark`` None for a table."""
    return _windows(events, window, watermark).select(*_WINDOW_COLS)


class RunCounts:
    """Rows that a query's batches took in and let go, added up over its whole run.

    A query remembers its last hundred batches only; every batch's sink reads what has
    been told since (``drain``), so none is missed.  ``seen`` is the observed metric of that
    name, ``dropped`` what stateful operators dropped as too late, ``taken`` is added by
    the sink.
    """

    def __init__(self) -> None:
        self.seen = self.dropped = self.taken = 0
        self.query: StreamingQuery | None = None
        self._last = -1
        self._lock = threading.Lock()

    def drain(self) -> None:
        with self._lock:
            for p in self.query.recentProgress if self.query is not None else ():
                if p.batchId > self._last:
                    self._last = p.batchId
                    seen = p.observedMetrics.get("seen")
                    self.seen += (seen["n"] or 0) if seen is not None else 0
                    self.dropped += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)


def _started(writer, counts: RunCounts) -> StreamingQuery:
    """Start ``writer`` with its counts attached (``query.counts``)."""
    query = writer.start()
    counts.query, query.counts = query, counts
    return query


def start_live_rollup(events: DataFrame, sink: str, checkpoint: str,
                      trigger: dict | None = None) -> StreamingQuery:
    """L1 as a running query; ``trigger`` defaults to every 30 seconds.

    Each batch is a version of its own; readers take the last (``latest_rollup``), older
    ones are removed.
    """
    versions = Versions(events.sparkSession, sink)

    def write(batch: DataFrame, epoch: int) -> None:
        versions.write(batch.coalesce(1), epoch)

    return (rollup_of(events).writeStream.outputMode("complete").foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def _interval_us(spark: SparkSession, text: str) -> int:
    return spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {text}) AS us").first()["us"]


def start_heat_windows(events: DataFrame, sink: str, checkpoint: str, window: str = "1 day",
                       watermark: str = "1 hour", trigger: dict | None = None, keep: int = 16) -> StreamingQuery:
    """L2 as a running query with a two-sided sink.

    ``open``: all windows that can still change, one version per batch.  ``closed``:
    windows that the watermark has passed, written once, with their folders merged
    ``keep`` at a time.  A batch takes the open windows of the version before it, puts its
    own in their place, writes what has closed, then the new version; that write is the
    commit, and readers ignore what a later batch may have begun.
    """
    spark = events.sparkSession
    opened, closed = _window_tables(spark, sink, keep)
    delay_ms = _interval_us(spark, watermark) // 1000
    counts = RunCounts()

    def write(batch: DataFrame, epoch: int) -> None:
        rows = batch.withColumn("new", F.lit(1))
        before = opened.before(epoch)
        had = 0
        if before is not None:
            had = before.agg(F.sum("samples")).first()[0] or 0
            rows = before.withColumn("new", F.lit(0)).unionByName(rows)
        rest = [c for c in batch.columns if c not in ("window_start", "event_type")]
        rows = rows.groupBy("window_start", "event_type").agg(F.max_by(F.struct(*rest), "new").alias("r"))
        rows = rows.select("window_start", "event_type", "r.*").persist()
        try:
            last, have = rows.agg(F.max("last_us"), F.sum("samples")).first()
            # the watermark that the next batch will have: its rows before that are late
            passed = F.floor(F.col("end_us") / 1000) <= (last // 1000 - delay_ms if last is not None else 0)
            closed.write(rows.filter(passed), epoch)
            opened.write(rows.filter(~passed), epoch)
            counts.taken += (have or 0) - had
        finally:
            rows.unpersist()
        closed.compact(epoch)
        counts.drain()

    seen = events.observe("seen", F.count("ts").alias("n"))
    writer = (_windows(seen, window, watermark).writeStream.outputMode("update").foreachBatch(write)
              .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"})))
    return _started(writer, counts)


def _window_tables(spark: SparkSession, sink: str, keep: int = 16) -> tuple[Versions, Spans]:
    schema = parse_schema(KEPT_WINDOW)
    return Versions(spark, f"{sink}/open", schema), Spans(spark, f"{sink}/closed", schema, keep)


def latest_rollup(spark: SparkSession, sink: str) -> DataFrame:
    """The rows of the last complete version."""
    last = Versions(spark, sink).last()
    return last[1] if last else spark.createDataFrame([], "event_type string, events long, avg_value double")


def late_rows(query: StreamingQuery) -> int:
    """Rows of this run that came after the watermark had passed them and are in no result.

    Exact once the query has ended: rows with a time that were read, less those that
    windows took, or what the state operator of ``start_measured_heat`` dropped.
    """
    counts = query.counts
    counts.drain()
    return counts.dropped if counts.seen == 0 else counts.seen - counts.taken


def latest_windows(spark: SparkSession, sink: str) -> DataFrame:
    """The current value of every window: the closed ones and the last version of the open ones."""
    opened, closed = _window_tables(spark, sink)
    last = opened.last()
    if last is None:
        return spark.createDataFrame([], WINDOW)
    return last[1].unionByName(closed.read(last[0])).select(*_WINDOW_COLS)


# ---- H7: heat between consecutive samples of a host ------------------------------------

HEAT = "host long, event_id long, ts_us long, elapsed_s double, avg_cpu double, heat double"
_SAMPLE = np.dtype([("ts", "<i8"), ("id", "<i8"), ("cpu", "<f8")])


def _host_step(expiry_ms: int):
    """What one batch does to one host: put new samples to the waiting ones, let out what the watermark has passed."""
    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = waiting = np.zeros(0, dtype=_SAMPLE)
        if state.exists:
            last, waiting = (np.frombuffer(bytes(x), dtype=_SAMPLE) for x in state.get)
        if not state.hasTimedOut:
            new = [np.rec.fromarrays([b["ts_us"], b["event_id"], b["cpu"]], dtype=_SAMPLE) for b in batches]
            waiting = np.concatenate([waiting, *new])
        passed = state.getCurrentWatermarkMs()
        waiting = np.sort(waiting, order=["ts", "id"])
        ready = waiting["ts"] // 1000 < passed
        out, waiting = np.concatenate([last, waiting[ready]]), waiting[~ready]
        if len(out) > 1:
            seconds, cpu = np.diff(out["ts"]) / 1e6, (out["cpu"][:-1] + out["cpu"][1:]) / 2
            yield pd.DataFrame({"host": key[0], "event_id": out["id"][1:], "ts_us": out["ts"][1:], "elapsed_s": seconds,
                                "avg_cpu": cpu, "heat": cpu * seconds})
        last = out[-1:]
        if not len(waiting) and len(last) and int(last["ts"][0]) // 1000 + expiry_ms < passed:
            state.remove()
            return
        state.update((last.tobytes(), waiting.tobytes()))
        due = int(waiting["ts"][0]) // 1000 if len(waiting) else int(last["ts"][0]) // 1000 + expiry_ms
        state.setTimeoutTimestamp(max(due, passed + 1, 1))
    return step


def measured_heat_of(events: DataFrame, watermark: str = "1 hour", expiry: str = "30 days") -> DataFrame:
    """H7 over a stream of events: ``HEAT`` rows, each host's in the order of (time, id).

    Equals the batch operator on the samples that are not late, up to the watermark: a
    sample waits until it has passed.  A host without samples for ``expiry`` is forgotten;
    its next sample is a first one.  Events without host, time or value are left out.  A
    host's rows of one batch are one group, so bound the files of a batch.
    """
    spark = events.sparkSession
    samples = (events.withWatermark("ts", watermark).filter("user_id IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL")
               .select(F.col("user_id").alias("host"), "event_id", "ts", F.unix_micros("ts").alias("ts_us"),
                       F.col("value").cast("double").alias("cpu")))
    return samples.groupBy("host").applyInPandasWithState(
        _host_step(_interval_us(spark, expiry) // 1000), HEAT, "last binary, waiting binary", "append",
        GroupStateTimeout.EventTimeTimeout)


def start_measured_heat(events: DataFrame, sink: str, checkpoint: str, watermark: str = "1 hour",
                        expiry: str = "30 days", trigger: dict | None = None, keep: int = 16) -> StreamingQuery:
    """H7 as a running query: each batch's rows are a folder, merged ``keep`` at a time (``read_heat``)."""
    spark = events.sparkSession
    rows, counts = Spans(spark, sink, parse_schema(HEAT), keep), RunCounts()

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            rows.write(batch, epoch)
        finally:
            batch.unpersist()
        rows.compact(epoch)
        counts.drain()

    writer = (measured_heat_of(events, watermark, expiry).writeStream.outputMode("append").foreachBatch(write)
              .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"})))
    return _started(writer, counts)


def read_heat(spark: SparkSession, sink: str) -> DataFrame:
    return Spans(spark, sink, parse_schema(HEAT)).read(1 << 62)


# ---- L1 over C1: the five-way rollup of a trace, kept current --------------------------

def start_composite_rollup(trace: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """L1 over C1 as a running query over a string trace that arrives as part files.

    The version a batch writes is the last one's sums and counts plus its own; both are
    one row per key, so a batch costs its own rows and the number of keys.
    """
    versions = Versions(trace.sparkSession, sink)

    def write(batch: DataFrame, epoch: int) -> None:
        sums = U.rollup_sums(C.with_composite(C.parse_composite(batch)))
        before = versions.before(epoch)
        versions.write(sums if before is None else U.merge_sums(before, sums), epoch)

    return (trace.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def latest_composite(spark: SparkSession, sink: str) -> DataFrame | None:
    """The rollup as of the last complete version; None before the first batch."""
    last = Versions(spark, sink).last()
    return U.finish(last[1]) if last else None


def run_until_caught_up(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_rollup(spark: SparkSession, source_dir: str, glob: str = "events*.parquet",
                  files_per_trigger: int | None = None) -> DataFrame:
    """L1 over everything present now (``availableNow``), read back from the sink."""
    sink = scratch_path(spark, "live-rollup")
    q = start_live_rollup(event_stream(spark, source_dir, glob, files_per_trigger), sink,
                          scratch_path(spark, "live-rollup-ckpt"), {"availableNow": True})
    run_until_caught_up(q)
    return latest_rollup(spark, sink)


def stream_heat_windows(spark: SparkSession, source_dir: str, glob: str = "events*.parquet",
                        window: str = "1 day", watermark: str = "1 hour",
                        files_per_trigger: int | None = None) -> DataFrame:
    """L2 over everything present now, latest emission per window.

    ``watermark`` is how late a sample may come; later ones are counted and warned of.
    """
    sink = scratch_path(spark, "heat-windows")
    q = start_heat_windows(event_stream(spark, source_dir, glob, files_per_trigger), sink,
                           scratch_path(spark, "heat-windows-ckpt"), window, watermark, {"availableNow": True})
    run_until_caught_up(q)
    if late := late_rows(q):
        warnings.warn(f"{late} samples came more than {watermark} late and are left out")
    return latest_windows(spark, sink)


def stream_measured_heat(spark: SparkSession, source_dir: str, glob: str = "events*.parquet", watermark: str = "1 hour",
                         files_per_trigger: int | None = None) -> DataFrame:
    """H7 over everything present now: the pairs that the watermark has passed."""
    sink = scratch_path(spark, "stream-heat")
    q = start_measured_heat(event_stream(spark, source_dir, glob, files_per_trigger), sink,
                            scratch_path(spark, "stream-heat-ckpt"), watermark, trigger={"availableNow": True})
    run_until_caught_up(q)
    if late := late_rows(q):
        warnings.warn(f"{late} samples came more than {watermark} late and are left out")
    return read_heat(spark, sink)


def stream_composite_rollup(spark: SparkSession, trace_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """L1 over C1 over the part files of a string trace that are present now."""
    sink = scratch_path(spark, "stream-composite")
    reader = spark.readStream.schema(spark.read.parquet(trace_dir).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    q = start_composite_rollup(reader.parquet(trace_dir), sink, scratch_path(spark, "stream-composite-ckpt"),
                               {"availableNow": True})
    run_until_caught_up(q)
    found = latest_composite(spark, sink)
    if found is None:  # no part files: the rollup of an empty trace
        found = U.composite_rollup(C.with_composite(C.parse_composite(spark.read.parquet(trace_dir))))
    return found
