"""Measured heat between consecutive samples of a host.

heat = mean of the CPU readings before and after × elapsed seconds.

A plain ``lag`` over ``partitionBy(host)`` puts every sample of a host in one task; a host
holding a third of all samples would then be one third of the job in one task.  The
samples are instead put in the order (host, ts, id) by a range shuffle, which cuts a hot
host, or a hot day of one host, into as many ranges as its share asks for.  Each range is
read once in order and remembers one row; its first sample takes its predecessor from the
last row of the range before it.  ``bucket_us`` chooses the older form: the lag inside
(host, time bucket) with the bucket tails joined back, for samples that are already laid
out by time bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatwise.session import scratch_path

DAY_US = 86_400 * 1_000_000


def samples_from_events(events: DataFrame) -> DataFrame:
    """Telemetry samples out of ``events``: host = user_id, cpu = value.

    ``ts`` is read as TIMESTAMP_NTZ; it is turned into microseconds since the epoch
    without consulting the session time zone.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return events.select(
        F.col("user_id").alias("host"), F.col("event_id"),
        F.timestamp_diff("MICROSECOND", epoch, F.col("ts")).alias("ts_us"),
        F.col("value").alias("cpu"))


ROW, FIRST, TAIL = 0, 1, 2  # a row of a range, its first row, and a copy of its last row


def _ranged_pairs(samples: DataFrame, partitions: int | None) -> DataFrame:
    """Each sample with its host's reading before it, by one range shuffle over (host, ts, id).

    The ranges are read in order and written to the shared folder, each row with the row
    before it; a range's last row is written once more as its tail.  The tails, one for
    each range, say what the first row of the next range continues.
    """
    order = ["host", "ts_us", "event_id"]
    s = samples.select(*order, "cpu")
    s = s.repartitionByRange(*([partitions] if partitions else []), *order).sortWithinPartitions(*order)
    kinds = {f.name: f.dataType for f in s.schema.fields}
    schema = T.StructType([*s.schema.fields, T.StructField("part", T.IntegerType()),
                           *[T.StructField(f"prev_{c}", kinds[c]) for c in ("host", "ts_us", "cpu")],
                           T.StructField("kind", T.IntegerType())])
    names = [f.name for f in schema.fields]

    def with_row_before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            kind = np.zeros(n, dtype=np.int32)
            before = []
            for c in ("host", "ts_us", "cpu"):
                col = batch.column(c)
                border = pa.nulls(1, col.type) if last is None else last.column(c)
                before.append(pa.concat_arrays([border, col.slice(0, n - 1)]))
            kind[0] = FIRST if last is None else ROW
            yield pa.RecordBatch.from_arrays([*batch.columns, *before, pa.array(kind)], names=names)
            last = batch.slice(n - 1, 1)
        if last is not None:
            nothing = [pa.nulls(1, last.column(c).type) for c in ("host", "ts_us", "cpu")]
            yield pa.RecordBatch.from_arrays([*last.columns, *nothing, pa.array([TAIL], pa.int32())], names=names)

    path = scratch_path(samples.sparkSession, "ranged-samples")
    s.withColumn("part", F.spark_partition_id()).mapInArrow(with_row_before, schema).write.parquet(path)
    rows = samples.sparkSession.read.schema(schema).parquet(path)
    before = Window.orderBy("part")  # one row for each range
    carry = rows.filter(F.col("kind") == TAIL).select(
        F.lead("part").over(before).alias("part"), F.lit(FIRST).alias("kind"),
        F.struct("host", "ts_us", "cpu").alias("carry"))
    j = rows.filter(F.col("kind") != TAIL).join(F.broadcast(carry), ["part", "kind"], "left")
    first = F.col("kind") == FIRST

    def prev(c):
        return F.when(first, F.col(f"carry.{c}")).otherwise(F.col(f"prev_{c}"))

    same = prev("host").eqNullSafe(F.col("host"))
    return j.select("host", "event_id", "ts_us", "cpu", F.when(same, prev("ts_us")).alias("prev_ts"),
                    F.when(same, prev("cpu")).alias("prev_cpu"))


def _bucketed_pairs(samples: DataFrame, bucket_us: int) -> DataFrame:
    """Each sample with its host's reading before it: lag inside time buckets, tails joined back."""
    s = samples.withColumn("bucket", F.floor(F.col("ts_us") / F.lit(bucket_us)).cast("bigint"))
    order = ["ts_us", "event_id"]
    w = Window.partitionBy("host", "bucket").orderBy(*order)
    inner = s.select("host", "bucket", "event_id", "ts_us", "cpu",
                     F.lag("ts_us").over(w).alias("prev_ts"), F.lag("cpu").over(w).alias("prev_cpu"))

    # last sample per (host, bucket): a second, narrow pass over the samples with
    # map-side partial aggregation; its output has one row per host and bucket
    tails = s.groupBy("host", "bucket").agg(
        F.max_by(F.struct("ts_us", "cpu"), F.struct(*order)).alias("tail"))
    wb = Window.partitionBy("host").orderBy("bucket")
    carry = tails.select("host", "bucket", F.lag("tail").over(wb).alias("carry"))

    j = inner.join(carry, ["host", "bucket"], "left")
    prev_cpu = F.when(F.col("prev_ts").isNotNull(), F.col("prev_cpu")).otherwise(F.col("carry.cpu"))
    return j.select("host", "event_id", "ts_us", "cpu", F.coalesce("prev_ts", "carry.ts_us").alias("prev_ts"),
                    prev_cpu.alias("prev_cpu"))


def measured_heat(samples: DataFrame, bucket_us: int | None = None, partitions: int | None = None) -> DataFrame:
    """(host, event_id, ts_us, elapsed_s, avg_cpu, heat) per sample after the host's first.

    ``partitions`` ranges (default: the session's shuffle partitions); with ``bucket_us``
    the lag runs inside time buckets instead.  A sample whose host's reading before it has
    no time is left out, as is one without a time; a null host is a host of its own.
    """
    pairs = _bucketed_pairs(samples, bucket_us) if bucket_us else _ranged_pairs(samples, partitions)
    out = pairs.select("host", "event_id", "ts_us", ((F.col("ts_us") - F.col("prev_ts")) / 1e6).alias("elapsed_s"),
                       ((F.col("prev_cpu") + F.col("cpu")) / 2).alias("avg_cpu"))
    return out.filter(F.col("elapsed_s").isNotNull()).withColumn("heat", F.col("avg_cpu") * F.col("elapsed_s"))
