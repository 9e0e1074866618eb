"""Streaming keys: the stream's result must equal the batch query (the oracle)."""

from __future__ import annotations

from heatwise.plans.catalog import D_, C_, P_, T_, U_, W, dirty, r6, register
from heatwise.streaming import live as L


@register("stream_rollup", """
SELECT event_type, count(*) AS events, round(avg(value), 6) AS avg_value FROM events GROUP BY event_type""")
def q_stream_rollup(spark, d):
    """L1: the events table read as a file stream, rollup kept current."""
    return r6(L.stream_rollup(spark, d, "events.parquet"))


@register("stream_heat_windows", """
SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_start, event_type, count(*) AS samples,
  round(avg(value), 6) AS avg_cpu, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS seconds,
  round(avg(value) * ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 6) AS heat
FROM events GROUP BY 1, 2""")
def q_stream_heat_windows(spark, d):
    """L2: per day and event type, watermarked, latest emission per window."""
    return r6(L.stream_heat_windows(spark, d, "events.parquet"))


@register("stream_measured_heat", """
WITH s AS (SELECT user_id AS host, event_id, epoch_us(ts) AS ts_us, value AS cpu FROM events),
l AS (SELECT *, lag(ts_us) OVER w AS prev_ts, lag(cpu) OVER w AS prev_cpu FROM s
      WINDOW w AS (PARTITION BY host ORDER BY ts_us, event_id))
SELECT host, event_id, ts_us, round((ts_us - prev_ts)/1e6, 6) AS elapsed_s,
  round((prev_cpu + cpu)/2, 6) AS avg_cpu, round((prev_cpu + cpu)/2 * ((ts_us - prev_ts)/1e6), 6) AS heat
FROM l WHERE prev_ts IS NOT NULL AND ts_us // 1000 < (SELECT max(ts_us) // 1000 - 3600000 FROM s)""")
def q_stream_measured_heat(spark, d):
    """H7 over a stream: the pairs that a watermark of one hour has passed."""
    return r6(L.stream_measured_heat(spark, d, "events.parquet"))


@register("stream_composite_rollup", W(T_, D_, P_, C_, U_, body="SELECT * FROM rollup"))
def q_stream_composite_rollup(spark, d):
    """L1 over C1: the string trace's part files, two a batch, merged into one rollup."""
    folder = dirty(spark, d).inputFiles()[0].rsplit("/", 1)[0]
    return r6(L.stream_composite_rollup(spark, folder, files_per_trigger=2))
