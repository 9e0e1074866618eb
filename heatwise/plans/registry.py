"""Keys beyond the core reports: files, charts, telemetry (models and streams live in
``registry_ml`` and ``registry_stream``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from heatwise.operators import charts as V
from heatwise.operators import clean as C
from heatwise.operators import reports as R
from heatwise.operators import rollup as U
from heatwise.operators import telemetry as TM
from heatwise.plans import oracle as O
from heatwise.plans.catalog import (
    W, derived, dirty, lin, r6, register, rollup, strings, tasks,
)
from heatwise.schema import DIMENSION_VIEWS, FS12, RAW_COLUMNS, TASK_COLUMNS, TASKS
from heatwise.session import scratch_path, shared_dir
from heatwise.sinks import writers as K
from heatwise.sources import files as S
from heatwise.sources import star

T_, L_, S_, D_, P_, C_, U_ = O.TASKS, O.LIN, O.STRINGS, O.DIRTY, O.PARSED, O.COMP, O.ROLLUP
_DOUBLES = {f.name for f in TASKS.fields if f.dataType.typeName() == "double"}


def _tasks_select(alias_raw: bool = False, source: str = "tasks") -> str:
    cols = []
    for c in TASK_COLUMNS:
        name = O.RAW_NAME.get(c, c) if alias_raw else c
        src = f'"{name}"' if alias_raw else c
        cols.append(f'round(CAST({src} AS DOUBLE), 6) AS "{name}"' if c in _DOUBLES else f'{src} AS "{name}"')
    return ", ".join(cols) + f" FROM {source}"


# ---- sources and sinks (S1-S7, K1-K6) ---------------------------------------------

@register("scan_csv_typed", W(T_, body="SELECT " + _tasks_select()))
def q_scan_csv_typed(spark, d):
    """K1 write (header CSV, fails if present) → S1 typed read with the explicit schema."""
    path = scratch_path(spark, "tasks-csv")
    K.write_csv(star.tasks_from_star(spark, d), path)
    return r6(S.read_tasks_csv(spark, path))


@register("scan_csv_strings", W(T_, S_, body="SELECT " + _tasks_select(True, "strings")))
def q_scan_csv_strings(spark, d):
    """The string trace through CSV, every column read back as text, numbers typed by casts."""
    path = scratch_path(spark, "strings-csv")
    K.write_csv(strings(spark, d), path, compression="gzip")
    back = S.read_strings_csv(spark, path)
    cols = [F.col(f"`{r}`").cast("double").alias(r) if c in _DOUBLES else F.col(f"`{r}`")
            for c, r in zip(TASK_COLUMNS, RAW_COLUMNS)]
    return r6(back.select(cols))


_ORDER_ALL = ", ".join(f"{c} NULLS FIRST" for c in TASK_COLUMNS)


@register("head_rows", W(T_, body=f"SELECT * FROM (SELECT {_tasks_select()} ORDER BY {_ORDER_ALL} LIMIT 1000)"))
def q_head_rows(spark, d):
    return r6(S.head_rows(tasks(spark, d), 1000))


def _write_results(spark, d):
    raw = dirty(spark, d)
    entries = U.with_result_key(U.composite_rollup(C.with_composite(C.parse_composite(raw))))
    path = scratch_path(spark, "results")
    rows = raw.select(F.count(F.lit(1))).scalar()
    K.write_results(entries, rows, list(raw.columns), path)
    return S.read_results(spark, path)


_HEADERS = ",".join(RAW_COLUMNS)


@register("results_envelope", W(T_, D_, P_, C_, U_, body=f"""
SELECT (SELECT count(*) FROM dirty) AS row_count, {len(RAW_COLUMNS)} AS n_headers,
  '{_HEADERS}' AS headers, (SELECT count(*) FROM rollup) AS entries"""))
def q_results_envelope(spark, d):
    """S4 + K5: envelope of the results document (timestamp left out of the comparison)."""
    meta, entries = _write_results(spark, d)
    n = entries.select(F.count(F.lit(1))).scalar()
    return meta.select("row_count", F.size("headers").alias("n_headers"),
                       F.array_join("headers", ",").alias("headers"), n.alias("entries"))


_RESULT_KEY = ("CASE dimension WHEN 'overall' THEN 'overall' WHEN 'machine' THEN 'machine_' || key "
               "WHEN 'class' THEN 'class_' || key WHEN 'collection_type' THEN 'collection_type_' || key "
               "ELSE 'priority_' || key END")


@register("results_object_roundtrip", W(T_, D_, P_, C_, U_, body=f"""
SELECT {_RESULT_KEY} AS result_key, count, avg_cpu_usage, avg_max_cpu, avg_memory, avg_memory_usage,
  avg_heat_generation, total_energy_consumption, avg_duration, total_heat, failure_rate, failed_tasks,
  (SELECT count(*) FROM dirty) AS row_count, '{_HEADERS}' AS headers
FROM rollup"""))
def q_results_object_roundtrip(spark, d):
    """The results document as one JSON object, read back in pieces, with its envelope."""
    raw = dirty(spark, d)
    entries = U.with_result_key(U.composite_rollup(C.with_composite(C.parse_composite(raw))))
    path = scratch_path(spark, "results-object")
    K.write_results_object(entries, raw.select(F.count(F.lit(1))).scalar(), list(raw.columns), path)
    meta, back = S.read_results_object(spark, path)
    return r6(back.withColumns({"row_count": meta.select("row_count").scalar(),
                                "headers": meta.select(F.array_join("headers", ",")).scalar()}))


@register("results_json_roundtrip", W(T_, D_, P_, C_, U_, body=f"""
SELECT {_RESULT_KEY} AS result_key, count, avg_cpu_usage, avg_max_cpu, avg_memory, avg_memory_usage,
  avg_heat_generation, total_energy_consumption, avg_duration, total_heat, failure_rate, failed_tasks
FROM rollup"""))
def q_results_json_roundtrip(spark, d):
    """K5 write → S5 read: entries come back equal to the rollup."""
    _, entries = _write_results(spark, d)
    return r6(entries)


_SCORE_LINE = "printf('%s score (event %d): %.2f', event_type, event_id, value)"


@register("extract_score", f"""
WITH l AS (SELECT {_SCORE_LINE} AS value FROM events)
SELECT value, CAST(regexp_extract_all(value, '[-+]?\\d*\\.\\d+|\\d+')[-1] AS DOUBLE) AS score FROM l""")
def q_extract_score(spark, d):
    """Metric lines written as text, read back, last number per line."""
    ev = star.read_table(spark, d, "events")
    path = scratch_path(spark, "score-lines")
    K.write_text(ev.select(F.format_string("%s score (event %d): %.2f", "event_type", "event_id", "value")
                           .alias("value")), path)
    return S.extract_score(S.read_lines(spark, path)).select("value", "score")


_PAIR_LINE = ("CASE WHEN event_id % 3 = 0 THEN printf('%d %.2f', event_id, value) "
              "ELSE printf('Avg CPU Usage (%%): %.2f', value) END")


@register("extract_number_pairs", f"""
WITH l AS (SELECT {_PAIR_LINE} AS value FROM events),
a AS (SELECT regexp_extract_all(value, '[-+]?\\d*\\.\\d+|\\d+') AS n FROM l)
SELECT CAST(n[1] AS DOUBLE) AS time, CAST(n[2] AS DOUBLE) AS approx_heat FROM a WHERE len(n) >= 2""")
def q_extract_number_pairs(spark, d):
    ev = star.read_table(spark, d, "events")
    line = F.when(F.col("event_id") % 3 == 0, F.format_string("%d %.2f", "event_id", "value")) \
        .otherwise(F.format_string("Avg CPU Usage (%%): %.2f", "value"))
    path = scratch_path(spark, "pair-lines")
    K.write_text(ev.select(line.alias("value")), path)
    return S.extract_number_pairs(S.read_lines(spark, path))


@register("report_text", W(T_, L_, body="""
SELECT printf('%18d%14d%14.4f%14.4f%18.4f', scheduling_class, count(*),
  round(avg(average_usage_cpu) * 1e4) / 1e4, round(avg(heat) * 1e4) / 1e4,
  round(avg(CAST(failed AS DOUBLE))*100 * 1e4) / 1e4) AS value
FROM lin GROUP BY scheduling_class"""))
def q_report_text(spark, d):
    """K3 (+F5): the class report as aligned text lines, 4 digits."""
    rep = R.class_linear(lin(spark, d))
    rounded = rep.select([(F.round(F.col(c) * 1e4, 0) / 1e4).alias(c) if t == "double" else F.col(c)
                          for c, t in rep.dtypes])
    return K.aligned_lines(rounded)


@register("measured_heat", """
WITH s AS (SELECT user_id AS host, event_id, epoch_us(ts) AS ts_us, value AS cpu FROM events),
l AS (SELECT *, lag(ts_us) OVER w AS prev_ts, lag(cpu) OVER w AS prev_cpu FROM s
      WINDOW w AS (PARTITION BY host ORDER BY ts_us, event_id))
SELECT host, event_id, ts_us, round((ts_us - prev_ts)/1e6, 6) AS elapsed_s,
  round((prev_cpu + cpu)/2, 6) AS avg_cpu, round((prev_cpu + cpu)/2 * ((ts_us - prev_ts)/1e6), 6) AS heat
FROM l WHERE prev_ts IS NOT NULL""")
def q_measured_heat(spark, d):
    """W2 (H7): heat between consecutive samples per host, over ranges of (host, ts, id)."""
    return r6(TM.measured_heat(TM.samples_from_events(star.read_table(spark, d, "events"))))


# ---- filters, top-k, label reports (P9, P10, T4, R7-R9) ------------------------------

_TOP10 = "top AS (SELECT machine_id FROM lin GROUP BY machine_id ORDER BY count(*) DESC, machine_id LIMIT 10)"


@register("top_frequent_machines", W(T_, L_, body="""
SELECT machine_id, count(*) AS count FROM lin GROUP BY machine_id ORDER BY count DESC, machine_id LIMIT 10"""))
def q_top_frequent_machines(spark, d):
    return R.top_frequent_machines(lin(spark, d), 10)


@register("top_machine_tasks", W(T_, L_, _TOP10, body="""
SELECT sl_no, machine_id, scheduling_class, priority, duration, round(heat, 6) AS heat
FROM lin WHERE machine_id IN (SELECT machine_id FROM top)"""))
def q_top_machine_tasks(spark, d):
    return r6(R.top_machine_tasks(lin(spark, d), 10)
              .select("sl_no", "machine_id", "scheduling_class", "priority", "duration", "heat"))


@register("feature_columns", W(T_, L_, body=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS non_null, round(avg({c}), 6) AS mean FROM lin" for c in FS12)))
def q_feature_columns(spark, d):
    """P10: the wanted features that exist (a missing one is reported, none raises)."""
    df = lin(spark, d)
    have, missing = C.present_features(df, FS12 + ["gpu_usage"])
    # one aggregate over all present features, exploded to a row per feature
    agg = df.agg(*[F.struct(F.lit(c).alias("feature"), F.count(c).alias("non_null"), F.avg(c).alias("mean"))
                   .alias(c) for c in have])
    return r6(agg.select(F.explode(F.array(*have)).alias("f")).select("f.*"))


@register("label_balance", W(T_, L_, _TOP10, body="""
SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(machine_id AS VARCHAR)) - 1 AS DOUBLE) AS label,
  count(*) AS count
FROM lin WHERE machine_id IN (SELECT machine_id FROM top) GROUP BY machine_id"""))
def q_label_balance(spark, d):
    return R.label_balance(R.top_machine_tasks(lin(spark, d), 10), "machine_id")


@register("top_keys_heavy", W(T_, L_, body="""
SELECT * FROM (SELECT user_id, count(*) AS count FROM lin GROUP BY user_id ORDER BY count DESC, user_id LIMIT 25)"""))
def q_top_keys_heavy(spark, d):
    """T4 for a key without bound: the 25 users with most tasks, over hash buckets."""
    return R.top_keys(lin(spark, d), "user_id", 25, buckets=1 << 10)


def rule_class_prediction():
    """A fixed rule standing in for a fitted class model (SQL-checkable)."""
    return F.pmod(F.floor("cycles_per_instruction"), F.lit(5)).cast("double")


def rule_failure_prediction():
    return F.when(F.col("cpu_usage_distribution") > 0.04, 1.0).otherwise(0.0)


_RULE_CLASS = "CAST(CAST(floor(cycles_per_instruction) AS BIGINT) % 5 AS DOUBLE)"
_RULE_FAIL = "CASE WHEN cpu_usage_distribution > 0.04 THEN 1.0 ELSE 0.0 END"
_PRED_VALUES = [0.0, 1.0, 2.0, 3.0, 4.0]


@register("confusion_matrix", W(T_, L_, body="SELECT CAST(scheduling_class AS VARCHAR) AS scheduling_class_prediction, "
          + ", ".join(f"count(*) FILTER (WHERE {_RULE_CLASS} = {v}) AS \"{v}\"" for v in _PRED_VALUES)
          + " FROM lin GROUP BY scheduling_class"))
def q_confusion_matrix(spark, d):
    pred = lin(spark, d).withColumn("prediction", rule_class_prediction())
    return R.confusion_matrix(pred, "scheduling_class", "prediction", _PRED_VALUES)


@register("failure_outcome_counts", W(T_, L_, body=f"""
SELECT CAST(failed AS VARCHAR) AS failed, CAST({_RULE_FAIL} AS VARCHAR) AS prediction, count(*) AS count
FROM lin GROUP BY 1, 2"""))
def q_failure_outcome_counts(spark, d):
    pred = lin(spark, d).withColumn("prediction", rule_failure_prediction())
    return R.outcome_counts(pred, "failed", "prediction")


# ---- chart statistics (V1-V4) and views ------------------------------------------------

_MACHINE_MEM = "m AS (SELECT machine_id, sum(eff_mem) / count(*) AS x FROM comp GROUP BY machine_id)"


_BOUNDS = "b AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 20 AS w FROM m)"


@register("memory_histogram", W(T_, D_, P_, C_, _MACHINE_MEM, _BOUNDS, body="""
SELECT bin, round(lo + bin * w, 6) AS bin_start, round(lo + (bin + 1) * w, 6) AS bin_end, count(*) AS machines
FROM (SELECT CASE WHEN w = 0 THEN 0 ELSE least(CAST(floor((x - lo) / w) AS INT), 19) END AS bin, lo, w
      FROM m, b WHERE x IS NOT NULL)
GROUP BY bin, lo, w"""))
def q_memory_histogram(spark, d):
    # one row per machine, checkpointed: the rollup runs once for bounds and bins
    shared_dir(spark)
    per_machine = rollup(spark, d).filter(F.col("dimension") == "machine").checkpoint(eager=True)
    return r6(V.histogram(per_machine, "avg_memory_usage", 20))


_FIRST20 = ("m AS (SELECT machine_id, sum(eff_cpu) / count(*) AS x FROM comp GROUP BY machine_id "
            "ORDER BY machine_id LIMIT 20)")
_BOX_SQL = ", ".join(f"round(quantile_cont({{x}}, {q}), 6) AS {n}" for q, n in zip(V.QUARTILES, V.BOX))


def _machine_box(spark, d, machines: int | None):
    """Box statistics of per-machine CPU over the first ``machines`` machines by id as text, or all."""
    per_machine = rollup(spark, d).filter(F.col("dimension") == "machine")
    if machines is not None:
        per_machine = per_machine.orderBy("key").limit(machines)
    return r6(V.group_box_stats(per_machine.withColumn("all", F.lit(1)), "avg_cpu_usage", ["all"]).drop("all", "n"))


@register("cpu_box_stats", W(T_, D_, P_, C_, _FIRST20, body=f"SELECT {_BOX_SQL.format(x='x')} FROM m"))
def q_cpu_box_stats(spark, d):
    """V2: box statistics of per-machine CPU over the first 20 machines, the chart's own choice."""
    return _machine_box(spark, d, 20)


@register("cpu_box_stats_all", W(T_, D_, P_, C_, _FIRST20.replace("ORDER BY machine_id LIMIT 20", ""),
                                 body=f"SELECT {_BOX_SQL.format(x='x')} FROM m"))
def q_cpu_box_stats_all(spark, d):
    """V2 over all machines."""
    return _machine_box(spark, d, None)


@register("machine_cpu_box", W(T_, L_, body=f"""
SELECT machine_id, count(cpu_usage_distribution) AS n, {_BOX_SQL.format(x='cpu_usage_distribution')} FROM lin GROUP BY machine_id"""))
def q_machine_cpu_box(spark, d):
    """V2 per machine: exact box statistics of its tasks' CPU, by distributed rank selection."""
    return r6(V.group_box_stats(lin(spark, d), "cpu_usage_distribution", ["machine_id"]))


@register("machine_cpu_box_sketch", W(T_, L_, body=f"""
SELECT machine_id, quartile, n, true AS within FROM (SELECT machine_id, count(cpu_usage_distribution) AS n FROM lin GROUP BY machine_id),
  (SELECT unnest({V.BOX}) AS quartile)"""))
def q_machine_cpu_box_sketch(spark, d):
    """V2 from merged sketches, one per machine and class: every answer's rank is within 1 % of the one asked for."""
    parts = V.box_sketches(lin(spark, d), "cpu_usage_distribution", ["machine_id", "scheduling_class"])
    box = V.box_of_sketches(V.merge_box_sketches(parts, ["machine_id"]), ["machine_id"])
    asked = box.select("machine_id", "n", F.explode(F.array(*[
        F.struct(F.lit(n).alias("quartile"), F.lit(q).alias("q"), F.col(n).alias("x")) for q, n in zip(V.QUARTILES, V.BOX)])).alias("a"))
    ranks = lin(spark, d).join(asked.select("machine_id", "n", "a.*"), "machine_id").groupBy("machine_id", "quartile", "n", "q").agg(
        F.avg((F.col("cpu_usage_distribution") < F.col("x")).cast("int")).alias("below"),
        F.avg((F.col("cpu_usage_distribution") <= F.col("x")).cast("int")).alias("upto"))
    slack = F.lit(0.01) + 1 / F.col("n")
    return ranks.select("machine_id", "quartile", "n", F.col("q").between(F.col("below") - slack, F.col("upto") + slack).alias("within"))


@register("task_share", W(T_, D_, P_, C_, U_, body="""
SELECT dimension, key, count AS tasks, round(count / sum(count) OVER (PARTITION BY dimension), 6) AS share
FROM rollup WHERE dimension IN ('class', 'collection_type')"""))
def q_task_share(spark, d):
    return r6(V.shares(rollup(spark, d)))


_SUMMARY_COLS = ["total_tasks", "avg_cpu_usage", "peak_cpu", "assigned_memory", "memory_usage", "avg_heat",
                 "total_energy", "avg_duration", "total_heat", "failure_rate_pct"]


_SUMMARY = """s AS (SELECT CAST(count(*) AS DOUBLE) AS total_tasks, avg(average_usage_cpu) AS avg_cpu_usage,
  avg(maximum_usage) AS peak_cpu, avg(assigned_memory) AS assigned_memory, avg(avg_usage_memory) AS memory_usage,
  avg(heat) AS avg_heat, sum(energy) AS total_energy, avg(CAST(duration AS DOUBLE)) AS avg_duration,
  sum(heat) AS total_heat, avg(CAST(failed AS DOUBLE))*100 AS failure_rate_pct FROM lin)"""


@register("overall_unpivot", W(T_, L_, _SUMMARY, body=" UNION ALL ".join(
    f"SELECT '{c}' AS metric, round({c}, 6) AS value FROM s" for c in _SUMMARY_COLS)))
def q_overall_unpivot(spark, d):
    return r6(V.unpivot_row(R.overall_summary(lin(spark, d))))


def _view_query(dim):
    def q(spark, d):
        return r6(U.dimension_view(U.with_result_key(rollup(spark, d)), dim))
    return q


for _dim, _key in (("class", "class_view"), ("priority", "priority_view"),
                   ("collection_type", "collection_type_view")):
    _cols = ", ".join(f'{src} AS "{shown}"' for src, shown in DIMENSION_VIEWS[_dim])
    register(_key, W(T_, D_, P_, C_, U_, body=f"SELECT {_cols} FROM rollup WHERE dimension = '{_dim}'"))(
        _view_query(_dim))
