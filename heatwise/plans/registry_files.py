"""Keys of the file forms: rejected lines at the source, score files, reports read back, legacy
headers; and of the models judged together."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatwise.operators import clean as C
from heatwise.operators import ml as M
from heatwise.operators import reports as R
from heatwise.operators import telemetry as TM
from heatwise.plans import oracle as O
from heatwise.plans.catalog import W, lin, r6, register, strings, tasks
from heatwise.plans.registry_ml import _PRED_SQL, _TEST_SIDE, _long, fixed_metrics
from heatwise.schema import FS12, FS13, FS14
from heatwise.session import scratch_path
from heatwise.sinks import writers as K
from heatwise.sources import files as S
from heatwise.sources import star

T_, L_ = O.TASKS, O.LIN

# Lines of the damaged trace: (reason, rows of it); the first that holds counts.
_DAMAGE = [("fields", "sl_no % 97 = 0"), ("quotes", "sl_no % 89 = 0"), ("value", "sl_no % 83 = 0")]


def damaged_trace(spark, d) -> str:
    """A folder of CSV files of all task rows, some with a field too few, an open quote or a word for a number."""
    raw = strings(spark, d)
    number = F.col("`SL.No`" if "SL.No" in raw.columns else "sl_no").cast("long")
    hurt = {reason: F.expr(rule) for reason, rule in _DAMAGE}
    rows = raw.withColumn("sl_no", number)
    values = [F.when(hurt["value"] & ~hurt["fields"] & ~hurt["quotes"], F.lit("many")).otherwise(F.col(c))
              if c == "average_usage_cpu" else F.col(f"`{c}`") for c in raw.columns]
    fields = F.array(*[F.coalesce(v.cast("string"), F.lit("")) for v in values])
    opened = F.transform(fields, lambda v, i: F.when(i == raw.columns.index("event"), F.concat(F.lit('"'), v)).otherwise(v))
    line = (F.when(hurt["fields"], F.array_join(F.slice(fields, 1, len(values) - 1), ","))
            .when(hurt["quotes"], F.array_join(opened, ",")).otherwise(F.array_join(fields, ",")))
    head, path = F.lit(",".join(raw.columns)), scratch_path(spark, "damaged-trace")
    # a task writes one file, so the header goes before the first row of each (no shuffle, no sort);
    # a file of the header alone stands for a trace without rows
    first = F.monotonically_increasing_id() % F.lit(1 << 33) == 0
    spark.range(0, 1, 1, 1).select(head.alias("value")).write.text(f"{path}/head")
    rows.select(F.when(first, F.concat_ws("\n", head, line)).otherwise(line).alias("value")).write.option(
        "maxRecordsPerFile", 0).text(f"{path}/lines")
    return path


_REASON = "CASE " + " ".join(f"WHEN {rule} THEN '{reason}'" for reason, rule in _DAMAGE) + " ELSE 'accepted' END"


@register("csv_rejected_lines", W(T_, body=f"""
SELECT {_REASON} AS reason, CASE {_REASON} WHEN 'value' THEN 'average_usage_cpu' END AS field,
  count(*) AS lines, CAST(sum(sl_no) AS BIGINT) AS numbers
FROM tasks GROUP BY ALL"""))
def q_csv_rejected_lines(spark, d):
    """P6 at the source: accepted and rejected lines of a damaged trace, with the sum of their numbers."""
    good, bad = S.read_tasks_csv_checked(spark, damaged_trace(spark, d))
    seen = good.select(F.lit("accepted").alias("reason"), F.lit(None).cast("string").alias("field"), "sl_no").unionByName(
        bad.select("reason", "field", F.regexp_extract("line", "^([0-9]+),", 1).cast("long").alias("sl_no")))
    return seen.groupBy("reason", "field").agg(F.count(F.lit(1)).alias("lines"), F.sum("sl_no").alias("numbers"))


@register("csv_accepted_report", W(T_, L_, body=f"""
SELECT scheduling_class, count(*) AS tasks, round(avg(heat), 6) AS avg_heat, CAST(sum(duration) AS BIGINT) AS duration
FROM lin WHERE {_REASON} = 'accepted' GROUP BY scheduling_class"""))
def q_csv_accepted_report(spark, d):
    """Trace file to report: the linear path over the accepted lines."""
    good, _ = S.read_tasks_csv_checked(spark, damaged_trace(spark, d))
    return r6(C.linear_tasks(good).groupBy("scheduling_class").agg(
        F.count(F.lit(1)).alias("tasks"), F.avg("heat").alias("avg_heat"), F.sum("duration").alias("duration")))


_RANKS = ("r AS (SELECT failed, (2 * rank() OVER (ORDER BY cpu_usage_distribution) "
          "+ count(*) OVER (PARTITION BY cpu_usage_distribution) - 1) / 2.0 AS ar FROM lin)")
_AUC = ("(sum(CASE WHEN failed = 1 THEN ar ELSE 0.0 END) - CAST(sum(failed) AS DOUBLE) * (CAST(sum(failed) AS DOUBLE) + 1) / 2.0) "
        "/ (CAST(sum(failed) AS DOUBLE) * CAST(count(*) - sum(failed) AS DOUBLE))")


@register("score_files", W(T_, L_, _PRED_SQL, _RANKS, body=f"""
SELECT t.task, file, metric, CASE WHEN v.value IS NOT NULL THEN round(v.value * 1e4) / 1e4 END AS score
FROM (VALUES {", ".join(f"('{t}', '{f}', '{m}')" for t, (f, m) in S.SCORE_FILES.items())}, ('absent', 'none.txt', 'RMSE')) t(task, file, metric)
LEFT JOIN (SELECT 'rmse_' || task || '.txt' AS file, value FROM ({_long('p', 'task')}) WHERE metric = 'rmse'
           UNION ALL SELECT 'auc_failure_score.txt', {_AUC} FROM r) v USING (file)"""))
def q_score_files(spark, d):
    """Metric files per task written, and each task's score read back by the file map."""
    path = scratch_path(spark, "score-files")
    every = fixed_metrics(spark, d).withColumn("value", F.round(F.col("value") * 1e4, 0) / 1e4).persist()
    for task in ("heat", "energy", "duration"):
        lines = K.metric_lines(every.where(F.col("task") == task), F.format_string("%s (%s)", F.upper("metric"), F.initcap("task")))
        K.write_text(lines, f"{path}/rmse_{task}.txt")
    every.unpersist()
    area = M.auc(lin(spark, d), "failed", "cpu_usage_distribution")
    K.write_text(K.metric_lines(area.withColumn("auc", F.round(F.col("auc") * 1e4, 0) / 1e4), F.lit("AUC Score (Failure)"), "auc"),
                 f"{path}/auc_failure_score.txt")
    return r6(S.read_scores(spark, path, S.SCORE_FILES | {"absent": ("none.txt", "RMSE")}))


_CLASS_REPORT = T.StructType([T.StructField("scheduling_class", T.IntegerType()), T.StructField("Tasks", T.LongType()),
                              T.StructField("Heat", T.DoubleType()), T.StructField("No Such Column", T.DoubleType())])


@register("report_read_back", W(T_, L_, body="""
SELECT scheduling_class, count(*) AS "Tasks", round(avg(heat), 6) AS "Heat", CAST(NULL AS DOUBLE) AS "No Such Column",
  true AS found FROM lin GROUP BY scheduling_class"""))
def q_report_read_back(spark, d):
    """K2 written with display names, S6 read back by a schema; an absent report is an empty table."""
    path = scratch_path(spark, "class-report")
    K.write_report(R.class_linear(lin(spark, d)), f"{path}/csv", "scheduling_class_analysis")
    there = S.read_report_csv(spark, f"{path}/csv", _CLASS_REPORT).withColumn("found", F.lit(True))
    absent = S.read_report_csv(spark, f"{path}/absent", _CLASS_REPORT).withColumn("found", F.lit(False))
    return r6(there.unionByName(absent))


@register("heat_log_read_back", """
WITH s AS (SELECT user_id AS host, event_id, epoch_us(ts) AS ts_us, value AS cpu FROM events),
l AS (SELECT *, lag(ts_us) OVER w AS prev_ts, lag(cpu) OVER w AS prev_cpu FROM s
      WINDOW w AS (PARTITION BY host ORDER BY ts_us, event_id))
SELECT host, count(*) AS samples, round(sum((ts_us - prev_ts)/1e6), 6) AS elapsed_s, round(max((prev_cpu + cpu)/2), 6) AS top_cpu
FROM l WHERE prev_ts IS NOT NULL GROUP BY host""")
def q_heat_log_read_back(spark, d):
    """K6: the measured-heat log written as CSV parts, read back and summed per host."""
    heat = TM.measured_heat(TM.samples_from_events(star.read_table(spark, d, "events")))
    path = scratch_path(spark, "heat-log")
    K.write_heat_log(heat, path)
    back = spark.read.option("header", True).schema(heat.schema).csv(path)
    return r6(back.groupBy("host").agg(F.count(F.lit(1)).alias("samples"), F.sum("elapsed_s").alias("elapsed_s"),
                                       F.max("avg_cpu").alias("top_cpu")))


@register("legacy_header", W(T_, body="""
SELECT sl_no, machine_id FROM tasks WHERE machine_id IS NOT NULL"""))
def q_legacy_header(spark, d):
    """A trace whose header says ``SL.No``, cleaned of rows without a machine."""
    path = scratch_path(spark, "legacy-header")
    K.write_csv(tasks(spark, d).select(F.col("sl_no").alias("SL.No"), "machine_id"), path)
    return C.drop_incomplete(S.read_tasks_csv(spark, path), ["machine_id"]).select("sl_no", "machine_id")


@register("model_without_rows", W(T_, L_, body=f"""
SELECT c AS case, CASE c WHEN 'whole' THEN (SELECT count(*) FROM lin WHERE {_TEST_SIDE}) ELSE 0 END AS rows
FROM (SELECT unnest(['whole', 'no training side', 'no test side', 'no label']) AS c)"""))
def q_model_without_rows(spark, d):
    """A classifier whose split has an empty side, or that lacks its label, predicts nothing."""
    data = lin(spark, d)
    train = M.split_flag("sl_no")
    cases = {"whole": data, "no training side": data.filter(~train), "no test side": data.filter(train), "no label": data.drop("collection_type")}
    out = None
    for name, rows in cases.items():
        n = M.predict_label(rows, "collection_type", num_trees=2, max_depth=2).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("case"), "rows")
        out = n if out is None else out.unionByName(n)
    return out


# ---- models judged together (M8 / M9, M11, M12, P13 / V5) ---------------------------------

_FIXED_CLASSES = [("rule", "cpu_usage_distribution", 0.04), ("other", "average_usage_cpu", 0.05)]
_CLASS_ROWS = "q AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS model, CAST(failed AS DOUBLE) AS l, CASE WHEN {c} > {t} THEN 1.0 ELSE 0.0 END AS p, {c} AS s, failed FROM lin"
    for n, c, t in _FIXED_CLASSES) + ")"
_PER = """bl AS (SELECT model, l, count(*) AS n_l, sum(CASE WHEN l = p THEN 1 ELSE 0 END) AS tp FROM q GROUP BY ALL),
bp AS (SELECT model, p AS l, count(*) AS n_p FROM q GROUP BY ALL),
per AS (SELECT bl.model, bl.l, n_l, tp, CASE WHEN coalesce(n_p, 0) > 0 THEN tp / n_p ELSE 0.0 END AS prec, tp / n_l AS rec
        FROM bl LEFT JOIN bp ON bl.l = bp.l AND bl.model = bp.model),
cm AS (SELECT model, sum(tp) / sum(n_l) AS accuracy, sum(prec * n_l) / sum(n_l) AS weighted_precision,
         sum(rec * n_l) / sum(n_l) AS weighted_recall,
         sum(CASE WHEN prec + rec > 0 THEN 2*prec*rec/(prec + rec) ELSE 0.0 END * n_l) / sum(n_l) AS f1 FROM per GROUP BY model),
ra AS (SELECT model, failed, (2 * rank() OVER (PARTITION BY model ORDER BY s) + count(*) OVER (PARTITION BY model, s) - 1) / 2.0 AS ar FROM q)"""


def fixed_models(spark, d):
    """A ``models`` array of predictions that SQL can state: one regression a task, two failure rules."""
    from heatwise.plans.registry_ml import _FIXED

    def entry(task, model, label, prediction, score):
        return F.struct(F.lit(task).alias("task"), F.lit(model).alias("model"), F.col(label).cast("double").alias("label"),
                        prediction.cast("double").alias("prediction"), score.cast("double").alias("score"))

    fits = [entry(t, "proxy", y, pred(), F.lit(None)) for t, y, pred, _ in _FIXED]
    rules = [entry("failure", n, "failed", F.when(F.col(c) > t, 1.0).otherwise(0.0), F.col(c)) for n, c, t in _FIXED_CLASSES]
    return lin(spark, d).select("sl_no", "machine_id", F.array(*fits, *rules).cast(M.MODEL_ROW).alias("models"))


@register("models_judged_together", W(T_, L_, _PRED_SQL, _CLASS_ROWS, _PER, body=f"""
SELECT task, 'proxy' AS model, metric, round(value, 6) AS value FROM ({_long('p', 'task')})
UNION ALL SELECT 'failure', model, metric, round(value, 6) FROM (
  SELECT model, unnest(['accuracy', 'f1', 'weighted_precision', 'weighted_recall']) AS metric,
         unnest([accuracy, f1, weighted_precision, weighted_recall]) AS value FROM cm)
UNION ALL SELECT 'failure', model, 'auc', round({_AUC}, 6) FROM ra GROUP BY model"""))
def q_models_judged_together(spark, d):
    """M10-M12 for an array of models at once, on fixed predictions."""
    return r6(M.metrics_of_models(fixed_models(spark, d)))


_FEW = {"regressors": {"LinearRegression": M.REGRESSORS["LinearRegression"]},
        "classifiers": {"LogisticRegression": M.CLASSIFIERS["LogisticRegression"]}}


@register("prediction_samples", W(T_, L_, body=f"""
SELECT sl_no, task, 'actual minus prediction' AS residual_is, round(actual, 6) AS actual, true AS predicted
FROM (SELECT * FROM lin WHERE {_TEST_SIDE} ORDER BY sl_no, machine_id LIMIT 10),
LATERAL (VALUES ('heat_prediction', heat), ('energy_prediction', energy), ('duration_prediction', CAST(duration AS DOUBLE)),
                ('failure_prediction', CAST(failed AS DOUBLE))) v(task, actual)"""))
def q_prediction_samples(spark, d):
    """Ten test rows with actual and predicted heat, energy, duration and failure."""
    few = M.sample_of_models(M.predict_models(lin(spark, d), FS12, **_FEW), 10)
    right = F.when(F.col("residual") == F.col("actual") - F.col("prediction"), "actual minus prediction")
    return r6(few.select("sl_no", "task", right.alias("residual_is"), "actual", F.col("prediction").isNotNull().alias("predicted")))


@register("fitted_confusion", W(T_, L_, body=f"""
SELECT 'failure_prediction' AS task, 'LogisticRegression' AS model, CAST(failed AS DOUBLE) AS label, count(*) AS count, true AS classes
FROM lin WHERE {_TEST_SIDE} GROUP BY failed"""))
def q_fitted_confusion(spark, d):
    """Confusion counts of a fitted failure classifier; SQL knows the sums over its predictions."""
    counts = M.confusion_of_models(M.predict_models(lin(spark, d), FS12, **_FEW))
    return counts.groupBy("task", "model", "label").agg(F.sum("count").alias("count"), F.bool_and(
        F.col("prediction").isin(0.0, 1.0)).alias("classes"))


_VARIANTS = {"heat": FS14, "energy": FS14, "duration": FS13}


@register("linear_fit_variants", W(T_, L_, body=" UNION ALL ".join(f"""
SELECT '{y}' AS label, term, rows, 0.0 AS correlation
FROM (SELECT count(*) AS rows FROM lin WHERE NOT ({_TEST_SIDE})), (SELECT unnest({["intercept", *xs]}) AS term)"""
                                                              for y, xs in _VARIANTS.items())))
def q_linear_fit_variants(spark, d):
    """M5 over the wider feature sets (heat is a multiple of one of them, so its fit is exact): normal equations."""
    train, _ = M.hash_split(lin(spark, d))
    fits = M.least_squares(train, FS14, ["heat", "energy"]) | M.least_squares(train, FS13, ["duration"])
    return r6(M.normal_equations(train, fits))


@register("failure_wide_rows", W(T_, L_, body=f"""
SELECT sl_no, machine_id, CAST(failed AS DOUBLE) AS label, true AS predicted FROM lin WHERE {_TEST_SIDE}"""))
def q_failure_wide_rows(spark, d):
    """M6 over the 14 features: the test side of the failure forest, every row once with a class and a score."""
    p = M.predict_failure(lin(spark, d), features=FS14)
    ok = F.col("prediction").isin(0.0, 1.0) & F.col("score").between(0, 1)
    return p.select("sl_no", "machine_id", F.col("failed").alias("label"), ok.alias("predicted"))
