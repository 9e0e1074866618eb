"""Model keys.  Metric arithmetic is SQL-checked on fixed, SQL-computable predictions
(a fitted model has no oracle); fitted models are checked by rows and bounds."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from heatwise.operators import clean as C
from heatwise.operators import ml as M
from heatwise.operators import reports as R
from heatwise.plans import oracle as O
from heatwise.plans.catalog import W, lin, r6, register
from heatwise.plans.registry import _RULE_CLASS, rule_class_prediction
from heatwise.schema import FS12, FS16
from heatwise.sinks import writers as K

T_, L_ = O.TASKS, O.LIN


# ---- M1-M4 ----------------------------------------------------------------------------

@register("features_assembled", W(T_, L_, body="SELECT sl_no, " + ", ".join(
    f"round({c}, 6) AS f_{c}" for c in FS12) + " FROM lin"))
def q_features_assembled(spark, d):
    a = M.assemble(lin(spark, d), FS12).select("sl_no", vector_to_array("features").alias("v"))
    return r6(a.select("sl_no", *[F.col("v")[i].alias(f"f_{c}") for i, c in enumerate(FS12)]))


@register("label_index", W(T_, L_, body="""
SELECT priority, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(priority AS VARCHAR)) - 1 AS DOUBLE)
  AS priority_idx, count(*) AS count
FROM lin GROUP BY priority"""))
def q_label_index(spark, d):
    t = M.index_labels(lin(spark, d), "priority")
    return t.groupBy("priority", "priority_idx").agg(F.count(F.lit(1)).alias("count"))


def _z(c: str) -> str:
    return (f"CASE WHEN stddev_samp({c}) OVER () = 0 THEN 0.0 "
            f"ELSE ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () END")


@register("features_scaled", W(T_, L_, body="SELECT sl_no, " + ", ".join(
    f"round({_z(c)}, 6) AS z_{c}" for c in FS12) + " FROM lin"))
def q_features_scaled(spark, d):
    s = M.scale(M.assemble(lin(spark, d), FS12)).select("sl_no", vector_to_array("scaled").alias("v"))
    return r6(s.select("sl_no", *[F.col("v")[i].alias(f"z_{c}") for i, c in enumerate(FS12)]))


@register("train_test_split", W(T_, L_, body="""
SELECT sl_no, machine_id,
  CASE WHEN ('0x' || substr(md5(CAST(sl_no AS VARCHAR)), 1, 4))::INTEGER % 100 < 80 THEN 'train' ELSE 'test' END
  AS side
FROM lin"""))
def q_train_test_split(spark, d):
    return lin(spark, d).select("sl_no", "machine_id",
                                F.when(M.split_flag("sl_no"), "train").otherwise("test").alias("side"))


# ---- M10-M12 on fixed predictions ---------------------------------------------------------

_FIXED = [  # (task, label, fixed prediction in Spark, same in SQL)
    ("heat", "heat", lambda: F.col("cpu_usage_distribution") * 100 + 10, "cpu_usage_distribution*100 + 10"),
    ("energy", "energy", lambda: F.col("cpu_usage_distribution") * F.col("duration") * 1e-6,
     "cpu_usage_distribution*duration*1e-6"),
    ("duration", "duration", lambda: F.col("resource_request") * 1e6 - 50000, "resource_request*1e6 - 50000"),
]

_PRED_SQL = "p AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS task, CAST({lab} AS DOUBLE) AS y, {sql} AS yhat FROM lin" for t, lab, _, sql in _FIXED) + ")"

_METRICS_SQL = ("SELECT {keys}, sqrt(avg((y-yhat)*(y-yhat))) AS rmse, avg(abs(y-yhat)) AS mae, "
                "1 - sum((y-yhat)*(y-yhat)) / (var_pop(y)*count(*)) AS r2 FROM {src} GROUP BY {keys}")


def _long(src: str, keys: str) -> str:
    m = _METRICS_SQL.format(src=src, keys=keys)
    return " UNION ALL ".join(f"SELECT {keys}, '{k}' AS metric, {k} AS value FROM ({m})" for k in ("rmse", "mae", "r2"))


def fixed_metrics(spark, d):
    """Metrics of the fixed predictions of all tasks, one pass over the table."""
    specs = [({"task": task}, F.col(label).cast("double"), pred()) for task, label, pred, _ in _FIXED]
    return M.regression_metrics_many(lin(spark, d), specs)


@register("regression_metrics", W(T_, L_, _PRED_SQL, body=f"""
SELECT task, metric, round(value, 6) AS value FROM ({_long('p', 'task')})"""))
def q_regression_metrics(spark, d):
    return r6(fixed_metrics(spark, d))


@register("metric_lines", W(T_, L_, _PRED_SQL, body=f"""
SELECT printf('%s (%s): %.4f', upper(metric), task, round(value * 1e4) / 1e4) AS value
FROM ({_long('p', 'task')})"""))
def q_metric_lines(spark, d):
    """K4: ``RMSE (heat): 0.1234`` lines of the metrics table."""
    m = fixed_metrics(spark, d).withColumn("value", F.round(F.col("value") * 1e4, 0) / 1e4)
    return K.metric_lines(m, F.format_string("%s (%s)", F.upper("metric"), F.col("task")))


_CONFUSION = f"""c AS (SELECT CAST(scheduling_class AS DOUBLE) AS l, {_RULE_CLASS} AS p, count(*) AS n FROM lin GROUP BY 1, 2),
bl AS (SELECT l, sum(n) AS n_l, sum(CASE WHEN l = p THEN n ELSE 0 END) AS tp FROM c GROUP BY l),
bp AS (SELECT p AS l, sum(n) AS n_p FROM c GROUP BY p),
per AS (SELECT bl.l, n_l, tp, CASE WHEN coalesce(n_p, 0) > 0 THEN tp / n_p ELSE 0.0 END AS prec,
        tp / n_l AS rec FROM bl LEFT JOIN bp ON bl.l = bp.l)"""


@register("classification_metrics", W(T_, L_, _CONFUSION, body="""
SELECT round(sum(tp) / sum(n_l), 6) AS accuracy,
  round(sum(CASE WHEN prec + rec > 0 THEN 2*prec*rec/(prec + rec) ELSE 0.0 END * n_l) / sum(n_l), 6) AS f1,
  round(sum(prec * n_l) / sum(n_l), 6) AS weighted_precision,
  round(sum(rec * n_l) / sum(n_l), 6) AS weighted_recall
FROM per"""))
def q_classification_metrics(spark, d):
    pred = lin(spark, d).withColumn("prediction", rule_class_prediction())
    return r6(M.classification_metrics(pred, "scheduling_class", "prediction"))


_RANKS = ("r AS (SELECT failed, (2 * rank() OVER (ORDER BY cpu_usage_distribution) "
          "+ count(*) OVER (PARTITION BY cpu_usage_distribution) - 1) / 2.0 AS ar FROM lin)")


@register("auc_metric", W(T_, L_, _RANKS, body="""
SELECT round((sum(CASE WHEN failed = 1 THEN ar ELSE 0.0 END)
        - CAST(sum(failed) AS DOUBLE) * (CAST(sum(failed) AS DOUBLE) + 1) / 2.0)
       / (CAST(sum(failed) AS DOUBLE) * CAST(count(*) - sum(failed) AS DOUBLE)), 6) AS auc
FROM r"""))
def q_auc_metric(spark, d):
    """Exact AUC of a fixed score (cpu_usage_distribution) for the failed flag."""
    return r6(M.auc(lin(spark, d), "failed", "cpu_usage_distribution"))


# ---- M14 / W1 on metrics of fixed predictors ----------------------------------------------

_CANDIDATES_SQL = (
    "mm AS (SELECT task, avg(y) AS mu FROM p GROUP BY task), "
    "q AS (SELECT task, 'proxy' AS model, y, yhat FROM p UNION ALL "
    "SELECT p.task, 'mean', y, mu FROM p JOIN mm ON p.task = mm.task UNION ALL "
    "SELECT task, 'zero', y, 0.0 FROM p)")


def candidate_metrics(spark, d):
    """Metrics of three fixed predictors per task: the proxy formula, the label mean, zero."""
    base = lin(spark, d)
    # the label means as one scalar subquery (one pass), then every metric in one more
    means = base.select(F.struct(*[F.avg(F.col(label).cast("double")).alias(task)
                                   for task, label, _, _ in _FIXED])).scalar()
    specs = []
    for task, label, pred, _ in _FIXED:
        y = F.col(label).cast("double")
        for model, yhat in (("proxy", pred()), ("mean", means[task]), ("zero", F.lit(0.0))):
            specs.append(({"task": task, "model": model}, y, yhat))
    return M.regression_metrics_many(base, specs)


@register("best_models", W(T_, L_, _PRED_SQL, _CANDIDATES_SQL, f"long AS ({_long('q', 'task, model')})", body="""
SELECT task, model, metric, round(value, 6) AS value FROM (
  SELECT *, rank() OVER (PARTITION BY task, metric
                         ORDER BY CASE WHEN metric IN ('rmse', 'mae') THEN value ELSE -value END) AS rk
  FROM long) WHERE rk = 1"""))
def q_best_models(spark, d):
    return r6(M.best_models(candidate_metrics(spark, d)))


# ---- fitted models (rows only) ---------------------------------------------------------------

@register("predict_heat")
def q_predict_heat(spark, d):
    return M.predict_regression(lin(spark, d), "heat")


@register("predict_energy")
def q_predict_energy(spark, d):
    return M.predict_regression(lin(spark, d), "energy")


@register("predict_duration")
def q_predict_duration(spark, d):
    return M.predict_regression(lin(spark, d), "duration")


@register("predict_failure")
def q_predict_failure(spark, d):
    return M.predict_failure(lin(spark, d))


@register("predict_collection_type")
def q_predict_collection_type(spark, d):
    return M.predict_label(lin(spark, d), "collection_type")


@register("predict_class")
def q_predict_class(spark, d):
    return M.predict_label(lin(spark, d), "scheduling_class")


@register("predict_priority")
def q_predict_priority(spark, d):
    return M.predict_label(lin(spark, d), "priority", scaled=True, num_trees=100, max_depth=10)


@register("predict_machine")
def q_predict_machine(spark, d):
    """M8: the ten most frequent machines as labels, FS16 scaled, 50 trees."""
    top = R.top_machine_tasks(lin(spark, d), 10)
    return M.predict_label(top, "machine_id", FS16, scaled=True, num_trees=50, max_depth=5)


@register("sample_predictions")
def q_sample_predictions(spark, d):
    """Ten actual-vs-predicted heat pairs, in a stated order, with residual."""
    p = M.predict_regression(lin(spark, d), "heat")
    p = p.withColumn("residual", F.col("heat") - F.col("prediction"))
    return p.orderBy(*[F.col(c) for c in p.columns]).limit(10)


@register("model_scores")
def q_model_scores(spark, d):
    return M.model_scores(lin(spark, d))


# ---- what of the fitted models SQL can say: the rows, labels and label indices of the test side ----

_TEST_SIDE = "('0x' || substr(md5(CAST(sl_no AS VARCHAR)), 1, 4))::INTEGER % 100 >= 80"

for _label in ("heat", "energy", "duration"):
    def _rows(spark, d, label=_label):
        """The test side of the fitted regression: every row once, with its label and a prediction."""
        p = M.predict_regression(lin(spark, d), label)
        return r6(p.select("sl_no", "machine_id", F.col(label).cast("double").alias("label"),
                           F.col("prediction").isNotNull().alias("predicted")))

    register(f"predict_{_label}_rows", W(T_, L_, body=f"""
SELECT sl_no, machine_id, round(CAST({_label} AS DOUBLE), 6) AS label, true AS predicted FROM lin WHERE {_TEST_SIDE}"""))(_rows)


@register("predict_failure_rows", W(T_, L_, body=f"""
SELECT sl_no, machine_id, CAST(failed AS DOUBLE) AS label, true AS predicted FROM lin WHERE {_TEST_SIDE}"""))
def q_predict_failure_rows(spark, d):
    p = M.predict_failure(lin(spark, d))
    ok = F.col("prediction").isin(0.0, 1.0) & F.col("score").between(0, 1)
    return p.select("sl_no", "machine_id", F.col("failed").alias("label"), ok.alias("predicted"))


for _label in ("collection_type", "scheduling_class", "priority"):
    def _rows(spark, d, label=_label):
        """The test side of the fitted classifier, with label indices over the whole table."""
        p = M.predict_label(lin(spark, d), label)
        return p.select("sl_no", F.col(label).cast("string").alias("label"), F.col(f"{label}_idx").alias("label_idx"),
                        (F.col("prediction") >= 0).alias("predicted"))

    register(f"predict_{_label}_rows", W(T_, L_, body=f"""
SELECT sl_no, CAST(lin.{_label} AS VARCHAR) AS label, label_idx, true AS predicted
FROM lin JOIN (SELECT {_label}, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({_label} AS VARCHAR)) - 1 AS DOUBLE)
                 AS label_idx FROM lin GROUP BY {_label}) i ON lin.{_label} = i.{_label}
WHERE {_TEST_SIDE}"""))(_rows)


_LABELS = ["heat", "energy", "duration"]


@register("linear_fit_check", W(T_, L_, body=f"""
SELECT label, term, rows, 0.0 AS correlation
FROM (SELECT count(*) AS rows FROM lin WHERE NOT ({_TEST_SIDE})),
     (SELECT unnest({_LABELS}) AS label), (SELECT unnest({["intercept", *FS12]}) AS term)"""))
def q_linear_fit_check(spark, d):
    """M5: the fits of heat, energy and duration solve the normal equations on their training side.

    Mean zero and no covariance with any feature is what makes a fit the least-squares one.
    """
    train, _ = M.hash_split(lin(spark, d))
    return r6(M.normal_equations(train, M.least_squares(train, FS12, _LABELS)))


@register("linear_fit_single", W(T_, L_, body=" UNION ALL ".join(f"""
SELECT '{y}' AS label, '{x}' AS feature, count(*) AS rows, round(regr_r2({y}, {x}), 6) AS r2,
  round(regr_slope({y}, {x}) * stddev_pop({x}) / stddev_pop({y}), 6) AS slope,
  round((regr_intercept({y}, {x}) - avg({y})) / stddev_pop({y}), 6) AS offset
FROM lin WHERE NOT ({_TEST_SIDE})""" for y in _LABELS for x in FS12)))
def q_linear_fit_single(spark, d):
    """M5 with one feature at a time, slope and intercept in units of the columns' spreads; one pass for all."""
    train, _ = M.hash_split(lin(spark, d))
    m = M.moments(train, {c: F.col(c) for c in [*FS12, *_LABELS]})
    rows = []
    for x in FS12 if m else ():
        for y in _LABELS:
            (i, j), fit = m.of([x, y]), M.solve(m, [x], y)
            sx, sy = m.cov[i, i] ** 0.5, m.cov[j, j] ** 0.5
            rows.append((y, x, m.n, fit.r2, float(fit.coefficients[0] * sx / sy), float((fit.intercept - m.mean[j]) / sy)))
    return r6(spark.createDataFrame(rows, "label string, feature string, rows long, r2 double, slope double, offset double"))


@register("model_comparison", W(T_, L_, _PRED_SQL, _CANDIDATES_SQL, f"long AS ({_long('q', 'task, model')})", body="""
SELECT task, model, round(max(value) FILTER (metric = 'rmse'), 6) AS rmse,
  round(max(value) FILTER (metric = 'mae'), 6) AS mae, round(max(value) FILTER (metric = 'r2'), 6) AS r2
FROM long GROUP BY task, model"""))
def q_model_comparison(spark, d):
    """Models down, metrics across."""
    return r6(M.compare_models(candidate_metrics(spark, d), ["rmse", "mae", "r2"]))


@register("feature_presence", W(T_, L_, body=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, true AS present, count({c}) AS non_null FROM lin" for c in FS12)
    + " UNION ALL SELECT 'gpu_usage', false, 0"))
def q_feature_presence(spark, d):
    """P10: one row per wanted feature; a missing one is reported with no values."""
    df = lin(spark, d)
    have, missing = C.present_features(df, FS12 + ["gpu_usage"])
    rows = [F.struct(F.lit(c).alias("feature"), F.lit(True).alias("present"), F.col(c).alias("non_null")) for c in have]
    rows += [F.struct(F.lit(c).alias("feature"), F.lit(False).alias("present"), F.lit(0).cast("long").alias("non_null"))
             for c in missing]
    return df.agg(*[F.count(c).alias(c) for c in have]).select(F.explode(F.array(*rows)).alias("f")).select("f.*")
