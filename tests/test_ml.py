"""Metric aggregates agree with the pyspark.ml evaluators; fitted models within bounds."""

import numpy as np
import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator,
)
from pyspark.sql import functions as F

import __spark_entry__ as E
from heatwise.operators import ml as M
from heatwise.plans import catalog as K
from heatwise.plans.registry import rule_class_prediction


@pytest.fixture(scope="module")
def lin(spark, sf_dir):
    return K.lin(spark, sf_dir).cache()


def test_regression_metrics_equal_evaluator(lin):
    pred = lin.withColumn("prediction", F.col("cpu_usage_distribution") * 100 + 10)
    got = M.regression_metrics(pred, "heat").first()
    for name in ("rmse", "mae", "r2"):
        want = RegressionEvaluator(labelCol="heat", metricName=name).evaluate(pred)
        assert got[name] == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_classification_metrics_equal_evaluator(lin):
    pred = lin.withColumn("label", F.col("scheduling_class").cast("double")) \
              .withColumn("prediction", rule_class_prediction())
    got = M.classification_metrics(pred, "label").first()
    names = {"accuracy": "accuracy", "f1": "f1", "weighted_precision": "weightedPrecision",
             "weighted_recall": "weightedRecall"}
    for ours, theirs in names.items():
        want = MulticlassClassificationEvaluator(labelCol="label", metricName=theirs).evaluate(pred)
        assert got[ours] == pytest.approx(want, rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("buckets", [1, 7, 1024])
def test_auc_exact_equals_evaluator(lin, buckets):
    data = lin.withColumn("label", F.col("failed").cast("double"))
    got = M.auc(data, "label", "cpu_usage_distribution", buckets).first().auc
    want = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="cpu_usage_distribution",
                                         numBins=0).evaluate(data)
    assert got == pytest.approx(want, abs=1e-12)


def test_hash_split_is_stable_and_80_20(lin):
    tr, te = M.hash_split(lin)
    n_tr, n_te = tr.count(), te.count()
    assert n_tr + n_te == lin.count()
    assert 0.75 < n_tr / (n_tr + n_te) < 0.85
    assert tr.join(te, "sl_no", "left_semi").count() == 0


def test_best_models_keeps_ties(spark):
    m = spark.createDataFrame([("t", "a", "rmse", 1.0), ("t", "b", "rmse", 1.0), ("t", "c", "rmse", 2.0),
                               ("t", "a", "r2", 0.1), ("t", "c", "r2", 0.3)], "task string, model string, metric string, value double")
    got = {(r.metric, r.model) for r in M.best_models(m).collect()}
    assert got == {("rmse", "a"), ("rmse", "b"), ("r2", "c")}


def test_predict_heat_bounds(spark, sf_dir):
    p = E.queries()["predict_heat"](spark, sf_dir)
    m = M.regression_metrics(p, "heat").first()
    sd = p.select(F.stddev("heat")).first()[0]
    assert m.n > 0 and m.rmse < sd


def test_predict_failure_bounds(spark, sf_dir):
    p = E.queries()["predict_failure"](spark, sf_dir)
    a = M.auc(p, "failed", "score").first().auc
    assert p.count() > 0 and 0.0 <= a <= 1.0


def test_missing_label_gives_empty(lin):
    assert M.predict_label(lin.drop("priority"), "priority").count() == 0


def test_predict_class_labels_indexed(spark, sf_dir):
    p = E.queries()["predict_class"](spark, sf_dir)
    assert p.count() > 0
    assert p.filter(F.col("prediction") < 0).count() == 0


def test_trees_do_not_depend_on_the_session():
    for make in (*M.REGRESSORS.values(), *M.CLASSIFIERS.values()):
        model = make("y")
        if model.hasParam("maxMemoryInMB"):
            assert model.getMaxMemoryInMB() == M.TREE_MEMORY_MB


def test_a_label_of_the_test_side_only_is_kept(spark, lin):
    rare = lin.withColumn("priority", F.when(~M.split_flag("sl_no") & (F.col("sl_no") % 7 == 0), 99).otherwise(F.col("priority")))
    p = M.predict_label(rare, "priority")
    want = rare.where(~M.split_flag("sl_no"))
    assert p.count() == want.count() and p.where("priority = 99").count() == want.where("priority = 99").count() > 0


def test_null_metric_is_never_best(spark):
    rows = [("t", "a", "rmse", 1.0), ("t", "b", "rmse", None), ("t", "c", "r2", float("nan")), ("t", "a", "r2", 0.5)]
    best = M.best_models(spark.createDataFrame(rows, "task string, model string, metric string, value double"))
    assert {(r.metric, r.model) for r in best.collect()} == {("rmse", "a"), ("r2", "a")}


def test_class_metrics_read_their_input_once(spark):
    pred = spark.range(10).selectExpr("CAST(id % 3 AS double) AS l", "CAST(id % 2 AS double) AS prediction")
    plan = M.classification_metrics(pred, "l")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1


def _plain_fit(rows, k):
    x = np.array([[1.0, *r[:k]] for r in rows])
    return np.linalg.lstsq(x, np.array([r[k:] for r in rows]), rcond=None)[0]


def test_least_squares_is_exact(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(500, 3)) * [1, 1e4, 1e-3] + [5, 1e6, 0]
    y = np.stack([x @ [2.0, -0.5, 30.0] + 7 + rnd.normal(size=500), rnd.normal(size=500)], axis=1)
    rows = [tuple(map(float, r)) for r in np.hstack([x, y])]
    want = _plain_fit(rows, 3)
    for parts in (1, 9):
        df = spark.createDataFrame(rows, "a double, b double, c double, y double, z double").repartition(parts)
        fits = M.least_squares(df, ["a", "b", "c"], ["y", "z"])
        for i, label in enumerate(("y", "z")):
            got = [fits[label].intercept, *fits[label].coefficients]
            assert np.allclose(got, want[:, i], rtol=1e-6, atol=1e-9) and fits[label].rank == 3
        got = M.normal_equations(df, fits).collect()
        assert len(got) == 8 and all(abs(r.correlation) < 1e-9 and r.rows == 500 for r in got)


def test_dependent_and_constant_columns(spark):
    rnd = np.random.default_rng(4)
    a = rnd.normal(size=300)
    rows = [(float(v), float(2 * v + 1), 4.0, float(3 * v + rnd.normal())) for v in a]
    df = spark.createDataFrame(rows, "a double, twice double, fixed double, y double")
    fit = M.least_squares(df, ["a", "twice", "fixed"], ["y"])["y"]
    alone = M.least_squares(df, ["a"], ["y"])["y"]
    assert fit.rank == 1 and fit.coefficients[2] == 0
    assert abs(fit.coefficients[0] - 2 * fit.coefficients[1]) < 1e-8  # equal shares of the standardised columns
    got = df.select(F.max(F.abs(fit.predict() - alone.predict()))).first()[0]
    assert got < 1e-8 and abs(fit.r2 - alone.r2) < 1e-9


def test_least_squares_edges(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 2.0), (2.0, float("nan")), (3.0, 5.0), (float("inf"), 1.0)], "a double, y double")
    fit = M.least_squares(df, ["a"], ["y"])["y"]
    assert fit.n == 2 and abs(fit.coefficients[0] - 2) < 1e-12 and abs(fit.intercept + 1) < 1e-12
    assert M.least_squares(df.limit(0), ["a"], ["y"]) == {}
    flat = M.least_squares(df.withColumn("y", F.lit(2.0)), ["a"], ["y"])["y"]
    assert flat.coefficients == (0.0,) and flat.intercept == 2.0


def test_all_linear_keys_at_more_rows(spark):
    """The fits hold beyond the smallest tables too."""
    import duckdb

    import __spark_entry__ as E
    from tests._compare import assert_same

    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    for key in ("linear_fit_check", "linear_fit_single"):
        assert_same(E.queries()[key](spark, folder).toPandas(), con.execute(E.oracle_sql()[key]).df())


def test_training_sides_come_in_small_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "TRAIN_PART_BYTES", 1000, raising=False)
    spark.range(20_000).selectExpr("id AS sl_no", "CAST(id % 7 AS double) AS a", "CAST(id % 11 AS double) AS b", "id % 3 AS y").coalesce(1) \
        .write.option("maxRecordsPerFile", 1000).parquet(f"{tmp_path}/t")
    key = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(key)
    train, test = M._prepared(spark.read.parquet(f"{tmp_path}/t"), ["a", "b"], ["y"])
    try:
        rows = [r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(rows) + test.count() == 20_000
        assert max(rows) <= 1000
        assert spark.conf.get(key) == was
    finally:
        train.unpersist()


def test_deep_forests_keep_node_ids_and_their_trees(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("id AS sl_no", "CAST(id * 37 % 101 AS double) AS a", "CAST(id * 53 % 89 AS double) AS b",
                                        "CAST(id * 37 % 101 * (id * 53 % 89) % 4 AS int) AS y")
    seen, fit = [], M.RandomForestClassifier._fit

    def spy(self, train):
        seen.append((self.getMaxDepth(), self.getCacheNodeIds(), self.getMaxMemoryInMB()))
        return fit(self, train)

    monkeypatch.setattr(M.RandomForestClassifier, "_fit", spy)

    def predicted():
        p = M.predict_label(rows, "y", ["a", "b"], scaled=True, num_trees=5, max_depth=10)
        return sorted(map(tuple, p.collect()))

    cached = predicted()
    M.predict_label(rows, "y", ["a", "b"], num_trees=2)
    monkeypatch.setattr(M, "NODE_ID_DEPTH", 31, raising=False)
    assert predicted() == cached and len({r[3] for r in cached}) > 1
    assert seen == [(10, True, M.TREE_MEMORY_MB), (5, False, M.TREE_MEMORY_MB), (10, False, M.TREE_MEMORY_MB)]
