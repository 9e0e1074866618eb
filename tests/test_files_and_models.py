"""Rejected lines at the source, score files, trace jobs, and models judged together."""

import os

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatwise.jobs.reports import write_trace_reports
from heatwise.operators import ml as M
from heatwise.sinks import writers as K
from heatwise.sources import files as S
from heatwise.sources import star

SCHEMA = T.StructType([T.StructField("sl_no", T.LongType()), T.StructField("event", T.StringType()),
                       T.StructField("assigned_memory", T.DoubleType()), T.StructField("failed", T.IntegerType())])


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("\n".join(lines) + "\n")


def test_every_line_is_accepted_or_rejected(spark, scratch):
    write(f"{scratch}/t/a.csv", "SL.No,event,assigned_memory,extra", "1,x,0.5,", "2,y", '3,"open,0.5,e', "4,z,abc,e", "", "   ",
          '5,"a ""quoted"", one",1e-3,e', "6,,,", "7, ,  ,é", "8,x,0.5,e,more", "nine,x,0.5,e", '10,"q"x,0.5,e')
    write(f"{scratch}/t/b.csv", "SL.No,event,assigned_memory,extra", "11,x,NaN,e")
    write(f"{scratch}/t/c.csv", "SL.No,event,assigned_memory,extra")
    good, bad = S.read_tasks_csv_checked(spark, f"{scratch}/t", SCHEMA, escape='"')
    assert good.schema == SCHEMA
    rows = {r.sl_no: r for r in good.collect()}
    assert set(rows) == {1, 5, 6, 7, 11}
    assert rows[5].event == 'a "quoted", one' and rows[5].assigned_memory == 0.001 and rows[5].failed is None
    assert rows[6].event is None and rows[6].assigned_memory is None and rows[7].assigned_memory is None
    out = {r.line.split(",")[0]: (r.file, r.reason, r.field) for r in bad.collect()}
    assert out == {"2": ("a.csv", "fields", None), "3": ("a.csv", "quotes", None), "4": ("a.csv", "value", "assigned_memory"),
                   "8": ("a.csv", "fields", None), "nine": ("a.csv", "value", "SL.No"), "10": ("a.csv", "quotes", None)}


def test_other_headers_are_refused(spark, scratch):
    write(f"{scratch}/h/a.csv", "sl_no,event", "1,x")
    write(f"{scratch}/h/b.csv", "event,sl_no", "x,1")
    good, _ = S.read_tasks_csv_checked(spark, f"{scratch}/h", SCHEMA)
    with pytest.raises(Exception, match="(?i)header"):
        good.collect()


def test_no_lines(spark, scratch):
    write(f"{scratch}/e/a.csv", "sl_no,event")
    good, bad = S.read_tasks_csv_checked(spark, f"{scratch}/e", SCHEMA)
    assert good.count() == 0 and bad.count() == 0 and good.schema == SCHEMA


def test_first_match_of_each_file(spark, scratch):
    long = [f"line {i} without the word" for i in range(3000)]
    write(f"{scratch}/s/rmse_heat.txt", "RMSE: none yet", "MAE: 9.5", "RMSE (heat): 1.25", "RMSE (again): 7.5")
    write(f"{scratch}/s/rmse energy+1%.txt", *long, "RMSE 3 of 4.5", *long, "RMSE: 8.5")
    write(f"{scratch}/s/other.txt", "RMSE: 99.5")
    write(f"{scratch}/s/folder.txt/part-00000-x.txt", "nothing")
    write(f"{scratch}/s/folder.txt/part-00001-x.txt", "AUC: 0.5", "AUC: 0.75")
    files = {"heat": ("rmse_heat.txt", "RMSE"), "energy": ("rmse energy+1%.txt", "RMSE"), "none": ("absent.txt", "RMSE"),
             "two": ("rmse_heat.txt", "MAE"), "parts": ("folder.txt", "AUC")}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # several byte ranges a file
    try:
        got = {r.task: r.score for r in S.read_scores(spark, f"{scratch}/s", files).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {"heat": 1.25, "energy": 4.5, "none": None, "two": 9.5, "parts": 0.5}
    assert {r.score for r in S.read_scores(spark, f"{scratch}/nowhere", files).collect()} == {None}


def test_reports_from_a_trace_file(spark, sf_dir, scratch):
    K.write_csv(star.land(spark, sf_dir, "tasks"), f"{scratch}/trace")
    write(f"{scratch}/trace/zz.csv", ",".join(star.land(spark, sf_dir, "tasks").columns), "1,2,3")
    names = write_trace_reports(spark, f"{scratch}/trace", f"{scratch}/out")
    assert {"rejected", "overall_summary", "top_machines", "results"} <= set(names)
    assert [r.reason for r in spark.read.option("header", True).csv(f"{scratch}/out/rejected").collect()] == ["fields"]
    total = spark.read.option("header", True).csv(f"{scratch}/out/overall_summary").first()["Total Tasks"]
    assert int(total) == star.land(spark, sf_dir, "linear").count()


@pytest.fixture(scope="module")
def judged(spark):
    few = {"regressors": {k: M.REGRESSORS[k] for k in ("LinearRegression", "DecisionTree")},
           "classifiers": {k: M.CLASSIFIERS[k] for k in ("LogisticRegression", "RandomForest")}}
    data = star.land(spark, "/root/testdata/sf0.001", "linear")
    return data, M.predict_models(data, **few)


def test_models_judged_together_equal_the_evaluators(judged):
    data, pred = judged
    test = M.hash_split(data)[1]
    assert pred.count() == test.count()
    got = {(r.task, r.model, r.metric): r.value for r in M.metrics_of_models(pred).collect()}
    assert len(got) == 3 * 2 * 3 + 2 * 5
    rows = pred.select(F.explode("models").alias("m")).select("m.*").persist()
    for task, model in {(t, m) for t, m, _ in got}:
        one = rows.where((F.col("task") == task) & (F.col("model") == model))
        if task == "failure_prediction":
            names = {"accuracy": "accuracy", "f1": "f1", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall"}
            for ours, theirs in names.items():
                want = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=theirs).evaluate(one)
                assert got[task, model, ours] == pytest.approx(want, abs=1e-12)
            want = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0).evaluate(one)
            assert got[task, model, "auc"] == pytest.approx(want, abs=1e-12)
        else:
            for name in ("rmse", "mae", "r2"):
                want = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName=name).evaluate(one)
                assert got[task, model, name] == pytest.approx(want, rel=1e-9, abs=1e-9)
    rows.unpersist()


def test_confusion_and_samples(judged):
    _, pred = judged
    n = pred.count()
    assert {r.model: r.n for r in M.confusion_of_models(pred).groupBy("model").agg(F.sum("count").alias("n")).collect()} == {
        "LogisticRegression": n, "RandomForest": n}
    few = M.sample_of_models(pred, 3).collect()
    assert len(few) == 3 * 8 and all(r.residual == r.actual - r.prediction for r in few)


def test_models_without_a_side(spark, sf_dir):
    data = star.land(spark, sf_dir, "linear")
    flag = M.split_flag("sl_no")
    for rows in (data.filter(flag), data.filter(~flag)):
        pred = M.predict_models(rows)
        assert pred.count() == 0 and M.metrics_of_models(pred).count() == 0


def test_auc_by_key_in_many_ranges(spark):
    rows = [(k, float((i * 37) % 200), int((i * 7 + k) % 3 == 0)) for k in range(3) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, s double, y int")
    both = {r.k: r.auc for r in M.auc(df, "y", "s", 16, keys=["k"]).collect()}
    for k, value in both.items():
        assert value == pytest.approx(M.auc(df.where(F.col("k") == k), "y", "s").first().auc, abs=1e-12)
    assert len(both) == 3
