"""Sources and sinks: legacy header, absent report, text extraction, results document."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatwise.operators import clean as C
from heatwise.sinks import writers as K
from heatwise.sources import files as S
from heatwise.sources import star


def test_sl_no_renamed_before_dropna(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 3.0)], "`SL.No` int, x double")
    out = C.drop_incomplete(df)
    assert out.columns == ["sl_no", "x"] and out.count() == 1


def test_drop_incomplete_equals_dropna(spark, sf_dir):
    t = star.tasks_from_star(spark, sf_dir)
    nan = t.withColumn("maximum_usage", F.when(F.col("sl_no") % 13 == 0, F.lit(float("nan")))
                       .otherwise(F.col("maximum_usage")))
    assert C.drop_incomplete(nan).count() == nan.dropna().count()
    assert C.drop_incomplete(nan, ["machine_id"]).count() == nan.dropna(subset=["machine_id"]).count()


def test_absent_report_is_empty(spark, tmp_path):
    schema = T.StructType([T.StructField("machine_id", T.LongType()), T.StructField("Tasks", T.LongType())])
    df = S.read_report_csv(spark, str(tmp_path / "nope"), schema)
    assert df.count() == 0 and df.schema == schema


def test_metric_text_extraction(spark, tmp_path):
    lines = ["AUC Score (Failure): 0.4890", "RMSE (Duration): 6595493.0749", "Avg CPU Usage (%): 72.85",
             "12.5 590.77", "no numbers"]
    p = tmp_path / "m.txt"
    p.write_text("\n".join(lines) + "\n")
    got = {r.value: r.score for r in S.extract_score(S.read_lines(spark, str(p))).collect()}
    assert got == {"AUC Score (Failure): 0.4890": 0.489, "RMSE (Duration): 6595493.0749": 6595493.0749,
                   "Avg CPU Usage (%): 72.85": 72.85, "12.5 590.77": 590.77, "no numbers": None}
    pairs = [(r.time, r.approx_heat) for r in S.extract_number_pairs(S.read_lines(spark, str(p))).collect()]
    assert pairs == [(12.5, 590.77)]
    only = S.extract_score(S.read_lines(spark, str(p)), "Duration").collect()
    assert [r.score for r in only] == [6595493.0749]


def test_report_csv_display_names(spark, tmp_path):
    df = spark.createDataFrame([(1, 3, 11.5, 0.2, 50.0)], "machine_id long, tasks long, avg_heat double, "
                                                         "energy double, failure_rate_pct double")
    K.write_report(df, str(tmp_path / "top"), "top_machines")
    back = spark.read.option("header", True).csv(str(tmp_path / "top"))
    assert back.columns == ["machine_id", "Tasks", "Avg Heat", "Energy", "Failure Rate (%)"]


def test_csv_sink_fails_if_present(spark, tmp_path):
    df = spark.range(3)
    K.write_csv(df, str(tmp_path / "x"))
    try:
        K.write_csv(df, str(tmp_path / "x"))
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e).lower() or "path" in str(e).lower()
    else:
        raise AssertionError("second write should fail")


def test_heat_log_csv_round_trip(spark, sf_dir, tmp_path):
    from heatwise.operators import telemetry as TM
    m = TM.measured_heat(TM.samples_from_events(star.read_table(spark, sf_dir, "events")))
    K.write_heat_log(m, str(tmp_path / "heat"))
    back = spark.read.option("header", True).schema(m.schema).csv(str(tmp_path / "heat"))
    assert back.exceptAll(m).count() == 0 and m.exceptAll(back).count() == 0


def test_typed_csv_is_bound_by_name(spark, scratch):
    import os

    from heatwise.schema import TASKS
    from heatwise.sources.files import read_tasks_csv

    os.makedirs(f"{scratch}/named")
    with open(f"{scratch}/named/a.csv", "w") as f:
        f.write("user,assigned_memory,average_usage_cpu,SL.No\nx,0.9,0.04,7\ny,bad,,8\n")
    df = read_tasks_csv(spark, f"{scratch}/named")
    assert df.columns == TASKS.fieldNames()
    rows = {r.sl_no: r for r in df.collect()}
    assert (rows[7].average_usage_cpu, rows[7].assigned_memory, rows[7].machine_id) == (0.04, 0.9, None)
    assert rows[8].assigned_memory is None and rows[8].average_usage_cpu is None
