"""Batch job: every report of the library written to one output folder.

    python -m heatwise.jobs.reports SF_DIR OUT_DIR [--models]
    python -m heatwise.jobs.reports TRACE_CSV OUT_DIR --trace [--models]

Writes the five summary reports as single CSVs with display names and as aligned
text, the composite results document (JSON lines), the measured-heat log, and with
``--models`` the prediction samples and metric lines of the fitted models.  From a trace
file (or folder of them) the same reports but the heat log, and the rejected lines.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatwise.operators import clean as C
from heatwise.operators import ml as M
from heatwise.operators import reports as R
from heatwise.operators import rollup as U
from heatwise.operators import telemetry as TM
from heatwise.session import scratch_path
from heatwise.sinks import writers as K
from heatwise.sources import files as S
from heatwise.sources import star

# output name → (report function over the linear table, display-name set)
SUMMARIES = {
    "overall_summary": (R.overall_summary, "overall_summary"),
    "top_machines": (lambda lin: R.top_machines_linear(lin, 10), "top_machines"),
    "scheduling_class_analysis": (R.class_linear, "scheduling_class_analysis"),
    "collection_type_analysis": (R.collection_linear, "collection_type_analysis"),
    "priority_analysis": (R.priority_linear, "priority_analysis"),
}


def _ordered_sample(df, n):
    return df.orderBy(*[F.col(c) for c in df.columns]).limit(n)


def write_trace_reports(spark: SparkSession, trace: str, out: str, models: bool = False) -> list[str]:
    """Every report of a trace CSV, from its lines; ``rejected`` holds the lines that are no task rows.

    The accepted rows are written once and read by all reports.
    """
    out = out.rstrip("/")
    good, bad = S.read_tasks_csv_checked(spark, trace)
    K.write_csv(bad, f"{out}/rejected", mode="overwrite")
    path = scratch_path(spark, "trace-tasks")
    good.write.parquet(path)
    typed = spark.read.schema(good.schema).parquet(path)
    return ["rejected"] + write_reports(C.linear_tasks(typed), star.strings_of(typed), out, models)


def write_all_reports(spark: SparkSession, sf_dir: str, out: str, models: bool = False) -> list[str]:
    out = out.rstrip("/")
    heat = TM.measured_heat(TM.samples_from_events(star.read_table(spark, sf_dir, "events")))
    K.write_heat_log(heat, f"{out}/heat_log", mode="overwrite")
    raw = star.strings_of(star.land(spark, sf_dir, "tasks"))
    return ["heat_log"] + write_reports(star.land(spark, sf_dir, "linear"), raw, out, models)


def write_reports(lin: DataFrame, raw: DataFrame, out: str, models: bool = False) -> list[str]:
    """The reports of a linear task table and of the same trace as strings."""
    written = []
    for name, (fn, display) in SUMMARIES.items():
        rep = fn(lin)
        K.write_report(rep, f"{out}/{name}", display)
        K.write_table_text(rep, f"{out}/{name}_txt")
        written += [name, f"{name}_txt"]

    entries = U.with_result_key(U.composite_rollup(C.with_composite(C.parse_composite(raw))))
    K.write_results(entries, raw.select(F.count(F.lit(1))).scalar(), list(raw.columns), f"{out}/results")
    written.append("results")

    if models:
        lines = []
        for label in ("heat", "energy", "duration"):
            pred = M.predict_regression(lin, label)
            K.write_report(_ordered_sample(pred.select("machine_id", label, "prediction"), 10),
                           f"{out}/{label}_prediction")
            lines.append(M.regression_metrics(pred, label).select(
                F.format_string("RMSE (%s): %.4f", F.initcap(F.lit(label)), F.col("rmse")).alias("value")))
            written.append(f"{label}_prediction")
        fail = M.predict_failure(lin)
        K.write_report(_ordered_sample(fail.select("machine_id", "failed", "prediction"), 10),
                       f"{out}/failure_prediction")
        lines.append(M.auc(fail, "failed", "score").select(
            F.format_string("AUC Score (Failure): %.4f", F.col("auc")).alias("value")))
        written.append("failure_prediction")
        for label in ("priority", "collection_type", "scheduling_class"):
            pred = M.predict_label(lin, label)
            K.write_report(_ordered_sample(pred.select(label, "prediction"), 5), f"{out}/{label}_classification")
            lines.append(M.classification_metrics(pred, f"{label}_idx").select(
                F.format_string("Accuracy (%s): %.4f", F.lit(label), F.col("accuracy")).alias("value")))
            written.append(f"{label}_classification")
        metrics = lines[0]
        for part in lines[1:]:
            metrics = metrics.unionByName(part)
        K.write_text(metrics.coalesce(1), f"{out}/metrics")
        written.append("metrics")
    return written


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("source", help="folder of the star tables, or the trace file with --trace")
    ap.add_argument("out_dir")
    ap.add_argument("--trace", action="store_true")
    ap.add_argument("--models", action="store_true")
    args = ap.parse_args()
    from heatwise.session import build_session
    spark = build_session()
    write = write_trace_reports if args.trace else write_all_reports
    for name in write(spark, args.source, args.out_dir, args.models):
        print(name)
    spark.stop()


if __name__ == "__main__":
    main()
