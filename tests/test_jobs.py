"""The batch job writes every report folder with the expected headers."""

from heatwise.jobs.reports import write_all_reports


def test_write_all_reports(spark, sf_dir, tmp_path):
    out = str(tmp_path / "out")
    names = write_all_reports(spark, sf_dir, out, models=True)
    assert {"overall_summary", "top_machines", "results", "heat_log", "metrics",
            "failure_prediction", "priority_classification"} <= set(names)
    summary = spark.read.option("header", True).csv(f"{out}/overall_summary")
    assert summary.columns[:3] == ["Total Tasks", "Avg CPU Usage", "Peak CPU"] and summary.count() == 1
    top = spark.read.option("header", True).csv(f"{out}/top_machines")
    assert top.columns == ["machine_id", "Tasks", "Avg Heat", "Energy", "Failure Rate (%)"]
    import glob
    text = open(glob.glob(f"{out}/top_machines_txt/part-*")[0]).read().splitlines()
    assert text[0].split()[:3] == ["machine_id", "tasks", "avg_heat"] and len(text) == top.count() + 1
    heats = [float(t.split()[2]) for t in text[1:]]
    assert heats == sorted(heats, reverse=True)
    lines = [r.value for r in spark.read.text(f"{out}/metrics").collect()]
    assert any(v.startswith("AUC Score (Failure): ") for v in lines)
    assert sum(v.startswith("RMSE (") for v in lines) == 3 and sum(v.startswith("Accuracy (") for v in lines) == 3
