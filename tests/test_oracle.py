"""Every registered query with an oracle equals DuckDB on the same parquet (sf0.001)."""

import pytest

import __spark_entry__ as E
from tests._compare import assert_same

SQL = E.oracle_sql()


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, duck, sf_dir, key):
    got = E.queries()[key](spark, sf_dir).toPandas()
    want = duck.execute(SQL[key]).df()
    assert_same(got, want)


def test_every_survey_key_registered():
    keys = set(E.queries())
    sql_checked = {
        "scan_csv_typed", "scan_csv_strings", "head_rows", "results_envelope", "results_json_roundtrip",
        "extract_score", "extract_number_pairs", "report_text", "metric_lines", "measured_heat", "clean_dropna",
        "clean_dropna_subset", "parse_tasks", "rejected_tasks", "failures_by_cluster", "top_machine_tasks",
        "feature_columns", "results_by_dimension", "derive_linear", "derive_machine", "derive_dimension_heat",
        "derive_composite", "event_counts", "failures_by_user", "memory_by_collection", "avg_memory_by_event",
        "failure_ratio_by_priority", "avg_duration_by_collection", "logs_by_user", "constraint_usage",
        "failures_by_class", "machine_start_times", "failures_by_memory", "reducer_suite", "priority_report",
        "class_report", "collection_report", "machine_report", "overall_report", "composite_rollup",
        "category_count", "overall_summary", "top_machines_linear", "class_linear", "collection_linear",
        "priority_linear", "failure_over_time", "label_balance", "confusion_matrix", "failure_outcome_counts",
        "top_machines_composite", "top_frequent_machines", "best_models", "memory_histogram", "cpu_box_stats",
        "task_share", "overall_unpivot", "features_assembled", "label_index", "features_scaled",
        "train_test_split", "regression_metrics", "classification_metrics", "auc_metric", "stream_rollup",
        "stream_heat_windows"}
    rows_only = {"sample_predictions", "predict_heat", "predict_energy", "predict_duration", "predict_failure",
                 "predict_collection_type", "predict_class", "predict_priority", "predict_machine", "model_scores"}
    assert sql_checked <= set(SQL), sorted(sql_checked - set(SQL))
    assert (sql_checked | rows_only) <= keys, sorted((sql_checked | rows_only) - keys)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["machine_id", "tasks", "avg_heat", "energy", "failure_rate_pct"]
