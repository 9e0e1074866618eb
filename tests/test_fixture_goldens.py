"""Golden numbers on the 8-row dirty trace (blank keys, bad number, zero and negative
durations, flag spellings), worked out by hand from the formulas."""

import pytest
from pyspark.sql import functions as F

from heatwise.operators import clean as C
from heatwise.operators import reports as R
from heatwise.operators import rollup as U
from heatwise.sources import files as S

CSV = """sl_no,start_time,end_time,machine_id,collection_id,scheduling_class,collection_type,priority,event,failed,user,cluster,constraint,assigned_memory,average_usage_cpu,avg_usage_memory,maximum_usage,maximum_usage_memory,random_sample_usage_cpu,random_sample_usage_memory,cycles_per_instruction,memory_accesses_per_instruction,cpu_usage_distribution
1,0,1800,m1,c1,0,1,2,FINISH,0,u1,k1,a,0.02,0.04,0.004,0.06,0.008,0.02,0.006,1.0,0.5,0.06
2,0,7200,m1,c1,1,1,10,FAIL,1,u1,k1,a,0.04,0.08,0.002,0.09,0,0,0.004,2.0,0,0
3,500,500,m2,c2,0,0,2,FAIL,true,u2,k1,b,0.01,0,0,0.05,0,0,0,1.5,1.0,0
4,900,300,m2,c2,,0,0,EVICT,Yes,u2,k2,b,,0.05,0.005,0.07,0.01,0.03,0.003,0,0.2,0.01
5,0,3600,,c3,1,1,2,FINISH,0,u3,k2,a,0.03,0.06,0.006,0.08,0.009,0.03,0.003,1.0,0.1,0.03
6,0,3600,m3,c3,1,1,,FINISH,no,u3,k2,,0.03,-0.01,0.006,0.08,-0.2,0.03,0.003,1.0,0.1,0.03
7,0,3600,m3,c3,1,1,2,FINISH,0,u3,k2,a,abc,0.06,0.006,0.08,0.009,0.03,0.003,1.0,0.1,0.03
8,10,1810,m3,c1,2,0,10, FAIL ,TRUE,u1,k1,b,0.05,,0.001,0.02,0.002,,0.003,0.5,,
"""

COMPOSITE = {  # sl_no: duration, eff_cpu, eff_mem, heat, energy, failed
    "1": (1800, 0.04, 0.006, 2.2, 1.44e-06, 0),
    "2": (7200, 0.08, 0.003, 8.2, 2.304e-05, 1),
    "3": (0, 0, 0, 0.15, 0, 1),
    "4": (0, 0.03, 0.006, 0.306, 0, 1),
    "6": (3600, 0.03, 0.0045, 3.13, 3.24e-06, 0),
    "8": (1800, 0, 0.002, 0.05, 0, 1),
}

ROLLUP = {  # (dimension, key): count, avg_cpu, avg_max_cpu, avg_memory, avg_mem_usage, avg_heat, energy, avg_dur, fail %
    ("machine", "m1"): (2, 0.06, 0.075, 0.03, 0.0045, 5.2, 2.448e-05, 4500, 50),
    ("machine", "m2"): (2, 0.015, 0.06, 0.005, 0.003, 0.228, 0, 0, 100),
    ("machine", "m3"): (2, 0.015, 0.05, 0.04, 0.00325, 1.59, 3.24e-06, 2700, 50),
    ("class", "0"): (2, 0.02, 0.055, 0.015, 0.003, 1.175, 1.44e-06, 900, 50),
    ("class", "1"): (2, 0.055, 0.085, 0.035, 0.00375, 5.665, 2.628e-05, 5400, 50),
    ("class", "2"): (1, 0, 0.02, 0.05, 0.002, 0.05, 0, 1800, 100),
    ("collection_type", "0"): (3, 0.01, 0.046667, 0.02, 0.002667, 0.168667, 0, 600, 100),
    ("collection_type", "1"): (3, 0.05, 0.076667, 0.03, 0.0045, 4.51, 2.772e-05, 4200, 33.3333),
    ("priority", "0"): (1, 0.03, 0.07, 0, 0.006, 0.306, 0, 0, 100),
    ("priority", "2"): (2, 0.02, 0.055, 0.015, 0.003, 1.175, 1.44e-06, 900, 50),
    ("priority", "10"): (2, 0.04, 0.055, 0.045, 0.0025, 4.125, 2.304e-05, 4500, 100),
    ("overall", None): (6, 0.03, 0.061667, 0.025, 0.003583, 2.339333, 2.772e-05, 2400, 66.6667),
}


def close(a, b, tol=1e-4):
    return abs(a - b) <= tol * max(1.0, abs(b)) if abs(b) >= 1e-3 else abs(a - b) <= 1e-6


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    p = tmp_path_factory.mktemp("fixture") / "trace.csv"
    p.write_text(CSV)
    return S.read_strings_csv(spark, str(p))


def test_composite_rows(raw):
    rows = {r.sl_no: r for r in C.with_composite(C.parse_composite(raw)).collect()}
    assert set(rows) == set(COMPOSITE)
    for k, (dur, cpu, mem, heat, energy, failed) in COMPOSITE.items():
        r = rows[k]
        got = (r.duration, r.eff_cpu, r.eff_mem, r.heat, r.energy)
        for g, w in zip(got, (dur, cpu, mem, heat, energy)):
            assert close(g, w), (k, got)
        assert r.failed == failed


def test_rejected_rows(raw):
    got = {r.sl_no: r.reason for r in C.rejected_composite(raw).collect()}
    assert got == {"5": "no machine", "7": "bad number"}


def test_rollup_goldens(raw):
    out = U.composite_rollup(C.with_composite(C.parse_composite(raw))).collect()
    got = {(r.dimension, r.key): r for r in out}
    assert set(got) == set(ROLLUP)
    for k, want in ROLLUP.items():
        r = got[k]
        vals = (r["count"], r.avg_cpu_usage, r.avg_max_cpu, r.avg_memory, r.avg_memory_usage,
                r.avg_heat_generation, r.total_energy_consumption, r.avg_duration, r.failure_rate)
        for g, w in zip(vals, want):
            assert close(g, w), (k, vals)
        assert abs(r.total_heat - r["count"] * r.avg_heat_generation) < 1e-9


def _rows(df, key):
    return {(r[key] if key else None): r for r in df.collect()}


def test_single_dimension_reports(raw):
    b1 = _rows(R.priority_report(raw), "priority")
    assert {k: (r.tasks, round(r.avg_cpu, 6), round(r.avg_heat, 6), round(r.failure_rate, 4)) for k, r in b1.items()} == {
        "0": (1, 0.05, 0.09, 100.0), "2": (4, 0.04, 0.072, 25.0), "10": (2, 0.04, 0.072, 100.0)}
    b2 = _rows(R.class_report(raw), "scheduling_class")
    assert {k: (r.tasks, round(r.avg_cpu, 6), round(r.avg_heat, 6), round(r.failure_rate, 4)) for k, r in b2.items()} == {
        "0": (2, 0.02, 0.04, 50.0), "1": (4, 0.0475, 0.095, 25.0), "2": (1, 0.0, 0.0, 100.0)}
    b3 = _rows(R.collection_report(raw), "collection_type")
    assert {k: (r.tasks, round(r.avg_memory_usage, 6), round(r.avg_heat, 6)) for k, r in b3.items()} == {
        "0": (3, 0.002, 0.003), "1": (5, 0.0048, 0.0072)}
    b4 = _rows(R.machine_report(raw), "machine_id")
    assert {k: (r.tasks, round(r.avg_cpu, 6), round(r.avg_memory, 6), round(r.avg_heat, 6),
                round(r.total_energy, 12), round(r.failure_rate, 4)) for k, r in b4.items()} == {
        "m1": (2, 0.06, 0.03, 0.9, 2.448e-05, 50.0), "m2": (2, 0.025, 0.005, 0.0, 0.0, 100.0),
        "m3": (2, -0.005, 0.04, -0.05, -1.08e-06, 50.0)}
    b5 = R.overall_report(raw).first()
    assert (b5.tasks, round(b5.avg_cpu, 9), round(b5.avg_memory, 9), round(b5.avg_heat, 9),
            round(b5.total_energy, 12), round(b5.failure_rate, 4)) == (
        7, 0.031428571, 0.025714286, 0.316666667, 2.988e-05, 57.1429)


def test_views_order_keys_as_text(raw):
    entries = U.with_result_key(U.composite_rollup(C.with_composite(C.parse_composite(raw))))
    view = U.dimension_view(entries, "priority").collect()
    assert [r["Priority"] for r in view] == ["0", "10", "2"]
    assert U.category_count(U.composite_rollup(C.with_composite(C.parse_composite(raw)))).first()[0] == 11


def test_grouping_ids(raw):
    d = C.with_composite(C.parse_composite(raw))
    keys = ["machine_id", "scheduling_class", "collection_type", "priority"]
    g = d.groupingSets([[k] for k in keys] + [[]], *keys).agg(F.grouping_id().alias("g"))
    assert sorted({r.g for r in g.collect()}) == [7, 11, 13, 14, 15]


def test_prefix_stripped_only_at_start(spark):
    rows = [("machine_m1", 1), ("machine_xmachine_2", 2), ("class_machine_3", 3), ("overall", 4)]
    entries = spark.createDataFrame(rows, "result_key string, count long").withColumns(
        {c: F.lit(0.0) for c in ("avg_cpu_usage", "avg_max_cpu", "avg_memory", "avg_memory_usage",
                                 "avg_heat_generation", "total_energy_consumption", "avg_duration",
                                 "failure_rate")}).withColumn("failed_tasks", F.lit(0).cast("long"))
    got = [r["Machine ID"] for r in U.dimension_view(entries, "machine").collect()]
    assert got == ["m1", "xmachine_2"]
