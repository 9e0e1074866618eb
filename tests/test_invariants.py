"""Invariants that hold between the reports."""

import pytest
from pyspark.sql import functions as F

from heatwise.operators import reports as R
from heatwise.operators import rollup as U
from heatwise.plans import catalog as K


@pytest.fixture(scope="module")
def lin(spark, sf_dir):
    return K.lin(spark, sf_dir)


def test_linear_reports_add_up(lin):
    total = R.overall_summary(lin).first()
    for rep, key in ((R.class_linear(lin), "scheduling_class"), (R.priority_linear(lin), "priority"),
                     (R.collection_linear(lin), "collection_type")):
        rows = rep.collect()
        assert sum(r.tasks for r in rows) == total.total_tasks
        assert sum(r.tasks * r.heat for r in rows) == pytest.approx(total.total_heat, rel=1e-9)
    for rep in (R.class_linear(lin), R.priority_linear(lin)):
        rows = rep.collect()
        weighted = sum(r.tasks * r.failure_rate_pct for r in rows) / total.total_tasks
        assert weighted == pytest.approx(total.failure_rate_pct, rel=1e-9)
    assert total.avg_heat == pytest.approx(100 * total.avg_cpu_usage + 10, rel=1e-12)
    for r in R.class_linear(lin).collect():
        assert r.heat == pytest.approx(100 * r.cpu + 10, rel=1e-12)


def test_rollup_dimensions_add_up(spark, sf_dir):
    roll = K.rollup(spark, sf_dir)
    overall = roll.filter(F.col("dimension") == "overall").first()
    sums = {r.dimension: (r.n, r.heat, r.failed)
            for r in roll.groupBy("dimension").agg(F.sum("count").alias("n"), F.sum("total_heat").alias("heat"),
                                                   F.sum("failed_tasks").alias("failed")).collect()}
    assert sums["machine"][0] == overall["count"]          # every parsed row has a machine
    assert sums["collection_type"][0] == overall["count"]  # never blank in the trace
    for dim in ("class", "priority"):                        # blank keys are not emitted
        assert 0 < overall["count"] - sums[dim][0] < overall["count"] * 0.05
    assert sums["machine"][1] == pytest.approx(overall.total_heat, rel=1e-9)
    assert sums["machine"][2] == overall.failed_tasks


def test_top_machines_are_the_hottest(spark, sf_dir, lin):
    top = R.top_machines_linear(lin, 10).collect()
    rest = R.machines_linear(lin).filter(~F.col("machine_id").isin([r.machine_id for r in top]))
    hottest_rest = rest.agg(F.max("avg_heat")).first()[0]
    assert hottest_rest is None or hottest_rest <= min(r.avg_heat for r in top)
    comp = U.top_machines_composite(K.rollup(spark, sf_dir), 5).collect()
    assert [r.avg_heat_generation for r in comp] == sorted((r.avg_heat_generation for r in comp), reverse=True)
