"""Shapes that stress distribution: a hot key, all-tied scores, a single host."""

from pyspark.sql import functions as F

from heatwise.operators import clean as C
from heatwise.operators import ml as M
from heatwise.operators import rollup as U
from heatwise.plans import catalog as K


def test_rollup_with_hot_machine_equals_separate_aggregates(spark, sf_dir):
    raw = K.dirty(spark, sf_dir)
    hot = raw.withColumn("machine_id", F.when(F.col("sl_no").cast("long") % 3 == 0, F.lit("hot"))
                         .otherwise(F.col("machine_id")))
    d = C.with_composite(C.parse_composite(hot))
    got = K.r6(U.composite_rollup(d)).select("dimension", "key", "count", "total_heat", "failed_tasks")
    parts = []
    for dim, col in U.DIMENSIONS:
        parts.append(d.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("key"))
                     .agg(F.count(F.lit(1)).alias("count"), F.sum("heat").alias("total_heat"),
                          F.sum("failed").cast("bigint").alias("failed_tasks"))
                     .select(F.lit(dim).alias("dimension"), "key", "count", "total_heat", "failed_tasks"))
    parts.append(d.agg(F.count(F.lit(1)).alias("count"), F.sum("heat").alias("total_heat"),
                       F.sum("failed").cast("bigint").alias("failed_tasks"))
                 .select(F.lit("overall").alias("dimension"), F.lit(None).cast("string").alias("key"),
                         "count", "total_heat", "failed_tasks"))
    want = parts[0]
    for p in parts[1:]:
        want = want.unionByName(p)
    want = K.r6(want)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    top = got.filter((F.col("dimension") == "machine") & (F.col("key") == "hot")).first()
    assert top["count"] >= d.count() // 4


def test_auc_all_tied_and_separated(spark):
    tied = spark.range(1000).select((F.col("id") % 2).alias("y"), F.lit(0.3).alias("s"))
    assert M.auc(tied, "y", "s").first().auc == 0.5
    sep = spark.range(1000).select((F.col("id") % 2).alias("y"), (F.col("id") % 2 + F.rand(7) * 0.5).alias("s"))
    assert M.auc(sep, "y", "s").first().auc == 1.0


def test_approx_box_stats_close_to_exact(spark):
    from heatwise.operators import charts as V
    df = spark.range(100_000).select((F.col("id") % 997 / 10.0).alias("x"))
    exact = V.box_stats(df, "x").first()
    approx = V.approx_box_stats(df, "x").first()
    assert approx["min"] == exact["min"] and approx["max"] == exact["max"]
    for k in ("q1", "median", "q3"):
        assert abs(approx[k] - exact[k]) <= 0.2
