"""The data behind the charts, as aggregates (V1-V4)."""

from __future__ import annotations

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heatwise.session import shared_dir

QUARTILES = [0.0, 0.25, 0.5, 0.75, 1.0]


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """V1: equal-width histogram of ``value`` between its min and max.

    The bounds are one scalar subquery (a single min/max aggregate, reused for
    both), so the table is never collected or cross-joined; the bin counts are an
    ordinary aggregate.
    """
    bounds = df.select(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    width = (hi - lo) / bins
    raw_bin = F.floor(F.try_divide(F.col(value) - lo, width)).cast("int")
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(raw_bin, F.lit(bins - 1)))
    return (df.filter(F.col(value).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("machines"))
            .select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_end"), "machines"))


def box_stats(df: DataFrame, value: str) -> DataFrame:
    """V2: exact min, quartiles and max (linear interpolation)."""
    q = F.percentile(F.col(value), F.array(*[F.lit(p) for p in QUARTILES]))
    return df.agg(q.alias("q")).select(
        *[F.col("q")[i].alias(n) for i, n in enumerate(["min", "q1", "median", "q3", "max"])])


def approx_box_stats(df: DataFrame, value: str, accuracy: int = 10000) -> DataFrame:
    """V2 for groups too large for an exact percentile: bounded-memory sketch."""
    q = F.percentile_approx(F.col(value), QUARTILES, accuracy)
    return df.agg(q.alias("q")).select(
        *[F.col("q")[i].alias(n) for i, n in enumerate(["min", "q1", "median", "q3", "max"])])


BOX = ["min", "q1", "median", "q3", "max"]
#: Distinct values that one task ranks at most, about.
RANGE_VALUES = 100_000


def group_box_stats(df: DataFrame, value: str, group: list[str], range_values: int = RANGE_VALUES) -> DataFrame:
    """V2 per group, exact: (group…, n, min, q1, median, q3, max) by distributed rank selection.

    Values are collapsed to (group, value, count), so copies of a value are one row.  The
    distinct values are cut into ranges of about ``range_values`` (approximate quantiles;
    only the borders reach the driver); a running count inside (group, range) plus the
    counts of the ranges before it is each value's rank, and the values that hold the
    wanted ranks are picked by one aggregate.  No task holds the values of a group.
    Quartiles between two values are interpolated.  Null and NaN values do not count; a
    group without others is left out.  A null group is a group.
    """
    rows = df.select(*[F.col(f"`{c}`").alias(f"g{i}") for i, c in enumerate(group)], F.col(f"`{value}`").cast("double").alias("v"))
    keys = [f"g{i}" for i in range(len(group))]
    shared_dir(df.sparkSession)
    counts = (rows.filter(F.col("v").isNotNull() & ~F.isnan("v")).groupBy(*keys, "v")
              .agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True))
    ranges = -(-counts.count() // range_values)
    if ranges > 1:
        cut = QuantileDiscretizer(inputCol="v", outputCol="b", numBuckets=ranges, relativeError=0.1 / ranges)
        counts = cut.fit(counts).transform(counts).withColumn("b", F.col("b").cast("int"))
    else:
        counts = counts.withColumn("b", F.lit(0))
    per_group = Window.partitionBy(*keys)
    before = F.sum("bn").over(per_group.orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (counts.groupBy(*keys, "b").agg(F.sum("n").alias("bn"))
               .select(*keys, "b", F.coalesce(before, F.lit(0)).alias("offset"), F.sum("bn").over(per_group).alias("total")))
    inside = Window.partitionBy(*keys, "b").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("c")
    same = F.col("c.b") == F.col("o.b")
    for k in keys:
        same = same & F.col(f"c.{k}").eqNullSafe(F.col(f"o.{k}"))
    ranked = ranked.join(offsets.alias("o"), same).select(
        *[F.col(f"c.{k}").alias(k) for k in keys], "v", "n", "total", (F.col("offset") + F.col("inside")).alias("first"))

    def held(rank):
        return F.max(F.when((F.col("first") <= rank) & (rank < F.col("first") + F.col("n")), F.col("v")))

    wanted = [F.col("total") - 1 if q == 1.0 else F.lit(q) * (F.col("total") - 1) for q in QUARTILES]
    picked = ranked.groupBy(*keys).agg(
        F.max("total").alias("total"),
        *[e.alias(f"{side}{i}") for i, r in enumerate(wanted) for side, e in (("lo", held(F.floor(r))), ("hi", held(F.ceil(r))))])
    at = [F.lit(q) * (F.col("total") - 1) for q in QUARTILES]
    return picked.select(
        *[F.col(k).alias(c) for k, c in zip(keys, group)], F.col("total").alias("n"),
        *[(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (r - F.floor(r))).alias(name)
          for i, (r, name) in enumerate(zip(at, BOX))])


def box_sketches(df: DataFrame, value: str, group: list[str], k: int = 800) -> DataFrame:
    """V2's mergeable form: (group…, sketch), a KLL sketch of bounded size per group.

    Sketches of parts of a table (days, files, batches) merge without the rows; the rank
    error falls as 1 / ``k`` (about half a per cent at 800).
    """
    v = F.col(f"`{value}`").cast("double")
    return (df.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*[F.col(f"`{c}`") for c in group])
            .agg(F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch")))


def merge_box_sketches(sketches: DataFrame, group: list[str]) -> DataFrame:
    """Sketches of the same group as one."""
    return sketches.groupBy(*[F.col(f"`{c}`") for c in group]).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def box_of_sketches(sketches: DataFrame, group: list[str]) -> DataFrame:
    """(group…, n, min, q1, median, q3, max) as the sketches estimate them (values that occur, not interpolated)."""
    return sketches.select(
        *[F.col(f"`{c}`") for c in group], F.kll_sketch_get_n_double("sketch").alias("n"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name) for q, name in zip(QUARTILES, BOX)])


def shares(rollup: DataFrame, dimensions=("class", "collection_type")) -> DataFrame:
    """V3: each key's share of its dimension's tasks.

    Runs on the rollup (one row per key), so the per-dimension window sees few rows.
    """
    w = Window.partitionBy("dimension")
    return (rollup.filter(F.col("dimension").isin(list(dimensions)))
            .select("dimension", "key", F.col("count").alias("tasks"),
                    (F.col("count") / F.sum("count").over(w)).alias("share")))


def unpivot_row(wide: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """V4: a wide summary row as (metric, value) rows."""
    cols = wide.columns
    cast = wide.select([F.col(c).cast("double").alias(c) for c in cols])
    return cast.unpivot([], cols, name, value)
