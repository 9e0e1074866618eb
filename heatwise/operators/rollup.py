"""Composite multi-dimension rollup (C1-C3), its views and top-k.

Each task feeds up to five keys (machine, class, collection type, priority,
overall).  Instead of emitting five keyed copies per row and shuffling them, the
rollup is one grouping-sets aggregate: Spark expands the projected measures in
memory, aggregates partially before the exchange and shuffles only partial sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatwise.schema import DIMENSION_PREFIX, DIMENSION_VIEWS

# (dimension name, key column), in grouping order.
DIMENSIONS = [("machine", "machine_id"), ("class", "scheduling_class"),
              ("collection_type", "collection_type"), ("priority", "priority")]

METRICS = ["count", "avg_cpu_usage", "avg_max_cpu", "avg_memory", "avg_memory_usage",
           "avg_heat_generation", "total_energy_consumption", "avg_duration", "total_heat",
           "failure_rate", "failed_tasks"]


def _gid(i: int) -> int:
    """grouping_id() of the set that groups only the i-th key."""
    n = len(DIMENSIONS)
    return (1 << n) - 1 - (1 << (n - 1 - i))


def rollup_sums(derived: DataFrame) -> DataFrame:
    """C1's mergeable form: (dimension, key, sums and counts) for every non-blank key and overall."""
    keys = [k for _, k in DIMENSIONS]
    sets = [[k] for k in keys] + [[]]
    g = derived.groupingSets(sets, *keys).agg(
        F.count(F.lit(1)).alias("count"),
        F.sum("eff_cpu").alias("s_cpu"),
        F.sum("maximum_usage").alias("s_max_cpu"),
        F.sum("assigned_memory").alias("s_memory"),
        F.sum("eff_mem").alias("s_memory_usage"),
        F.sum("heat").alias("s_heat"),
        F.sum("energy").alias("s_energy"),
        F.sum("duration").alias("s_duration"),
        F.sum("failed").cast("bigint").alias("failed_tasks"),
        F.grouping_id().alias("gid"),
    )
    dim = F.lit("overall")
    key = F.lit(None).cast("string")
    for i, (name, col) in reversed(list(enumerate(DIMENSIONS))):
        dim = F.when(F.col("gid") == _gid(i), F.lit(name)).otherwise(dim)
        key = F.when(F.col("gid") == _gid(i), F.col(col)).otherwise(key)
    out = g.select(dim.alias("dimension"), key.alias("key"), *[c for c in g.columns if c not in (*keys, "gid")])
    # A null key of a non-overall set comes from a blank key: not emitted.
    return out.filter((F.col("dimension") == "overall") | F.col("key").isNotNull())


def merge_sums(a: DataFrame, b: DataFrame) -> DataFrame:
    """The sums of two disjoint sets of tasks as those of both."""
    both = a.unionByName(b)
    return both.groupBy("dimension", "key").agg(
        *[F.sum(c).alias(c) for c in both.columns if c not in ("dimension", "key")]).select(*both.columns)


def finish(sums: DataFrame) -> DataFrame:
    """The eleven metrics out of sums and counts."""
    n = F.col("count")
    return sums.select(
        "dimension", "key", n.alias("count"),
        (F.col("s_cpu") / n).alias("avg_cpu_usage"),
        (F.col("s_max_cpu") / n).alias("avg_max_cpu"),
        (F.col("s_memory") / n).alias("avg_memory"),
        (F.col("s_memory_usage") / n).alias("avg_memory_usage"),
        (F.col("s_heat") / n).alias("avg_heat_generation"),
        F.col("s_energy").alias("total_energy_consumption"),
        (F.col("s_duration") / n).alias("avg_duration"),
        F.col("s_heat").alias("total_heat"),
        (F.col("failed_tasks") / n * 100).alias("failure_rate"),
        F.col("failed_tasks"),
    )


def composite_rollup(derived: DataFrame) -> DataFrame:
    """(dimension, key, 11 metrics) for every non-blank key and overall."""
    return finish(rollup_sums(derived))


def with_result_key(rollup: DataFrame) -> DataFrame:
    """Keys of the results document: ``machine_<id>``, ``class_<n>``, …, ``overall``."""
    prefix = F.lit(None).cast("string")
    for name, p in DIMENSION_PREFIX.items():
        prefix = F.when(F.col("dimension") == name, F.lit(p)).otherwise(prefix)
    rk = F.when(F.col("dimension") == "overall", F.lit("overall")).otherwise(F.concat(prefix, F.col("key")))
    return rollup.withColumn("result_key", rk)


def dimension_view(entries: DataFrame, dimension: str) -> DataFrame:
    """One dimension out of results entries (result_key, metrics…).

    Entries are selected by key prefix and the prefix is stripped at the start of
    the id only; rows are ordered by the id as text.
    """
    prefix = DIMENSION_PREFIX[dimension]
    sel = entries.filter(F.col("result_key").startswith(prefix)).withColumn(
        "key", F.regexp_replace("result_key", "^" + prefix, ""))
    cols = [F.col(src).alias(shown) for src, shown in DIMENSION_VIEWS[dimension]]
    return sel.orderBy(F.col("key").cast("string")).select(cols)


def category_count(rollup: DataFrame) -> DataFrame:
    """Number of non-overall keys."""
    return rollup.filter(F.col("dimension") != "overall").agg(F.count(F.lit(1)).alias("categories"))


def top_machines_composite(rollup: DataFrame, n: int = 10) -> DataFrame:
    """The n machines with the highest average composite heat, id breaks ties."""
    if not 1 <= n:
        raise ValueError("n must be positive")
    return (rollup.filter(F.col("dimension") == "machine")
            .orderBy(F.desc("avg_heat_generation"), F.asc("key")).limit(n))
