"""Keyed reports.

Every report is one hash aggregate: Spark computes partial aggregates before the
shuffle, so a hot key costs one partial row per map task instead of its rows.

* A1-A13: counts, sums and averages over the string trace;
* B1-B5: single-dimension heat reports over the dirty trace, each quarantining
  only the rows whose numbers it reads;
* R1-R9: reports over the typed, null-free path with the linear score.
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatwise.functions import derive as D
from heatwise.functions import parse as P
from heatwise.session import shared_dir


def _strict_number(c: str) -> Column:
    """`float(x or 0)`: absent/empty → 0, otherwise an ANSI cast (malformed text fails)."""
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("0")).cast("double")


def _strict_duration() -> Column:
    return P.strict_int("end_time") - P.strict_int("start_time")


# ---- A13: the reducer library -------------------------------------------------

# Over a column's rows, or with ``n`` over the rows of a list report, where a value occurs n times.
REDUCERS = {
    "sum": lambda c, n=None: F.sum(c if n is None else c * n),
    "count": lambda c, n=None: F.count(F.lit(1)) if n is None else F.sum(n),
    "avg": lambda c, n=None: F.coalesce(F.avg(c) if n is None else F.sum(c * n) / F.sum(F.when(c.isNotNull(), n)),
                                        F.lit(0.0)),
    "max": lambda c, n=None: F.max(c),
    "min": lambda c, n=None: F.min(c),
}


def report(df: DataFrame, key, measure, reducer: str, name: str | None = None) -> DataFrame:
    """Generic keyed report: ``groupBy(key).agg(reducer(measure))``.

    ``reducer`` is one of sum, count, avg (0 for an empty group), max, min or list.
    ``list`` returns the values of each key as a multiset in long form
    (key, value, occurrences): a key can hold a large share of all rows, so its
    values are never gathered into one row.
    """
    measure = F.col(measure) if isinstance(measure, str) else measure
    name = name or reducer
    if reducer == "list":
        return df.groupBy(key, measure.alias("value")).agg(F.count(F.lit(1)).alias("occurrences"))
    if reducer not in REDUCERS:
        raise ValueError(f"unknown reducer {reducer!r}; choose from {sorted(REDUCERS) + ['list']}")
    return df.groupBy(key).agg(REDUCERS[reducer](measure).alias(name))


# ---- A1-A12 over the string trace ---------------------------------------------

def event_counts(s: DataFrame) -> DataFrame:
    return report(s, "event", F.lit(1), "count", "count")


def failures_by_cluster(s: DataFrame) -> DataFrame:
    return report(s, "cluster", P.strict_int("failed"), "sum", "failures")


def failures_by_user(s: DataFrame) -> DataFrame:
    return report(s, "user", P.strict_int("failed"), "sum", "failures")


def memory_by_collection(s: DataFrame) -> DataFrame:
    return report(s, "collection_id", _strict_number("assigned_memory"), "sum", "memory")


def avg_memory_by_event(s: DataFrame) -> DataFrame:
    return report(s, "event", _strict_number("assigned_memory"), "avg", "avg_memory")


def failure_ratio_by_priority(s: DataFrame) -> DataFrame:
    return report(s, "priority", P.strict_int("failed"), "avg", "avg_failures")


def avg_duration_by_collection(s: DataFrame) -> DataFrame:
    return report(s, "collection_id", _strict_duration(), "avg", "avg_duration")


def logs_by_user(s: DataFrame) -> DataFrame:
    return report(s, "user", F.lit(1), "count", "log_count")


def constraint_usage(s: DataFrame) -> DataFrame:
    return report(s, "constraint", F.lit(1), "count", "count")


def failures_by_class(s: DataFrame) -> DataFrame:
    return report(s, "scheduling_class", P.strict_int("failed"), "sum", "failures")


def machine_start_times(s: DataFrame) -> DataFrame:
    """Start times per machine, as (machine_id, start_time, occurrences)."""
    return report(s, "machine_id", F.col("start_time"), "list").withColumnRenamed("value", "start_time")


def failures_by_memory(s: DataFrame) -> DataFrame:
    """Failures keyed by assigned memory (absent → 0)."""
    return (s.groupBy(_strict_number("assigned_memory").alias("assigned_memory"))
            .agg(F.sum(P.strict_int("failed")).alias("failures"),
                 F.avg(P.strict_int("failed")).alias("failure_ratio"),
                 F.count(F.lit(1)).alias("tasks")))


def reducer_suite(s: DataFrame) -> DataFrame:
    """All six reducers on one measure (duration) per event, one pass over the trace.

    The list report comes first: the durations of an event are its rows, each with the number
    of its occurrences.  The scalars are reduced from it and stand in every row of their event.
    A null event is an event.
    """
    listed = report(s, "event", _strict_duration(), "list")
    c, n = F.col("value"), F.col("occurrences")
    scalars = listed.groupBy(F.col("event").alias("of")).agg(*[
        REDUCERS[r](c, n).alias(f"duration_{r}") for r in ("sum", "count", "avg", "max", "min")])
    return (listed.withColumnRenamed("value", "duration_list")
            .join(scalars, F.col("event").eqNullSafe(F.col("of")))
            .select("event", *scalars.columns[1:], "duration_list", "occurrences"))


# ---- B1-B5 over the dirty trace -----------------------------------------------

def _keyed(raw: DataFrame, key: str, numbers: list[str]) -> DataFrame:
    return raw.filter(P.clean_key(key).isNotNull() & P.all_good(numbers)) \
              .withColumn(key, P.clean_key(key))


def priority_report(raw: DataFrame) -> DataFrame:
    """B1: tasks, avg_cpu, avg_heat (H2), failure_rate % per priority."""
    t = _keyed(raw, "priority", ["average_usage_cpu"])
    cpu = P.number_or_zero("average_usage_cpu")
    return t.groupBy("priority").agg(
        F.count(F.lit(1)).alias("tasks"), F.avg(cpu).alias("avg_cpu"),
        F.avg(D.heat_priority(cpu)).alias("avg_heat"),
        (F.avg(P.failed_flag("failed")) * 100).alias("failure_rate"))


def class_report(raw: DataFrame) -> DataFrame:
    """B2: tasks, avg_cpu, avg_heat (H3), failure_rate % per scheduling class."""
    t = _keyed(raw, "scheduling_class", ["average_usage_cpu"])
    cpu = P.number_or_zero("average_usage_cpu")
    return t.groupBy("scheduling_class").agg(
        F.count(F.lit(1)).alias("tasks"), F.avg(cpu).alias("avg_cpu"),
        F.avg(D.heat_class(cpu)).alias("avg_heat"),
        (F.avg(P.failed_flag("failed")) * 100).alias("failure_rate"))


def collection_report(raw: DataFrame) -> DataFrame:
    """Tasks, avg_memory_usage, avg_heat (H4) per collection type."""
    t = _keyed(raw, "collection_type", ["avg_usage_memory"])
    mem = P.number_or_zero("avg_usage_memory")
    return t.groupBy("collection_type").agg(
        F.count(F.lit(1)).alias("tasks"), F.avg(mem).alias("avg_memory_usage"),
        F.avg(D.heat_collection(mem)).alias("avg_heat"))


_RUNTIME_NUMBERS = ["average_usage_cpu", "assigned_memory", "end_time", "start_time"]


def _runtime_metrics(t: DataFrame, clamp: bool) -> list[Column]:
    cpu = P.number_or_zero("average_usage_cpu")
    mem = P.number_or_zero("assigned_memory")
    start, end = P.number_or_zero("start_time"), P.number_or_zero("end_time")
    dur = D.duration_clamped(start, end) if clamp else D.duration_raw(start, end)
    return [
        F.count(F.lit(1)).alias("tasks"), F.avg(cpu).alias("avg_cpu"), F.avg(mem).alias("avg_memory"),
        F.avg(D.heat_runtime(cpu, dur)).alias("avg_heat"),
        F.sum(D.energy_memory(cpu, mem, dur)).alias("total_energy"),
        (F.avg(P.failed_flag("failed")) * 100).alias("failure_rate"),
    ]


def machine_report(raw: DataFrame) -> DataFrame:
    """Per machine, clamped duration (D2), H5, E2."""
    t = _keyed(raw, "machine_id", _RUNTIME_NUMBERS)
    return t.groupBy("machine_id").agg(*_runtime_metrics(t, clamp=True))


def overall_report(raw: DataFrame) -> DataFrame:
    """All rows (blank machine ids kept), raw duration (D1), H5, E2."""
    t = raw.filter(P.all_good(_RUNTIME_NUMBERS))
    return t.agg(*_runtime_metrics(t, clamp=False))


# ---- R1-R9 over the typed path with the linear score ---------------------------

def _failure_pct() -> Column:
    return (F.avg(F.col("failed").cast("double")) * 100).alias("failure_rate_pct")


def overall_summary(lin: DataFrame) -> DataFrame:
    """R1 (``Peak CPU`` is the mean of maximum_usage, as reported)."""
    return lin.agg(
        F.count(F.lit(1)).alias("total_tasks"),
        F.avg("average_usage_cpu").alias("avg_cpu_usage"),
        F.avg("maximum_usage").alias("peak_cpu"),
        F.avg("assigned_memory").alias("assigned_memory"),
        F.avg("avg_usage_memory").alias("memory_usage"),
        F.avg("heat").alias("avg_heat"),
        F.sum("energy").alias("total_energy"),
        F.avg("duration").alias("avg_duration"),
        F.sum("heat").alias("total_heat"),
        _failure_pct())


def machines_linear(lin: DataFrame) -> DataFrame:
    """R2: per machine tasks, avg heat, energy, failure rate."""
    return lin.groupBy("machine_id").agg(
        F.count(F.lit(1)).alias("tasks"), F.avg("heat").alias("avg_heat"),
        F.sum("energy").alias("energy"), _failure_pct())


def top_machines_linear(lin: DataFrame, n: int = 10) -> DataFrame:
    """R2 + T1: the n machines with the highest average linear heat (id breaks ties)."""
    return machines_linear(lin).orderBy(F.desc("avg_heat"), F.asc("machine_id")).limit(n)


def class_linear(lin: DataFrame) -> DataFrame:
    """R3."""
    return lin.groupBy("scheduling_class").agg(
        F.count(F.lit(1)).alias("tasks"), F.avg("average_usage_cpu").alias("cpu"),
        F.avg("heat").alias("heat"), _failure_pct())


def collection_linear(lin: DataFrame) -> DataFrame:
    """R4."""
    return lin.groupBy("collection_type").agg(
        F.count(F.lit(1)).alias("tasks"), F.avg("heat").alias("heat"),
        F.avg("avg_usage_memory").alias("memory_usage"))


def priority_linear(lin: DataFrame) -> DataFrame:
    """R5 + T6: ordered by priority number."""
    return lin.groupBy("priority").agg(
        F.count(F.lit(1)).alias("tasks"), F.avg("heat").alias("heat"), _failure_pct()).orderBy("priority")


def failure_over_time(lin: DataFrame) -> DataFrame:
    """Failure rate per start time, in time order."""
    return lin.groupBy("start_time").agg(F.count(F.lit(1)).alias("tasks"), _failure_pct()).orderBy("start_time")


def top_frequent_machines(lin: DataFrame, n: int = 10) -> DataFrame:
    """T4: the n machines with most tasks (id breaks ties)."""
    return (lin.groupBy("machine_id").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("machine_id")).limit(n))


def top_machine_tasks(lin: DataFrame, n: int = 10) -> DataFrame:
    """Tasks of the n most frequent machines.

    The list has exactly n rows, so broadcasting it is bounded; the semi join
    replaces collecting ids to the driver and an IN-list.
    """
    top = top_frequent_machines(lin, n).select("machine_id")
    return lin.join(F.broadcast(top), "machine_id", "left_semi")


def label_balance(tasks: DataFrame, label: str = "machine_id") -> DataFrame:
    """Rows per frequency-ordered label index (StringIndexer, ties by label text)."""
    idx = StringIndexer(inputCol=label, outputCol="label", stringOrderType="frequencyDesc").fit(tasks)
    return idx.transform(tasks).groupBy("label").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"))


def confusion_matrix(pred: DataFrame, label: str, prediction: str, values: list) -> DataFrame:
    """Labels down, predictions across (value list given, so no extra pass)."""
    return (pred.groupBy(F.col(label).cast("string").alias(f"{label}_{prediction}"))
            .pivot(prediction, values).agg(F.count(F.lit(1))).fillna(0))


def outcome_counts(pred: DataFrame, label: str = "failed", prediction: str = "prediction") -> DataFrame:
    """Counts per (label, prediction), keys as text."""
    return pred.groupBy(F.col(label).cast("string").alias(label),
                        F.col(prediction).cast("string").alias(prediction)).agg(F.count(F.lit(1)).alias("count"))


def top_keys(df: DataFrame, key: str, n: int, buckets: int = 1 << 16) -> DataFrame:
    """T1-T4 for keys without bound: the n most frequent keys (key, count), ties by key, exact.

    The first pass counts rows by a hash of the key, ``buckets`` sums that merge and are
    all that is shuffled; a bucket's sum is at least the count of every key in it.  The
    second counts the keys of the n fullest buckets: at least n keys (or all) have the
    count of their n-th one, c.  A key with a count of c or more lies in a bucket with a
    sum of c or more, so the third pass counts the keys of those buckets only, and none of
    the first n is lost.  The fewer keys stand out, the more buckets are counted; in the
    end it is the plain aggregate.  A null key is a key.
    """
    if n < 1:
        raise ValueError("n must be positive")
    k = F.col(f"`{key}`")
    rows = df.select(k.alias("key"), F.pmod(F.xxhash64(k), F.lit(buckets)).alias("bucket"))
    shared_dir(df.sparkSession)
    sums = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).checkpoint(eager=True)

    def counted(some: DataFrame) -> DataFrame:
        keep = rows.join(F.broadcast(some.select("bucket")), "bucket", "left_semi")  # at most ``buckets`` numbers
        return keep.groupBy("key").agg(F.count(F.lit(1)).alias("count"))

    first = counted(sums.orderBy(F.desc("rows"), "bucket").limit(n)).orderBy(F.desc("count")).limit(n)
    least = first.agg(F.when(F.count(F.lit(1)) < n, F.lit(0)).otherwise(F.min("count")).alias("c")).first()["c"]
    found = counted(sums.filter(F.col("rows") >= least))
    return found.orderBy(F.desc("count"), F.asc("key")).limit(n).select(F.col("key").alias(key), "count")
