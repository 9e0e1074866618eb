"""Registry of named queries: key → (Spark function, DuckDB oracle SQL or None).

Each Spark function takes (spark, sf_dir) and returns a lazy DataFrame over the
whole input tables (a few write a file round trip first).  Double results are
rounded to 6 places at the very end so that two engines that add in different
orders agree; the operators themselves compute unrounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatwise.operators import clean as C
from heatwise.operators import reports as R
from heatwise.operators import rollup as U
from heatwise.plans import oracle as O
from heatwise.schema import COMPOSITE_NUMBERS, DIMENSION_VIEWS
from heatwise.sources import star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = O.explicit_rounding(sql)
        return fn
    return deco


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (the comparison convention).

    Scaled rounding, ``round(x * 10^d) / 10^d``, half away from zero: the oracle
    SQL states the same expression, so a value both engines compute identically
    is rounded identically, also when ``x * 10^d`` lands on a half.
    """
    scale = float(10 ** digits)
    cols = []
    for f in df.schema.fields:
        c = df[f.name]
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c * scale, 0) / scale
        cols.append(c.alias(f.name))
    return df.select(cols)


# ---- shared inputs ------------------------------------------------------------

def tasks(spark, d):
    return star.land(spark, d, "tasks")


def lin(spark, d):
    return star.land(spark, d, "linear")


def strings(spark, d):
    """The clean string trace for one scan, derived on the fly: a report reads and casts only its columns."""
    return star.strings_of(star.tasks_once(spark, d))


def dirty(spark, d):
    return star.land(spark, d, "dirty")


def derived(spark, d):
    return C.with_composite(C.parse_composite(dirty(spark, d)))


def rollup(spark, d):
    return U.composite_rollup(derived(spark, d))


W = O.with_ctes
T_, L_, S_, D_, P_, C_, U_ = O.TASKS, O.LIN, O.STRINGS, O.DIRTY, O.PARSED, O.COMP, O.ROLLUP


# ---- step 1: linear reports -------------------------------------------------------

@register("overall_summary", W(T_, L_, body="""
SELECT count(*) AS total_tasks, round(avg(average_usage_cpu), 6) AS avg_cpu_usage,
  round(avg(maximum_usage), 6) AS peak_cpu, round(avg(assigned_memory), 6) AS assigned_memory,
  round(avg(avg_usage_memory), 6) AS memory_usage, round(avg(heat), 6) AS avg_heat,
  round(sum(energy), 6) AS total_energy, round(avg(duration), 6) AS avg_duration,
  round(sum(heat), 6) AS total_heat, round(avg(CAST(failed AS DOUBLE))*100, 6) AS failure_rate_pct
FROM lin"""))
def q_overall_summary(spark, d):
    return r6(R.overall_summary(lin(spark, d)))


_MACHINES_LINEAR = """SELECT machine_id, count(*) AS tasks, round(avg(heat), 6) AS avg_heat,
  round(sum(energy), 6) AS energy, round(avg(CAST(failed AS DOUBLE))*100, 6) AS failure_rate_pct
FROM lin GROUP BY machine_id"""


@register("top_machines_linear", W(T_, L_, body=f"""
SELECT * FROM ({_MACHINES_LINEAR}) ORDER BY avg_heat DESC, machine_id LIMIT 10"""))
def q_top_machines_linear(spark, d):
    return r6(R.top_machines_linear(lin(spark, d), 10))


@register("class_linear", W(T_, L_, body="""
SELECT scheduling_class, count(*) AS tasks, round(avg(average_usage_cpu), 6) AS cpu,
  round(avg(heat), 6) AS heat, round(avg(CAST(failed AS DOUBLE))*100, 6) AS failure_rate_pct
FROM lin GROUP BY scheduling_class"""))
def q_class_linear(spark, d):
    return r6(R.class_linear(lin(spark, d)))


@register("collection_linear", W(T_, L_, body="""
SELECT collection_type, count(*) AS tasks, round(avg(heat), 6) AS heat,
  round(avg(avg_usage_memory), 6) AS memory_usage
FROM lin GROUP BY collection_type"""))
def q_collection_linear(spark, d):
    return r6(R.collection_linear(lin(spark, d)))


@register("priority_linear", W(T_, L_, body="""
SELECT priority, count(*) AS tasks, round(avg(heat), 6) AS heat,
  round(avg(CAST(failed AS DOUBLE))*100, 6) AS failure_rate_pct
FROM lin GROUP BY priority ORDER BY priority"""))
def q_priority_linear(spark, d):
    return r6(R.priority_linear(lin(spark, d)))


@register("failure_over_time", W(T_, L_, body="""
SELECT start_time, count(*) AS tasks, round(avg(CAST(failed AS DOUBLE))*100, 6) AS failure_rate_pct
FROM lin GROUP BY start_time ORDER BY start_time"""))
def q_failure_over_time(spark, d):
    return r6(R.failure_over_time(lin(spark, d)))


@register("derive_linear", W(T_, L_, body="""
SELECT sl_no, machine_id, duration, round(heat, 6) AS heat, round(energy, 6) AS energy FROM lin"""))
def q_derive_linear(spark, d):
    return r6(lin(spark, d).select("sl_no", "machine_id", "duration", "heat", "energy"))


@register("clean_dropna", W(T_, body=f"""
SELECT count(*) AS rows_kept, CAST(sum(failed) AS BIGINT) AS failed_kept,
  count(DISTINCT machine_id) AS machines_kept
FROM tasks WHERE {O._NOT_NULL}"""))
def q_clean_dropna(spark, d):
    t = C.drop_incomplete(tasks(spark, d))
    return t.agg(F.count(F.lit(1)).alias("rows_kept"), F.sum("failed").cast("bigint").alias("failed_kept"),
                 F.countDistinct("machine_id").alias("machines_kept"))


@register("clean_dropna_subset", W(T_, body="""
SELECT sl_no, machine_id, scheduling_class, assigned_memory FROM tasks
WHERE machine_id IS NOT NULL AND scheduling_class IS NOT NULL"""))
def q_clean_dropna_subset(spark, d):
    t = C.drop_incomplete(tasks(spark, d), subset=["machine_id", "scheduling_class"])
    return r6(t.select("sl_no", "machine_id", "scheduling_class", "assigned_memory"))


# ---- step 2: keyed reports over the string trace ---------------------------------

def _s(body: str) -> str:
    return W(T_, S_, body=body)


@register("event_counts", _s('SELECT event, count(*) AS count FROM strings GROUP BY event'))
def q_event_counts(spark, d):
    return R.event_counts(strings(spark, d))


@register("failures_by_cluster", _s(
    'SELECT "cluster", CAST(sum(CAST(failed AS BIGINT)) AS BIGINT) AS failures FROM strings GROUP BY "cluster"'))
def q_failures_by_cluster(spark, d):
    return R.failures_by_cluster(strings(spark, d))


@register("failures_by_user", _s(
    'SELECT "user", CAST(sum(CAST(failed AS BIGINT)) AS BIGINT) AS failures FROM strings GROUP BY "user"'))
def q_failures_by_user(spark, d):
    return R.failures_by_user(strings(spark, d))


@register("memory_by_collection", _s(
    f"SELECT collection_id, round(sum({O.strict_num('assigned_memory')}), 6) AS memory "
    "FROM strings GROUP BY collection_id"))
def q_memory_by_collection(spark, d):
    return r6(R.memory_by_collection(strings(spark, d)))


@register("avg_memory_by_event", _s(
    f"SELECT event, round(avg({O.strict_num('assigned_memory')}), 6) AS avg_memory FROM strings GROUP BY event"))
def q_avg_memory_by_event(spark, d):
    return r6(R.avg_memory_by_event(strings(spark, d)))


@register("failure_ratio_by_priority", _s(
    "SELECT priority, round(avg(CAST(failed AS BIGINT)), 6) AS avg_failures FROM strings GROUP BY priority"))
def q_failure_ratio_by_priority(spark, d):
    return r6(R.failure_ratio_by_priority(strings(spark, d)))


@register("avg_duration_by_collection", _s(
    "SELECT collection_id, round(avg(CAST(end_time AS BIGINT) - CAST(start_time AS BIGINT)), 6) AS avg_duration "
    "FROM strings GROUP BY collection_id"))
def q_avg_duration_by_collection(spark, d):
    return r6(R.avg_duration_by_collection(strings(spark, d)))


@register("logs_by_user", _s('SELECT "user", count(*) AS log_count FROM strings GROUP BY "user"'))
def q_logs_by_user(spark, d):
    return R.logs_by_user(strings(spark, d))


@register("constraint_usage", _s('SELECT "constraint", count(*) AS count FROM strings GROUP BY "constraint"'))
def q_constraint_usage(spark, d):
    return R.constraint_usage(strings(spark, d))


@register("failures_by_class", _s(
    "SELECT scheduling_class, CAST(sum(CAST(failed AS BIGINT)) AS BIGINT) AS failures "
    "FROM strings GROUP BY scheduling_class"))
def q_failures_by_class(spark, d):
    return R.failures_by_class(strings(spark, d))


@register("machine_start_times", _s(
    "SELECT machine_id, start_time, count(*) AS occurrences FROM strings GROUP BY machine_id, start_time"))
def q_machine_start_times(spark, d):
    return R.machine_start_times(strings(spark, d))


@register("failures_by_memory", _s(
    f"SELECT {O.strict_num('assigned_memory')} AS assigned_memory, "
    "CAST(sum(CAST(failed AS BIGINT)) AS BIGINT) AS failures, "
    "round(avg(CAST(failed AS BIGINT)), 6) AS failure_ratio, count(*) AS tasks "
    f"FROM strings GROUP BY {O.strict_num('assigned_memory')}"))
def q_failures_by_memory(spark, d):
    return r6(R.failures_by_memory(strings(spark, d)))


_DUR = "(CAST(end_time AS BIGINT) - CAST(start_time AS BIGINT))"


@register("reducer_suite", _s(
    f"SELECT r.*, l.duration_list, l.occurrences FROM (SELECT event, CAST(sum({_DUR}) AS BIGINT) AS duration_sum, "
    f"count(*) AS duration_count, round(coalesce(avg({_DUR}), 0), 6) AS duration_avg, max({_DUR}) AS duration_max, "
    f"min({_DUR}) AS duration_min FROM strings GROUP BY event) r JOIN (SELECT event, {_DUR} AS duration_list, "
    f"count(*) AS occurrences FROM strings GROUP BY event, {_DUR}) l ON r.event IS NOT DISTINCT FROM l.event"))
def q_reducer_suite(spark, d):
    return r6(R.reducer_suite(strings(spark, d)))


# ---- step 3: dirty trace, parsing, single-dimension reports ------------------------

def _d(body: str, *extra: str) -> str:
    return W(T_, D_, *extra, body=body)


@register("parse_tasks", _d("""
SELECT sl_no, machine_id, scheduling_class, collection_type, priority, event, failed,
  round(average_usage_cpu, 6) AS average_usage_cpu, round(assigned_memory, 6) AS assigned_memory,
  round(cycles_per_instruction, 6) AS cycles_per_instruction, start_time, end_time
FROM parsed""", P_))
def q_parse_tasks(spark, d):
    p = C.parse_composite(dirty(spark, d))
    return r6(p.select("sl_no", "machine_id", "scheduling_class", "collection_type", "priority", "event",
                       "failed", "average_usage_cpu", "assigned_memory", "cycles_per_instruction",
                       "start_time", "end_time"))


@register("rejected_tasks", _d(f"""
SELECT sl_no, CASE WHEN {O.any_bad(COMPOSITE_NUMBERS)}
  THEN 'bad number' ELSE 'no machine' END AS reason
FROM dirty WHERE {O.key('machine_id')} IS NULL
  OR {O.any_bad(COMPOSITE_NUMBERS)}"""))
def q_rejected_tasks(spark, d):
    return C.rejected_composite(dirty(spark, d))


@register("derive_composite", _d("""
SELECT sl_no, machine_id, round(duration, 6) AS duration, round(eff_cpu, 6) AS eff_cpu,
  round(eff_mem, 6) AS eff_mem, round(heat, 6) AS heat, round(energy, 6) AS energy, failed
FROM comp""", P_, C_))
def q_derive_composite(spark, d):
    return r6(derived(spark, d).select("sl_no", "machine_id", "duration", "eff_cpu", "eff_mem",
                                       "heat", "energy", "failed"))


@register("derive_machine", _d(f"""
SELECT sl_no, {O.key('machine_id')} AS machine_id,
  round(greatest({O.num0('end_time')} - {O.num0('start_time')}, 0), 6) AS duration,
  round({O.num0('average_usage_cpu')} * (greatest({O.num0('end_time')} - {O.num0('start_time')}, 0)/3600) * 10, 6) AS heat,
  round({O.num0('average_usage_cpu')} * {O.num0('assigned_memory')}
        * greatest({O.num0('end_time')} - {O.num0('start_time')}, 0) / 1e6, 6) AS energy
FROM dirty WHERE {O.key('machine_id')} IS NOT NULL
  AND NOT {O.any_bad(['average_usage_cpu', 'assigned_memory', 'end_time', 'start_time'])}"""))
def q_derive_machine(spark, d):
    return r6(C.machine_runtime(dirty(spark, d)).select("sl_no", "machine_id", "duration", "heat", "energy"))


@register("derive_dimension_heat", _d(f"""
SELECT sl_no, round({O.num0('average_usage_cpu')}*1.8, 6) AS heat_priority,
  round({O.num0('average_usage_cpu')}*2, 6) AS heat_class,
  round({O.num0('avg_usage_memory')}*1.5, 6) AS heat_collection
FROM dirty WHERE NOT {O.any_bad(['average_usage_cpu', 'avg_usage_memory'])}"""))
def q_derive_dimension_heat(spark, d):
    return r6(C.dimension_heat(dirty(spark, d)))


def _dim_sql(k: str, heat: str, extra_bad: list[str]) -> str:
    return f"""
SELECT {O.key(k)} AS {k}, count(*) AS tasks, round(avg({O.num0('average_usage_cpu')}), 6) AS avg_cpu,
  round(avg({O.num0('average_usage_cpu')}*{heat}), 6) AS avg_heat,
  round(avg({O.flag()})*100, 6) AS failure_rate
FROM dirty WHERE {O.key(k)} IS NOT NULL AND NOT {O.any_bad(extra_bad)}
GROUP BY {O.key(k)}"""


@register("priority_report", _d(_dim_sql("priority", "1.8", ["average_usage_cpu"])))
def q_priority_report(spark, d):
    return r6(R.priority_report(dirty(spark, d)))


@register("class_report", _d(_dim_sql("scheduling_class", "2", ["average_usage_cpu"])))
def q_class_report(spark, d):
    return r6(R.class_report(dirty(spark, d)))


@register("collection_report", _d(f"""
SELECT {O.key('collection_type')} AS collection_type, count(*) AS tasks,
  round(avg({O.num0('avg_usage_memory')}), 6) AS avg_memory_usage,
  round(avg({O.num0('avg_usage_memory')}*1.5), 6) AS avg_heat
FROM dirty WHERE {O.key('collection_type')} IS NOT NULL AND NOT {O.any_bad(['avg_usage_memory'])}
GROUP BY {O.key('collection_type')}"""))
def q_collection_report(spark, d):
    return r6(R.collection_report(dirty(spark, d)))


def _runtime_sql(dur: str) -> str:
    cpu, mem = O.num0("average_usage_cpu"), O.num0("assigned_memory")
    return f"""count(*) AS tasks, round(avg({cpu}), 6) AS avg_cpu, round(avg({mem}), 6) AS avg_memory,
  round(avg({cpu}*(({dur})/3600)*10), 6) AS avg_heat, round(sum({cpu}*{mem}*({dur})/1e6), 6) AS total_energy,
  round(avg({O.flag()})*100, 6) AS failure_rate"""


_RAW_DUR = f"{O.num0('end_time')} - {O.num0('start_time')}"
_RUNTIME_BAD = O.any_bad(["average_usage_cpu", "assigned_memory", "end_time", "start_time"])


@register("machine_report", _d(f"""
SELECT {O.key('machine_id')} AS machine_id, {_runtime_sql(f'greatest({_RAW_DUR}, 0)')}
FROM dirty WHERE {O.key('machine_id')} IS NOT NULL AND NOT {_RUNTIME_BAD}
GROUP BY {O.key('machine_id')}"""))
def q_machine_report(spark, d):
    return r6(R.machine_report(dirty(spark, d)))


@register("overall_report", _d(f"""
SELECT {_runtime_sql(_RAW_DUR)} FROM dirty WHERE NOT {_RUNTIME_BAD}"""))
def q_overall_report(spark, d):
    return r6(R.overall_report(dirty(spark, d)))


# ---- step 4: composite rollup and its views -----------------------------------------

def _u(body: str) -> str:
    return W(T_, D_, P_, C_, U_, body=body)


@register("composite_rollup", _u("SELECT * FROM rollup"))
def q_composite_rollup(spark, d):
    return r6(rollup(spark, d))


@register("category_count", _u("SELECT count(*) AS categories FROM rollup WHERE dimension <> 'overall'"))
def q_category_count(spark, d):
    return U.category_count(rollup(spark, d))


@register("top_machines_composite", _u(
    "SELECT * FROM rollup WHERE dimension = 'machine' ORDER BY avg_heat_generation DESC, key LIMIT 10"))
def q_top_machines_composite(spark, d):
    return r6(U.top_machines_composite(rollup(spark, d), 10))


_MACHINE_VIEW = ", ".join(f'{src} AS "{shown}"' for src, shown in
                          DIMENSION_VIEWS["machine"])


@register("results_by_dimension", _u(
    f"SELECT {_MACHINE_VIEW} FROM rollup WHERE dimension = 'machine' ORDER BY key"))
def q_results_by_dimension(spark, d):
    entries = U.with_result_key(rollup(spark, d))
    return r6(U.dimension_view(entries, "machine"))
