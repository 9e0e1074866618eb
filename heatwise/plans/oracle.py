"""DuckDB statements of the same results, used as the independent correctness oracle.

They restate each report in plain SQL over the pre-registered parquet views;
nothing here is executed by Spark.
"""

from __future__ import annotations

from heatwise.schema import COMPOSITE_NUMBERS, RAW_NAME, TASK_COLUMNS

TASKS = """tasks AS (
SELECT l_orderkey*10 + l_linenumber AS sl_no,
  CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT)*60 AS start_time,
  CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS BIGINT)*60 - (l_linenumber-1)*600 AS end_time,
  CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_suppkey END AS machine_id,
  l_orderkey AS collection_id,
  CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE CAST(l_partkey % 5 AS INT) END AS scheduling_class,
  CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS collection_type,
  CAST(substring(o_orderpriority, 1, 1) AS INT) AS priority,
  o_orderstatus AS event,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS failed,
  o_custkey AS user_id,
  c_nationkey AS cluster_id,
  c_mktsegment AS constraint_name,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_quantity/1000 END AS assigned_memory,
  l_extendedprice/10000000 AS page_cache_memory,
  l_discount AS average_usage_cpu,
  l_tax/8 AS avg_usage_memory,
  l_discount + (l_suppkey % 7)/100e0 AS maximum_usage,
  l_tax/4 + (l_suppkey % 9)/1000e0 AS maximum_usage_memory,
  l_discount*l_quantity/50 AS random_sample_usage_cpu,
  (l_partkey % 10)/1000e0 AS random_sample_usage_memory,
  l_extendedprice/50000 AS cycles_per_instruction,
  (l_partkey % 20)/100e0 AS memory_accesses_per_instruction,
  (l_orderkey % 11)/10e0 AS sample_rate,
  l_tax AS cpu_usage_distribution,
  l_tax*l_discount*10 AS tail_cpu_usage_distribution,
  l_quantity/500 AS resource_request
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in TASK_COLUMNS)

LIN = f"""lin AS (
SELECT *, end_time - start_time AS duration,
  average_usage_cpu*100 + 10 AS heat,
  average_usage_cpu*(end_time - start_time)*1e-6 AS energy
FROM tasks WHERE {_NOT_NULL})"""


def _q(c: str) -> str:
    return f'"{c}"'


STRINGS = "strings AS (SELECT " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {_q(RAW_NAME.get(c, c))}" for c in TASK_COLUMNS) + " FROM tasks)"


def _num_text(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), '')"


_DIRTY_COLS = {
    "sl_no": "CAST(sl_no AS VARCHAR)",
    "machine_id": ("CASE WHEN machine_id IS NULL THEN '' WHEN sl_no % 7 = 3 "
                   "THEN ' ' || CAST(machine_id AS VARCHAR) || ' ' ELSE CAST(machine_id AS VARCHAR) END"),
    "collection_id": "CAST(collection_id AS VARCHAR)",
    "collection_type": "CAST(collection_type AS VARCHAR)",
    "priority": "CASE WHEN sl_no % 53 = 0 THEN '  ' ELSE CAST(priority AS VARCHAR) END",
    "event": "CASE WHEN sl_no % 11 = 0 THEN ' ' || event || ' ' ELSE event END",
    "failed": ("CASE WHEN sl_no % 5 = 0 THEN CASE WHEN failed = 1 THEN 'true' ELSE 'false' END "
               "WHEN sl_no % 5 = 1 THEN CASE WHEN failed = 1 THEN ' Yes' ELSE 'no' END "
               "WHEN sl_no % 5 = 2 THEN CASE WHEN failed = 1 THEN 'TRUE ' ELSE '0' END "
               "ELSE CASE WHEN failed = 1 THEN '1' ELSE '0' END END"),
    "user": "CAST(user_id AS VARCHAR)",
    "cluster": "CAST(cluster_id AS VARCHAR)",
    "constraint": "constraint_name",
    "assigned_memory": f"CASE WHEN sl_no % 211 = 0 THEN 'n/a' ELSE {_num_text('assigned_memory')} END",
    "average_usage_cpu": f"CASE WHEN sl_no % 17 = 0 THEN '' ELSE {_num_text('average_usage_cpu')} END",
    "cycles_per_instruction": f"CASE WHEN sl_no % 307 = 0 THEN 'x1' ELSE {_num_text('cycles_per_instruction')} END",
}

DIRTY = "dirty AS (SELECT " + ", ".join(
    f"{_DIRTY_COLS.get(RAW_NAME.get(c, c), _num_text(c))} AS {_q(RAW_NAME.get(c, c))}"
    for c in TASK_COLUMNS) + " FROM tasks)"


def num0(c: str) -> str:
    """Absent/empty → 0, else parsed (null if unparseable)."""
    return f"coalesce(TRY_CAST(nullif({_q(c)}, '') AS DOUBLE), 0.0)"


def bad(c: str) -> str:
    return f"({_q(c)} IS NOT NULL AND {_q(c)} <> '' AND TRY_CAST(nullif({_q(c)}, '') AS DOUBLE) IS NULL)"


def any_bad(cols) -> str:
    return "(" + " OR ".join(bad(c) for c in cols) + ")"


def key(c: str) -> str:
    return f"nullif(trim({_q(c)}), '')"


def flag(c: str = "failed") -> str:
    return f"CASE WHEN lower(trim({_q(c)})) IN ('true', '1', 'yes') THEN 1 ELSE 0 END"


def strict_num(c: str) -> str:
    return f"CAST(coalesce(nullif({_q(c)}, ''), '0') AS DOUBLE)"


PARSED = ("parsed AS (SELECT sl_no, " + ", ".join(
    f"{key(c)} AS {c}" for c in ["machine_id", "collection_id", "scheduling_class", "collection_type",
                                 "priority", "event"])
    + f", {flag()} AS failed, "
    + ", ".join(f"{num0(c)} AS {c}" for c in COMPOSITE_NUMBERS)
    + f" FROM dirty WHERE {key('machine_id')} IS NOT NULL AND NOT {any_bad(COMPOSITE_NUMBERS)})")


def _pos(c: str) -> str:
    return f"({c} > 0 AND NOT isnan({c}))"


def _pmean(*cs: str) -> str:
    total = " + ".join(f"(CASE WHEN {_pos(c)} THEN {c} ELSE 0.0 END)" for c in cs)
    n = " + ".join(f"(CASE WHEN {_pos(c)} THEN 1 ELSE 0 END)" for c in cs)
    return f"coalesce(({total}) / nullif({n}, 0), 0.0)"


COMP = f"""comp0 AS (
SELECT *, CASE WHEN end_time > start_time THEN end_time - start_time ELSE 0 END AS duration,
  {_pmean('average_usage_cpu', 'random_sample_usage_cpu', 'cpu_usage_distribution')} AS eff_cpu,
  {_pmean('avg_usage_memory', 'maximum_usage_memory', 'random_sample_usage_memory')} AS eff_mem
FROM parsed),
comp AS (
SELECT *,
  eff_cpu * (CASE WHEN {_pos('memory_accesses_per_instruction')} THEN 1 + memory_accesses_per_instruction/10.0 ELSE 1.0 END)
    * (CASE WHEN duration <> 0 THEN least(abs(duration)/3600.0, 1.0) ELSE 0.1 END) * 100
    + cycles_per_instruction*0.1 AS heat,
  CASE WHEN {_pos('assigned_memory')} THEN eff_cpu*assigned_memory*abs(duration)/1e6 ELSE 0.0 END AS energy
FROM comp0)"""

_ROLLUP_METRICS = """count(*) AS count,
  round(avg(eff_cpu), 6) AS avg_cpu_usage, round(avg(maximum_usage), 6) AS avg_max_cpu,
  round(avg(assigned_memory), 6) AS avg_memory, round(avg(eff_mem), 6) AS avg_memory_usage,
  round(avg(heat), 6) AS avg_heat_generation, round(sum(energy), 6) AS total_energy_consumption,
  round(avg(duration), 6) AS avg_duration, round(sum(heat), 6) AS total_heat,
  round(sum(failed)*100.0/count(*), 6) AS failure_rate, CAST(sum(failed) AS BIGINT) AS failed_tasks"""

ROLLUP = f"""rollup AS (
SELECT 'machine' AS dimension, machine_id AS key, {_ROLLUP_METRICS} FROM comp GROUP BY machine_id
UNION ALL
SELECT 'class', scheduling_class, {_ROLLUP_METRICS} FROM comp WHERE scheduling_class IS NOT NULL GROUP BY scheduling_class
UNION ALL
SELECT 'collection_type', collection_type, {_ROLLUP_METRICS} FROM comp WHERE collection_type IS NOT NULL GROUP BY collection_type
UNION ALL
SELECT 'priority', priority, {_ROLLUP_METRICS} FROM comp WHERE priority IS NOT NULL GROUP BY priority
UNION ALL
SELECT 'overall', NULL, {_ROLLUP_METRICS} FROM comp)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def explicit_rounding(sql: str, digits: int = 6) -> str:
    """Rewrite ``round(expr, 6)`` as ``(round((expr) * 1e6) / 1e6 + 0.0)``.

    The same scaled rounding is applied on the Spark side (``catalog.r6``), so
    both engines round one identical double the same way; ``+ 0.0`` turns a
    negative zero into zero.
    """
    needle = "round("
    out, i = [], 0
    low = sql.lower()
    while True:
        j = low.find(needle, i)
        if j < 0:
            out.append(sql[i:])
            break
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + len(needle)])
            i = j + len(needle)
            continue
        depth, k = 1, j + len(needle)
        while depth and k < len(sql):
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(needle):k - 1]
        if inner.endswith(f", {digits}"):
            expr = explicit_rounding(inner[: -len(f", {digits}")], digits)
            out.append(sql[i:j] + f"(round(({expr}) * 1e{digits}) / 1e{digits} + 0.0)")
        else:
            out.append(sql[i:j] + needle + explicit_rounding(inner, digits) + ")")
        i = k
    return "".join(out)
