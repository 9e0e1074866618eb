"""The task table: explicit schema, feature sets and display names."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical typed task table (27 columns).  ``user_id``, ``cluster_id`` and
# ``constraint_name`` stand for the trace's ``user``, ``cluster`` and ``constraint``.
TASKS = T.StructType([
    T.StructField("sl_no", T.LongType()),
    T.StructField("start_time", T.LongType()),
    T.StructField("end_time", T.LongType()),
    T.StructField("machine_id", T.LongType()),
    T.StructField("collection_id", T.LongType()),
    T.StructField("scheduling_class", T.IntegerType()),
    T.StructField("collection_type", T.IntegerType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("event", T.StringType()),
    T.StructField("failed", T.IntegerType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("cluster_id", T.IntegerType()),
    T.StructField("constraint_name", T.StringType()),
    T.StructField("assigned_memory", T.DoubleType()),
    T.StructField("page_cache_memory", T.DoubleType()),
    T.StructField("average_usage_cpu", T.DoubleType()),
    T.StructField("avg_usage_memory", T.DoubleType()),
    T.StructField("maximum_usage", T.DoubleType()),
    T.StructField("maximum_usage_memory", T.DoubleType()),
    T.StructField("random_sample_usage_cpu", T.DoubleType()),
    T.StructField("random_sample_usage_memory", T.DoubleType()),
    T.StructField("cycles_per_instruction", T.DoubleType()),
    T.StructField("memory_accesses_per_instruction", T.DoubleType()),
    T.StructField("sample_rate", T.DoubleType()),
    T.StructField("cpu_usage_distribution", T.DoubleType()),
    T.StructField("tail_cpu_usage_distribution", T.DoubleType()),
    T.StructField("resource_request", T.DoubleType()),
])

TASK_COLUMNS = [f.name for f in TASKS.fields]

# Raw trace header names (string form); the typed table renames three of them.
RAW_NAME = {"user_id": "user", "cluster_id": "cluster", "constraint_name": "constraint"}
RAW_COLUMNS = [RAW_NAME.get(c, c) for c in TASK_COLUMNS]

# The thirteen numbers the composite mapper parses; a bad one rejects the row.
COMPOSITE_NUMBERS = [
    "cpu_usage_distribution", "average_usage_cpu", "avg_usage_memory",
    "maximum_usage_memory", "maximum_usage", "random_sample_usage_cpu",
    "random_sample_usage_memory", "assigned_memory", "page_cache_memory",
    "cycles_per_instruction", "memory_accesses_per_instruction", "start_time", "end_time",
]

# Feature sets (fixed values: column lists of the modelling scripts).
FS12 = [
    "avg_usage_memory", "maximum_usage_memory",
    "maximum_usage", "random_sample_usage_memory", "random_sample_usage_cpu",
    "assigned_memory", "resource_request", "cycles_per_instruction",
    "memory_accesses_per_instruction", "sample_rate", "cpu_usage_distribution",
    "tail_cpu_usage_distribution",
]
FS13 = [
    "average_usage_cpu", "avg_usage_memory", "maximum_usage_memory", "maximum_usage",
    "random_sample_usage_memory", "random_sample_usage_cpu", "assigned_memory",
    "resource_request", "cycles_per_instruction", "memory_accesses_per_instruction",
    "sample_rate", "cpu_usage_distribution", "tail_cpu_usage_distribution",
]
FS14 = [
    "average_usage_cpu", "avg_usage_memory", "maximum_usage_memory", "maximum_usage",
    "random_sample_usage_memory", "random_sample_usage_cpu", "assigned_memory", "duration",
    "resource_request", "cycles_per_instruction", "memory_accesses_per_instruction",
    "sample_rate", "cpu_usage_distribution", "tail_cpu_usage_distribution",
]
FS16 = [
    "average_usage_cpu", "avg_usage_memory", "maximum_usage_memory", "maximum_usage",
    "random_sample_usage_memory", "random_sample_usage_cpu", "assigned_memory", "duration",
    "resource_request", "cycles_per_instruction", "memory_accesses_per_instruction",
    "sample_rate", "cpu_usage_distribution", "tail_cpu_usage_distribution",
    "priority", "scheduling_class",
]

# Display names written at the sinks (fixed values: report headers).
DISPLAY = {
    "overall_summary": {
        "total_tasks": "Total Tasks", "avg_cpu_usage": "Avg CPU Usage", "peak_cpu": "Peak CPU",
        "assigned_memory": "Assigned Memory", "memory_usage": "Memory Usage", "avg_heat": "Avg Heat",
        "total_energy": "Total Energy", "avg_duration": "Avg Duration", "total_heat": "Total Heat",
        "failure_rate_pct": "Failure Rate (%)",
    },
    "top_machines": {
        "machine_id": "machine_id", "tasks": "Tasks", "avg_heat": "Avg Heat", "energy": "Energy",
        "failure_rate_pct": "Failure Rate (%)",
    },
    "scheduling_class_analysis": {
        "scheduling_class": "scheduling_class", "tasks": "Tasks", "cpu": "CPU", "heat": "Heat",
        "failure_rate_pct": "Failure Rate (%)",
    },
    "collection_type_analysis": {
        "collection_type": "collection_type", "tasks": "Tasks", "heat": "Heat",
        "memory_usage": "Memory Usage",
    },
    "priority_analysis": {
        "priority": "priority", "tasks": "Tasks", "heat": "Heat", "failure_rate_pct": "Failure Rate (%)",
    },
}

# Per-dimension views of the composite rollup (fixed values: column sets and names).
DIMENSION_VIEWS = {
    "machine": [
        ("key", "Machine ID"), ("count", "Tasks"), ("avg_cpu_usage", "Avg CPU (%)"),
        ("avg_max_cpu", "Peak CPU (%)"), ("avg_memory", "Memory (MB)"),
        ("avg_memory_usage", "Memory Usage (%)"), ("avg_heat_generation", "Heat (°C)"),
        ("total_energy_consumption", "Energy (kWh)"), ("avg_duration", "Duration (sec)"),
        ("failure_rate", "Failure Rate (%)"), ("failed_tasks", "Failed Tasks"),
    ],
    "class": [
        ("key", "Scheduling Class"), ("count", "Tasks"), ("avg_cpu_usage", "Avg CPU (%)"),
        ("avg_heat_generation", "Heat (°C)"), ("total_energy_consumption", "Energy (kWh)"),
        ("failure_rate", "Failure Rate (%)"),
    ],
    "priority": [
        ("key", "Priority"), ("count", "Tasks"), ("avg_heat_generation", "Heat (°C)"),
        ("total_energy_consumption", "Energy (kWh)"), ("failure_rate", "Failure Rate (%)"),
    ],
    "collection_type": [
        ("key", "Collection Type"), ("count", "Tasks"), ("avg_heat_generation", "Heat (°C)"),
        ("avg_memory_usage", "Memory Usage (%)"), ("total_energy_consumption", "Energy (kWh)"),
    ],
}

# Result-key prefixes of the composite rollup (fixed values).
DIMENSION_PREFIX = {
    "machine": "machine_", "class": "class_", "collection_type": "collection_type_",
    "priority": "priority_", "overall": "overall",
}
