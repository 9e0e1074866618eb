"""Cleaning steps: null handling, typing of the raw trace, quarantine of bad rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatwise.functions import derive as D
from heatwise.functions import parse as P
from heatwise.schema import COMPOSITE_NUMBERS


def rename_legacy(df: DataFrame) -> DataFrame:
    """A header ``SL.No`` becomes ``sl_no`` before any other step touches it."""
    if "SL.No" in df.columns:
        df = df.withColumnRenamed("SL.No", "sl_no")
    return df


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any / the given columns.

    Same rows as ``dropna(how='any')``, stated as one ``isNotNull`` (and ``isnan``
    for floating columns) per column.  ``dropna`` is a single predicate over all
    columns; when it is pushed below a projection that aliases many expressions,
    Catalyst's constraint inference copies that predicate once per alias and the
    constraint set grows as 2^columns.  Separate conjuncts grow linearly.
    """
    df = rename_legacy(df)
    types = dict(df.dtypes)
    cond = None
    for c in subset or df.columns:
        ok = F.col(c).isNotNull()
        if types[c] in ("double", "float"):
            ok = ok & ~F.isnan(F.col(c))
        cond = ok if cond is None else cond & ok
    return df if cond is None else df.filter(cond)


def with_linear(df: DataFrame) -> DataFrame:
    """duration (D1), heat (H1) and energy (E1) in one projection, then P2."""
    out = df.withColumns({
        "duration": D.duration_raw(),
        "heat": D.heat_linear("average_usage_cpu"),
        "energy": D.energy_linear("average_usage_cpu", D.duration_raw()),
    })
    return drop_incomplete(out, subset=["duration", "heat", "energy"])


def linear_tasks(tasks: DataFrame) -> DataFrame:
    """The typed reporting path: P3 → P1 → F1 → P2."""
    return with_linear(drop_incomplete(tasks))


def ensure_columns(raw: DataFrame, cols: list[str]) -> DataFrame:
    """An absent trace column reads as absent values (then the default rule applies)."""
    missing = [c for c in cols if c not in raw.columns]
    return raw.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else raw


def split_rejected(raw: DataFrame, numbers: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose listed numbers all parse (good) and the rest (rejected)."""
    return raw.filter(P.all_good(numbers)), raw.filter(P.any_bad(numbers))


def parse_composite(raw: DataFrame) -> DataFrame:
    """P4-P7 on the raw trace as the composite mapper reads it.

    Keys are trimmed (blank → null), numbers default to 0, the failed flag is
    normalised.  Rows with an unparseable number or a blank machine id are left
    out; ``rejected_composite`` returns them.
    """
    raw = ensure_columns(raw, COMPOSITE_NUMBERS + ["collection_id", "scheduling_class", "collection_type",
                                                   "priority", "event", "failed"])
    good = raw.filter(P.clean_key("machine_id").isNotNull() & P.all_good(COMPOSITE_NUMBERS))
    typed = {c: P.number_or_zero(c) for c in COMPOSITE_NUMBERS}
    return good.select(
        F.col("sl_no"),
        P.clean_key("machine_id").alias("machine_id"),
        P.clean_key("collection_id").alias("collection_id"),
        P.clean_key("scheduling_class").alias("scheduling_class"),
        P.clean_key("collection_type").alias("collection_type"),
        P.clean_key("priority").alias("priority"),
        P.clean_key("event").alias("event"),
        P.failed_flag("failed").alias("failed"),
        *[v.alias(k) for k, v in typed.items()],
    )


def rejected_composite(raw: DataFrame) -> DataFrame:
    """Rows the composite mapper drops, with the reason."""
    raw = ensure_columns(raw, COMPOSITE_NUMBERS)
    no_machine = P.clean_key("machine_id").isNull()
    bad = P.any_bad(COMPOSITE_NUMBERS)
    return (raw.filter(no_machine | bad)
            .select("sl_no", F.when(bad, F.lit("bad number")).otherwise(F.lit("no machine")).alias("reason")))


def with_composite(parsed: DataFrame) -> DataFrame:
    """D3, X1-X4, H6, E3 over the parsed composite rows."""
    dur = D.duration_guarded()
    eff_cpu = D.positive_mean("average_usage_cpu", "random_sample_usage_cpu", "cpu_usage_distribution")
    eff_mem = D.positive_mean("avg_usage_memory", "maximum_usage_memory", "random_sample_usage_memory")
    out = parsed.withColumns({"duration": dur, "eff_cpu": eff_cpu, "eff_mem": eff_mem})
    return out.withColumns({
        "heat": D.heat_composite("eff_cpu", D.mem_access_factor(), D.duration_factor("duration")),
        "energy": D.energy_guarded("eff_cpu", "assigned_memory", "duration"),
    })


def machine_runtime(raw: DataFrame) -> DataFrame:
    """duration (D2), heat (H5) and energy (E2) of string task rows that name a machine; unreadable rows are left out."""
    cols = ["average_usage_cpu", "assigned_memory", "end_time", "start_time"]
    cpu, mem = P.number_or_zero("average_usage_cpu"), P.number_or_zero("assigned_memory")
    dur = D.duration_clamped(P.number_or_zero("start_time"), P.number_or_zero("end_time"))
    return raw.filter(P.clean_key("machine_id").isNotNull() & ~P.any_bad(cols)).select(
        "sl_no", P.clean_key("machine_id").alias("machine_id"), dur.alias("duration"),
        D.heat_runtime(cpu, dur).alias("heat"), D.energy_memory(cpu, mem, dur).alias("energy"))


def dimension_heat(raw: DataFrame) -> DataFrame:
    """the heat figures of the priority, class and collection reports (H2-H4) per string task row."""
    cpu, mem = P.number_or_zero("average_usage_cpu"), P.number_or_zero("avg_usage_memory")
    return raw.filter(~P.any_bad(["average_usage_cpu", "avg_usage_memory"])).select(
        "sl_no", D.heat_priority(cpu).alias("heat_priority"), D.heat_class(cpu).alias("heat_class"),
        D.heat_collection(mem).alias("heat_collection"))


def present_features(df: DataFrame, wanted: list[str]) -> tuple[list[str], list[str]]:
    """P10: the wanted feature columns that exist, and those missing; none → error."""
    have = [c for c in wanted if c in df.columns]
    missing = [c for c in wanted if c not in df.columns]
    if not have:
        raise ValueError(f"no feature columns present; missing {missing}")
    return have, missing
