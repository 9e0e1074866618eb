"""Duration, heat and energy definitions.

The trace's reports use different formulas under the same names; each is kept as
its own function and the report names say which one they use.

    D1 duration_raw        end - start
    D2 duration_clamped    max(end - start, 0)
    D3 duration_guarded    end - start if end > start else 0
    H1 heat_linear         cpu * 100 + 10
    H2 heat_priority       cpu * 1.8
    H3 heat_class          cpu * 2
    H4 heat_collection     memory * 1.5
    H5 heat_runtime        cpu * (duration / 3600) * 10
    H6 heat_composite      eff_cpu * mem_factor * dur_factor * 100 + cpi * 0.1
    E1 energy_linear       cpu * duration * 1e-6
    E2 energy_memory       cpu * assigned_memory * duration / 1e6
    E3 energy_guarded      eff_cpu * assigned_memory * |duration| / 1e6 if assigned_memory > 0
    X1 mem_access_factor   1 + mapi / 10 if mapi > 0 else 1
    X2 duration_factor     min(|duration| / 3600, 1) if duration != 0 else 0.1
    X3/X4 positive_mean    mean of the positive readings, 0 when none
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_raw(start="start_time", end="end_time") -> Column:
    return _c(end) - _c(start)


def duration_clamped(start="start_time", end="end_time") -> Column:
    return F.greatest(_c(end) - _c(start), F.lit(0))


def duration_guarded(start="start_time", end="end_time") -> Column:
    s, e = _c(start), _c(end)
    return F.when(e > s, e - s).otherwise(F.lit(0))


def heat_linear(cpu="average_usage_cpu") -> Column:
    return _c(cpu) * 100 + 10


def heat_priority(cpu="average_usage_cpu") -> Column:
    return _c(cpu) * 1.8


def heat_class(cpu="average_usage_cpu") -> Column:
    return _c(cpu) * 2


def heat_collection(memory="avg_usage_memory") -> Column:
    return _c(memory) * 1.5


def heat_runtime(cpu, duration) -> Column:
    return _c(cpu) * (_c(duration) / 3600) * 10


def energy_linear(cpu, duration) -> Column:
    return _c(cpu) * _c(duration) * 1e-6


def energy_memory(cpu, memory, duration) -> Column:
    return _c(cpu) * _c(memory) * _c(duration) / 1e6


def positive(c) -> Column:
    """A reading counts only when it is a number above zero (NaN never counts)."""
    col = _c(c)
    return (col > 0) & ~F.isnan(col)


def positive_mean(*cols) -> Column:
    total = reduce(lambda a, b: a + b, [F.when(positive(c), _c(c)).otherwise(F.lit(0.0)) for c in cols])
    n = reduce(lambda a, b: a + b, [positive(c).cast("int") for c in cols])
    return F.coalesce(F.try_divide(total, n), F.lit(0.0))


def mem_access_factor(mapi="memory_accesses_per_instruction") -> Column:
    m = _c(mapi)
    return F.when(positive(m), 1 + m / 10.0).otherwise(F.lit(1.0))


def duration_factor(duration) -> Column:
    d = _c(duration)
    return F.when(d != 0, F.least(F.abs(d) / 3600.0, F.lit(1.0))).otherwise(F.lit(0.1))


def heat_composite(eff_cpu, mem_factor, dur_factor, cpi="cycles_per_instruction") -> Column:
    return _c(eff_cpu) * _c(mem_factor) * _c(dur_factor) * 100 + _c(cpi) * 0.1


def energy_guarded(eff_cpu, memory, duration) -> Column:
    m = _c(memory)
    return F.when(positive(m), _c(eff_cpu) * m * F.abs(_c(duration)) / 1e6).otherwise(F.lit(0.0))
