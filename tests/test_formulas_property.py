"""Random rows (NaN, negatives, zeros) against a plain-Python statement of the formulas."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from heatwise.operators import clean as C

num = st.one_of(st.floats(-1.0, 5.0, allow_nan=False), st.just(0.0), st.just(float("nan")))
times = st.integers(-10_000, 10_000)
row = st.tuples(times, times, num, num, num, num, num, num, num, num, num, num)

COLS = ["start_time", "end_time", "average_usage_cpu", "random_sample_usage_cpu", "cpu_usage_distribution",
        "avg_usage_memory", "maximum_usage_memory", "random_sample_usage_memory", "assigned_memory",
        "memory_accesses_per_instruction", "cycles_per_instruction", "maximum_usage"]
SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in COLS])


def expected(r):
    start, end, a, rs, dist, m1, m2, m3, mem, mapi, cpi, _ = r
    dur = end - start if end > start else 0
    mf = 1 + mapi / 10.0 if mapi > 0 else 1.0
    df = min(abs(dur) / 3600.0, 1.0) if dur != 0 else 0.1
    cpus = [x for x in (a, rs, dist) if x > 0]
    eff = sum(cpus) / len(cpus) if cpus else 0
    mems = [x for x in (m1, m2, m3) if x > 0]
    effm = sum(mems) / len(mems) if mems else 0
    heat = eff * mf * df * 100 + cpi * 0.1
    energy = eff * mem * abs(dur) / 1_000_000 if mem > 0 else 0
    return dur, eff, effm, heat, energy


def same(a, b):
    if isinstance(b, float) and math.isnan(b):
        return a is not None and math.isnan(a)
    return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)


@settings(max_examples=4, deadline=None)
@given(st.lists(row, min_size=1, max_size=200))
def test_composite_formulas(spark, rows):
    data = [tuple(float(x) for x in r) for r in rows]
    df = spark.createDataFrame(data, SCHEMA)
    got = C.with_composite(df).select("duration", "eff_cpu", "eff_mem", "heat", "energy").collect()
    for r, g in zip(data, got):
        for a, b in zip(g, expected(r)):
            assert same(a, b), (r, tuple(g), expected(r))
