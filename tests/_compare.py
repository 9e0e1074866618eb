"""Order-insensitive comparison of two pandas frames (exact values, nulls unified)."""

import math

import pandas as pd


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if hasattr(v, "item") and not isinstance(v, (list, tuple)):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2 ** 53:
            return int(v)
    return v


def canon(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(rows, key=repr)


def assert_same(spark_pdf, duck_pdf):
    sc, sr = canon(spark_pdf)
    dc, dr = canon(duck_pdf)
    assert sc == dc, f"columns differ: {sc} vs {dc}"
    assert len(sr) == len(dr), f"row counts differ: {len(sr)} vs {len(dr)}"
    diff = [(a, b) for a, b in zip(sr, dr) if a != b]
    assert not diff, f"{len(diff)} rows differ, e.g. {diff[:2]}"
