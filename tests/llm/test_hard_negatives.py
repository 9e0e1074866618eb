"""Hard negatives against brute force: ties, twins, odd vectors, empty tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from heatwise.llm import hard_negatives as N


def brute(rows, positives=5, negatives=3):
    use = []
    for tag, (i, v, label) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((tag, i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for tag, i, label, v in use:
        if i % 50:
            continue
        scored = sorted(((-sum(map(int.__mul__, v, w)), j, lab == label) for t, j, lab, w in use if t != tag))
        same = [(-s, j) for s, j, alike in scored if alike][:positives]
        for ps, p in same:
            inside = [(-s, j) for s, j, alike in scored if not alike and 50 * ps <= -100 * s <= 95 * ps][:negatives]
            out += [(i, p, k + 1, j, ps, s) for k, (s, j) in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, **more):
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, score string")
    got = N.mine(table, is_anchor=lambda i: i % 50 == 0,
                 label_of=lambda i, x: F.when(i % 7 == 0, (x + 1) % 10).otherwise(x), **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def test_keys_sort_by_anchor_falling_score_kind_id():
    rnd = random.Random(1)
    made = [(rnd.randint(-2, 2), rnd.choice([0, 1, -1, 2**63 - 1, -2**63, 7]), rnd.randint(0, 1), rnd.randint(-3, 3)) for _ in range(400)]
    assert [N.unpack(k) for k in sorted(N.pack(*m) for m in made)] == sorted(made, key=lambda m: (m[0], -m[1], m[2], m[3]))


def test_window():
    for s in range(-300, 300):
        inside = [x for x in range(-600, 600) if 50 * s <= 100 * x <= 95 * s]
        assert N.window(s, 50, 95) == ((min(inside), max(inside)) if inside else None)


@pytest.mark.parametrize("blocks", [(512, 8192), (3, 17)])
def test_mining_is_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(N, "ANCHORS", blocks[0])
    monkeypatch.setattr(N, "ROWS", blocks[1])
    rnd = random.Random(2)
    rows = []
    for i in range(420):
        v = [rnd.randint(-2, 4) / 8 for _ in range(4)]  # few values: many ties
        rows.append((i, v, rnd.randint(0, 3)))
    rows += [(100, [0.5] * 4, 1), (100, [0.5] * 4, 1), (150, [0.0] * 4, 2), (None, [1.0] * 4, 1), (101, None, 1), (102, [None, 1.0], 1),
             (103, [float("nan")] * 4, 1), (104, [float("inf")] * 4, 1), (105, [1.0] * 4, None), (250, [], 2), (251, [0.3], 2),
             (300, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6], 1), (-50, [0.5, 0.1, 0.0, 0.2], 2)]
    assert mined(spark, rows) == brute(rows)


def test_huge_components_are_exact(spark):
    rnd = random.Random(3)
    for size in (40.0, 3e5, 5e6):  # float64 sums, and whole numbers beyond them
        rows = [(i, [rnd.uniform(-size, size) for _ in range(3)], rnd.randint(0, 1)) for i in range(0, 500, 5)]
        got = mined(spark, rows)
        assert got == brute(rows) and got


def test_no_anchor_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == []
    assert mined(spark, [(50, [1.0], 1)]) == []
    assert mined(spark, [(50, [1.0], 1), (51, [1.0], 1)]) == []
    assert mined(spark, [(50, [1.0], 1), (50, [1.0], 1), (52, [0.9], 2)]) == brute([(50, [1.0], 1), (50, [1.0], 1), (52, [0.9], 2)])


def test_a_third_of_all_rows_is_one_vector(spark):
    rnd = random.Random(6)
    rows = [(i, [0.5, 0.25] if i % 3 == 0 else [rnd.random(), rnd.random()], rnd.randint(0, 2)) for i in range(700)]
    assert mined(spark, rows) == brute(rows)
