"""Box statistics per group, heavy hitters and the one-object results document against brute force."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heatwise.operators import charts as V
from heatwise.operators import reports as R
from heatwise.sinks import writers as K
from heatwise.sources import files as S


def some_values(seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["a", "b", None]), float(rnd.choice([1, 2, 2.5, rnd.random()]))) for _ in range(900)]
    rows += [("one", 3.0), ("hot", 7.0), ("nan", float("nan")), ("none", None)] + [("hot", 7.0)] * 500 + [("two", 1.0), ("two", 2.0)]
    return rows


@pytest.mark.parametrize("range_values", [7, 100_000])
def test_group_box_is_exact(spark, range_values):
    rows = some_values(range_values)
    got = {r.g: r for r in V.group_box_stats(spark.createDataFrame(rows, "g string, v double"), "v", ["g"], range_values).collect()}
    groups = {}
    for g, v in rows:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        want = np.quantile(vs, V.QUARTILES)
        assert got[g].n == len(vs) and np.allclose([got[g][n] for n in V.BOX], want, atol=1e-12)


def test_group_box_of_nothing_and_clashing_names(spark):
    df = spark.createDataFrame([(1, 2.0, 3)], "v long, n double, `b.c` int")
    assert V.group_box_stats(df.limit(0), "n", ["v"]).collect() == []
    row = V.group_box_stats(df, "n", ["v", "b.c"]).collect()[0]
    assert tuple(row) == (1, 3, 1, 2.0, 2.0, 2.0, 2.0, 2.0)


def test_sketches_of_parts_merge(spark):
    rnd = np.random.default_rng(2)
    rows = [(int(i % 3), int(i % 7), float(x)) for i, x in enumerate(rnd.lognormal(size=30_000))]
    df = spark.createDataFrame(rows, "g int, part int, v double")
    merged = V.box_of_sketches(V.merge_box_sketches(V.box_sketches(df, "v", ["g", "part"]), ["g"]), ["g"]).collect()
    for r in merged:
        vs = np.sort([v for g, _, v in rows if g == r.g])
        assert r.n == len(vs) and r.min == vs[0] and r.max == vs[-1]
        for q, name in zip(V.QUARTILES, V.BOX):
            assert abs(np.searchsorted(vs, r[name]) / len(vs) - q) < 0.01


@pytest.mark.parametrize("buckets", [1, 5, 1 << 16])
@pytest.mark.parametrize("n", [1, 4, 500])
def test_top_keys_lose_none(spark, buckets, n):
    rnd = random.Random(buckets * n)
    keys = [None if rnd.random() < 0.02 else min(int(rnd.paretovariate(0.7)), 300) for _ in range(4000)]
    got = [tuple(r) for r in R.top_keys(spark.createDataFrame([(k,) for k in keys], "k long"), "k", n, buckets).collect()]
    counts = {k: keys.count(k) for k in set(keys)}
    want = sorted(counts.items(), key=lambda e: (-e[1], e[0] is not None, e[0] or 0))[:n]
    assert got == want


def test_top_keys_edges(spark):
    empty = spark.createDataFrame([], "k string")
    assert R.top_keys(empty, "k", 3).collect() == []
    with pytest.raises(ValueError):
        R.top_keys(empty, "k", 0)


def entries(n):
    return {f"machine_{i}": {"count": i, "avg_cpu_usage": i / 7, "failed_tasks": 1, "unknown": "x, \"y\""} for i in range(n)} | {
        'class_\\"q"': {"count": 5}, "overall": {"count": 9, "total_heat": 1e300}}


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("last", [False, True])
def test_one_object_documents(spark, tmp_path, indent, last):
    envelope = {"timestamp": "2024-01-01T00:00:00", "row_count": 12, "headers": ["a", "b c"]}
    body = {"analysis_results": entries(2000)}
    path = str(tmp_path / "doc.json")
    with open(path, "w") as f:
        json.dump(body | envelope if last else envelope | body, f, indent=indent)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")  # many byte ranges
    try:
        meta, got = S.read_results_object(spark, path)
        assert [tuple(r) for r in meta.collect()] == [("2024-01-01T00:00:00", 12, ["a", "b c"])]
        rows = {r.result_key: r for r in got.collect()}
        assert got.select(F.spark_partition_id()).distinct().count() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert set(rows) == set(body["analysis_results"])
    for k, m in body["analysis_results"].items():
        for name in ("count", "avg_cpu_usage", "failed_tasks", "total_heat"):
            assert rows[k][name] == m.get(name)


def test_one_object_without_entries(spark, tmp_path):
    path = tmp_path / "doc.json"
    path.write_text('{"timestamp": "t", "row_count": 0, "headers": [], "analysis_results": {}}')
    meta, got = S.read_results_object(spark, str(path))
    assert got.count() == 0 and tuple(meta.first()) == ("t", 0, [])


def test_written_object_is_json(spark, tmp_path):
    rows = spark.createDataFrame([("overall", 'k"1', 3, 1.5), ("machine", "machine_2", 4, None)], "dimension string, result_key string, count long, total_heat double")
    K.write_results_object(rows, 7, ["a", "b"], str(tmp_path / "out"))
    text = "".join((tmp_path / "out" / n).read_text() for n in sorted(p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("part")))
    doc = json.loads(text)
    assert doc["row_count"] == 7 and doc["headers"] == ["a", "b"]
    assert doc["analysis_results"] == {'k"1': {"count": 3, "total_heat": 1.5}, "machine_2": {"count": 4}}
