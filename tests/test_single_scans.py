"""Reports that scan the task table once land nothing, and the damaged trace is dealt out like its rows."""

import datetime
import glob

import pyarrow.parquet as pq
import pytest

from heatwise.plans import catalog, registry, registry_files
from heatwise.sources import star

DAY = datetime.datetime(1995, 3, 1)


@pytest.fixture()
def star_dir(spark, tmp_path):
    """400 lines whose numbers are all divisible by 8, with their orders and customers."""
    lines = [(4 * k, k, k % 7, 8, 10.0 + k % 5, 1000.0 + k, 0.05, 0.02, "R" if k % 3 else "N", "F", DAY) for k in range(400)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(4 * k, k % 20, "O", 1.0, DAY, "2-HIGH") for k in range(400)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, k % 5, "BUILDING") for k in range(20)],
                          "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


@pytest.fixture()
def conf(spark):
    """Sets settings for one test."""
    were = {}

    def put(key, value):
        were.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)
    yield put
    for key, value in were.items():
        spark.conf.set(key, value)


def landed(d):
    return {key[2] for key in star._LANDED if key[1] == d.rstrip("/")}


def test_single_scans_land_nothing(spark, star_dir):
    rows = catalog.QUERIES["reducer_suite"](spark, star_dir).collect()
    assert [r["duration_count"] for r in rows] == [400]
    assert landed(star_dir) == set()
    direct = sorted(map(str, catalog.strings(spark, star_dir).collect()))
    star.land(spark, star_dir, "tasks")
    again = catalog.strings(spark, star_dir)
    assert all("landed-tasks" in f for f in again.inputFiles())
    assert sorted(map(str, again.collect())) == direct


def test_large_customers_meet_orders_first(spark, star_dir, conf, monkeypatch):
    rows = sorted(map(str, star.tasks_from_star(spark, star_dir).collect()))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(star, "LARGE_CUSTOMERS", 1, raising=False)
    assert sorted(map(str, star.tasks_from_star(spark, star_dir).collect())) == rows
    plan = star.tasks_from_star(spark, star_dir, spread=True)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Join Inner, (l_orderkey") < plan.index("Join Inner, (o_custkey")


def test_damaged_trace_is_dealt_out_like_its_rows(spark, star_dir, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    path = registry_files.damaged_trace(spark, star_dir)
    parts = [open(f).read().splitlines() for f in glob.glob(f"{path.removeprefix('file:')}/**/part-*", recursive=True)]
    parts = [p for p in parts if p]
    assert sum(len(p) - 1 for p in parts) == 400
    assert max(len(p) for p in parts) < 200, "one task held most of the trace"
    assert {p[0] for p in parts} == {",".join(catalog.strings(spark, star_dir).columns)}
    good, bad = registry_files.S.read_tasks_csv_checked(spark, path)
    assert good.count() + bad.count() == 400


def test_damaged_trace_without_rows(spark, star_dir, tmp_path):
    empty = f"{tmp_path}/empty"
    for t in ("lineitem", "orders", "customer"):
        spark.read.parquet(f"{star_dir}/{t}.parquet").limit(0).write.parquet(f"{empty}/{t}.parquet")
    assert registry_files.q_csv_rejected_lines(spark, empty).collect() == []


def test_strings_csv_is_written_compressed(spark, star_dir):
    back = registry.q_scan_csv_strings(spark, star_dir)
    assert back.count() == 400
    assert all(f.endswith(".csv.gz") for f in back.inputFiles())
    assert landed(star_dir) == set()


def test_linear_trace_is_landed_in_small_files(spark, star_dir, monkeypatch):
    monkeypatch.setattr(star, "FILE_ROWS", {"linear": 50}, raising=False)
    lin = star.land(spark, star_dir, "linear")
    rows = [pq.read_metadata(f.removeprefix("file://")).num_rows for f in lin.inputFiles()]
    assert sum(rows) == lin.count() > 50
    assert max(rows) <= 50
