"""The task table, derived from the star-schema parquet tables.

``tasks_from_star`` is the typed task table.  ``tasks_strings`` is
the same rows in the raw trace form (every column a string, as a header-only CSV
read gives them) and ``tasks_dirty`` adds the irregularities a real trace file
has: padded and blank keys, several spellings of the failed flag, empty and
unparseable numbers.  All three are plain projections.  ``land`` writes each
once per session and input to the shared folder, as a trace would arrive as
files; reports then scan the landed parquet, pruned to their columns.  ``tasks_once``
is the task table for a single scan, which needs no landing of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heatwise.schema import RAW_NAME, TASK_COLUMNS

EPOCH_DAY = "1995-01-01"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Bytes of the customer table that Spark may no longer broadcast (its default threshold).
LARGE_CUSTOMERS = 10 << 20


def _length(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Bytes of a table's files."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def _days_since(c: str) -> Column:
    return F.datediff(F.col(c), F.lit(EPOCH_DAY).cast("date")).cast("bigint")


def tasks_from_star(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer projected to the 27 task columns.

    With ``spread`` lineitem is dealt out by its order key first, which a sort-merge
    join on that key uses as it is.  Where the customers are too large to broadcast,
    orders meet them before they meet lineitem: the orders are then shuffled by the
    customer key, not the joined rows.

    The joins are plain equi-joins: Spark sizes each side from file statistics and
    at run time (AQE) and broadcasts only a side under the broadcast threshold,
    otherwise shuffles both on the key; skewed customer or order keys are split
    by AQE's skew-join handling.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    if spread:
        li = li.repartition("l_orderkey")
    if _length(spark, sf_dir, "customer") > LARGE_CUSTOMERS:
        j = li.join(od.join(cu, od.o_custkey == cu.c_custkey), li.l_orderkey == od.o_orderkey)
    else:
        j = li.join(od, li.l_orderkey == od.o_orderkey).join(cu, od.o_custkey == cu.c_custkey)

    pk, sk, qty, disc, tax = (F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity"),
                              F.col("l_discount"), F.col("l_tax"))
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sl_no"),
        (_days_since("o_orderdate") * 60).alias("start_time"),
        (_days_since("l_shipdate") * 60 - (F.col("l_linenumber") - 1) * 600).alias("end_time"),
        F.when(pk % 97 == 0, F.lit(None)).otherwise(sk).alias("machine_id"),
        F.col("l_orderkey").alias("collection_id"),
        F.when(pk % 89 == 0, F.lit(None)).otherwise((pk % 5).cast("int")).alias("scheduling_class"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("collection_type"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.col("o_orderstatus").alias("event"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("failed"),
        F.col("o_custkey").alias("user_id"),
        F.col("c_nationkey").alias("cluster_id"),
        F.col("c_mktsegment").alias("constraint_name"),
        F.when(pk % 50 == 0, F.lit(None).cast("double")).otherwise(qty / 1000).alias("assigned_memory"),
        (F.col("l_extendedprice") / 10000000).alias("page_cache_memory"),
        disc.alias("average_usage_cpu"),
        (tax / 8).alias("avg_usage_memory"),
        (disc + (sk % 7) / F.lit(100.0)).alias("maximum_usage"),
        (tax / 4 + (sk % 9) / F.lit(1000.0)).alias("maximum_usage_memory"),
        (disc * qty / 50).alias("random_sample_usage_cpu"),
        ((pk % 10) / F.lit(1000.0)).alias("random_sample_usage_memory"),
        (F.col("l_extendedprice") / 50000).alias("cycles_per_instruction"),
        ((pk % 20) / F.lit(100.0)).alias("memory_accesses_per_instruction"),
        ((F.col("l_orderkey") % 11) / F.lit(10.0)).alias("sample_rate"),
        tax.alias("cpu_usage_distribution"),
        (tax * disc * 10).alias("tail_cpu_usage_distribution"),
        (qty / 500).alias("resource_request"),
    )


def tasks_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The task table as the raw trace gives it: string columns, trace header names."""
    return strings_of(tasks_from_star(spark, sf_dir))


def strings_of(t: DataFrame) -> DataFrame:
    return t.select([F.col(c).cast("string").alias(RAW_NAME.get(c, c)) for c in TASK_COLUMNS])


def _num_text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def tasks_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_of(tasks_from_star(spark, sf_dir))


def dirty_of(t: DataFrame) -> DataFrame:
    """String task rows with deterministic irregularities (rules keyed on ``sl_no``).

    * failed flag spelled ``true/false``, `` Yes/no``, ``TRUE /0`` or ``1/0``;
    * machine ids padded with blanks on some rows, absent ids and classes blank;
    * a blank-only priority on some rows, padded event names;
    * absent numbers empty, some CPU readings empty, and the unparseable tokens
      ``n/a`` (assigned memory) and ``x1`` (cycles per instruction).
    """
    s = F.col("sl_no")
    f = F.col("failed") == 1
    failed_txt = (F.when(F.pmod(s, 5) == 0, F.when(f, "true").otherwise("false"))
                  .when(F.pmod(s, 5) == 1, F.when(f, " Yes").otherwise("no"))
                  .when(F.pmod(s, 5) == 2, F.when(f, "TRUE ").otherwise("0"))
                  .otherwise(F.when(f, "1").otherwise("0")))
    mid = F.col("machine_id").cast("string")
    machine_txt = (F.when(mid.isNull(), F.lit(""))
                   .when(F.pmod(s, 7) == 3, F.concat(F.lit(" "), mid, F.lit(" ")))
                   .otherwise(mid))
    event_txt = F.when(F.pmod(s, 11) == 0, F.concat(F.lit(" "), F.col("event"), F.lit(" "))).otherwise(F.col("event"))
    prio_txt = F.when(F.pmod(s, 53) == 0, F.lit("  ")).otherwise(F.col("priority").cast("string"))
    cols = {
        "sl_no": s.cast("string"),
        "start_time": _num_text("start_time"),
        "end_time": _num_text("end_time"),
        "machine_id": machine_txt,
        "collection_id": F.col("collection_id").cast("string"),
        "scheduling_class": _num_text("scheduling_class"),
        "collection_type": F.col("collection_type").cast("string"),
        "priority": prio_txt,
        "event": event_txt,
        "failed": failed_txt,
        "user": F.col("user_id").cast("string"),
        "cluster": F.col("cluster_id").cast("string"),
        "constraint": F.col("constraint_name"),
        "assigned_memory": F.when(F.pmod(s, 211) == 0, F.lit("n/a")).otherwise(_num_text("assigned_memory")),
        "average_usage_cpu": F.when(F.pmod(s, 17) == 0, F.lit("")).otherwise(_num_text("average_usage_cpu")),
        "cycles_per_instruction": F.when(F.pmod(s, 307) == 0, F.lit("x1")).otherwise(_num_text("cycles_per_instruction")),
    }
    out = []
    for c in TASK_COLUMNS:
        raw = RAW_NAME.get(c, c)
        out.append(cols.get(raw, _num_text(c)).alias(raw))
    return t.select(out)


# ---- landing: derived traces written once, read by every report -------------------

_BUILDERS = {
    "tasks": lambda spark, sf_dir, stamp: tasks_from_star(spark, sf_dir, spread=True),
    "strings": lambda spark, sf_dir, stamp: strings_of(_land(spark, sf_dir, "tasks", stamp)),
    "dirty": lambda spark, sf_dir, stamp: dirty_of(_land(spark, sf_dir, "tasks", stamp)),
    "linear": lambda spark, sf_dir, stamp: _linear(_land(spark, sf_dir, "tasks", stamp)),
}


def _linear(t: DataFrame) -> DataFrame:
    from heatwise.operators.clean import linear_tasks
    return linear_tasks(t)


# Rows of a landed file (kinds not named: no limit).  A file is often one row group, which one task must
# read whole; of files this size a learner's training side gets the small parts it asks for (``ml``).
FILE_ROWS = {"linear": 500_000}

_LANDED: dict[tuple, str] = {}


def _input_stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Modification times of the star inputs: a changed input lands again."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    stamp = []
    for name in ("lineitem", "orders", "customer"):
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = p.getFileSystem(conf)
        if fs.exists(p):  # the folder's time, and what is in it: a part rewritten in place changes the length
            inside = fs.getContentSummary(p)
            stamp.append((fs.getFileStatus(p).getModificationTime(), inside.getLength(), inside.getFileCount()))
        else:
            stamp.append(None)
    return tuple(stamp)


def land(spark: SparkSession, sf_dir: str, kind: str = "tasks") -> DataFrame:
    """The derived trace ``kind`` (tasks / strings / dirty / linear) as a landed parquet table.

    ``linear`` is the null-free task table with the linear figures (P1, F1): the
    any-null rule reads every column, so it is applied once here and the linear
    reports then read only the columns they aggregate.

    A trace normally arrives as files; here it is derived from the star tables,
    so the first call per session and input writes it below the shared checkpoint
    folder (one join, written in parallel) and every later report scans the files,
    reading only its own columns.  The write is an ordinary Spark job, so a lost
    executor only re-runs its tasks, and the table cuts the lineage of the join.
    """
    return _land(spark, sf_dir, kind, _input_stamp(spark, sf_dir))


def _landed(spark: SparkSession, sf_dir: str, kind: str, stamp: tuple) -> str | None:
    """Where ``kind`` lies, if this session has landed it from these inputs."""
    from heatwise.sources.files import _exists

    path = _LANDED.get((spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind, stamp))
    return path if path and _exists(spark, path) else None


def _land(spark: SparkSession, sf_dir: str, kind: str, stamp: tuple) -> DataFrame:
    """``land`` with the inputs' stamp, which is read once for a table and what it is made of."""
    from heatwise.session import scratch_path

    path = _landed(spark, sf_dir, kind, stamp)
    if path is None:
        path = scratch_path(spark, f"landed-{kind}")
        _BUILDERS[kind](spark, sf_dir, stamp).write.option("maxRecordsPerFile", FILE_ROWS.get(kind, 0)).parquet(path)
        _LANDED[spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind, stamp] = path
    return spark.read.parquet(path)


def tasks_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The task table for one scan: the landed one where there is one, else the join itself.

    A report that scans the tasks once would write and read all their columns to use a
    few; straight from the star tables only the columns it uses are read and shuffled.
    """
    return _once(spark, sf_dir, _input_stamp(spark, sf_dir))


def _once(spark: SparkSession, sf_dir: str, stamp: tuple) -> DataFrame:
    path = _landed(spark, sf_dir, "tasks", stamp)
    return spark.read.parquet(path) if path else tasks_from_star(spark, sf_dir, spread=True)
