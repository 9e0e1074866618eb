"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of ours expects; all are runtime SQL settings except the UI switch.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "heatwise", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    On a cluster leave ``master`` unset and let spark-submit decide; tests pass
    ``local[*]``.  A checkpoint folder is configured only when the cluster did not
    name one (``spark.checkpoint.dir``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            builder = builder.config("spark.driver.memory", os.environ.get("HEATWISE_DRIVER_MEMORY", "16g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Lineage cuts, landed traces, streaming checkpoints and intermediate tables go
    below it, so they survive the loss of an executor.  Only a local session that names
    no folder (tests) gets a scratch folder; a cluster must name one that all share.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="heatwise-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    base = shared_dir(spark)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return f"{base.rstrip('/')}/heatwise/{name}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Remove everything that this library has written below the shared folder.

    For the end of a job: landed tables and stream folders of all its queries go, so no
    frame that reads them may be used any more.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/heatwise")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
