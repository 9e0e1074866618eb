"""Sinks: report CSVs, aligned text, metric lines, the results document."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatwise.schema import DISPLAY


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    """K1: a directory of header CSV parts; by default fails if the path exists.

    A compressed part is read by one task: for tables whose parts are many and bounded.
    """
    df.write.mode(mode).option("header", True).option("compression", compression).csv(path)


def write_report(df: DataFrame, path: str, report: str | None = None) -> None:
    """K2: one small final report as a single CSV, display names in the header.

    Only for aggregated reports whose size is bounded by their key count;
    row-level tables go through ``write_csv`` and stay split.
    """
    names = DISPLAY.get(report or "", {})
    out = df.select([F.col(c).alias(names.get(c, c)) for c in df.columns])
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def aligned_lines(df: DataFrame, widths: dict[str, int] | None = None, digits: int = 4) -> DataFrame:
    """K3: a report as fixed-width text lines (numbers rounded for display)."""
    widths = widths or {}
    fmt, args = [], []
    for f in df.schema.fields:
        w = widths.get(f.name, max(len(f.name), 12) + 2)
        tn = f.dataType.typeName()
        if tn in ("double", "float", "decimal"):
            fmt.append(f"%{w}.{digits}f")
            args.append(F.round(F.col(f.name), digits))
        elif tn in ("integer", "long", "short", "byte"):
            fmt.append(f"%{w}d")
            args.append(F.col(f.name))
        else:
            fmt.append(f"%{w}s")
            args.append(F.coalesce(F.col(f.name).cast("string"), F.lit("")))
    return df.select(F.format_string("".join(fmt), *args).alias("value"))


def header_line(df: DataFrame, widths: dict[str, int] | None = None) -> str:
    widths = widths or {}
    return "".join(f"{f.name:>{widths.get(f.name, max(len(f.name), 12) + 2)}}" for f in df.schema.fields)


def write_text(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    lines.select("value").write.mode(mode).text(path)


def write_table_text(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3 as one file: a header line, then the report's lines in the report's order.

    For small final reports only (bounded by their key count): the lines are
    numbered in their current order, moved to one partition and sorted there,
    since merging partitions does not keep their order.
    """
    spark = report.sparkSession
    lines = aligned_lines(report).select(F.lit(1).alias("k"), F.monotonically_increasing_id().alias("pos"), "value")
    head = spark.createDataFrame([(0, 0, header_line(report))], "k int, pos long, value string")
    (head.unionByName(lines).repartition(1).sortWithinPartitions("k", "pos")
     .select("value").write.mode(mode).text(path))


def metric_lines(metrics: DataFrame, name: Column, value: str = "value") -> DataFrame:
    """K4: ``NAME: 0.1234`` lines."""
    return metrics.select(F.format_string("%s: %.4f", name, F.round(F.col(value), 4)).alias("value"))


def write_results(rollup_entries: DataFrame, row_count: int | Column, headers: list[str], path: str) -> None:
    """K5: the results document as JSON lines.

    ``entries/`` holds one record per result key (result_key, metrics struct) and
    is written by all tasks in parallel; ``meta/`` holds the one envelope record
    (timestamp, row_count, headers).  Nothing is gathered into a single row.
    """
    metric_cols = [c for c in rollup_entries.columns if c not in ("result_key", "dimension", "key")]
    rollup_entries.select("result_key", F.struct(*metric_cols).alias("metrics")) \
        .write.mode("overwrite").json(f"{path}/entries")
    spark = rollup_entries.sparkSession
    stamp = datetime.now(timezone.utc).isoformat()
    meta = spark.range(1).select(
        F.lit(stamp).alias("timestamp"),
        (row_count if isinstance(row_count, Column) else F.lit(row_count)).cast("bigint").alias("row_count"),
        F.array(*[F.lit(h) for h in headers]).alias("headers"))
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def write_results_object(rollup_entries: DataFrame, row_count: int | Column, headers: list[str], path: str) -> None:
    """K5: the results document as one JSON object, in text parts that follow each other.

    The parts together are the object: the envelope and the first entry, every further
    entry on a line that begins with a comma, the closing braces.  Entries are ordered by
    key over the parts, so no task writes more than its range.
    """
    metric_cols = [c for c in rollup_entries.columns if c not in ("result_key", "dimension", "key")]
    entry = F.concat(F.to_json(F.array("result_key")), F.lit(": "), F.to_json(F.struct(*metric_cols)))
    entry = F.regexp_replace(entry, r'^\[(.*?)\]: ', "$1: ")
    entries = rollup_entries.select(F.col("result_key").alias("key"), entry.alias("entry"))
    first = entries.orderBy("key").limit(1)
    spark = rollup_entries.sparkSession
    envelope = spark.range(1).select(F.to_json(F.struct(
        F.lit(datetime.now(timezone.utc).isoformat()).alias("timestamp"),
        (row_count if isinstance(row_count, Column) else F.lit(row_count)).cast("bigint").alias("row_count"),
        F.array(*[F.lit(h) for h in headers]).alias("headers"))).alias("j"))
    opening = envelope.select(F.lit(0).alias("at"), F.lit("").alias("key"), F.concat(
        F.expr("substring(j, 1, length(j) - 1)"), F.lit(', "analysis_results": {')).alias("value"))
    least = first.select("key").scalar()
    lines = entries.select(F.lit(1).alias("at"), "key", F.when(F.col("key") == least, F.col("entry"))
                           .otherwise(F.concat(F.lit(", "), "entry")).alias("value"))
    closing = spark.range(1).select(F.lit(2).alias("at"), F.lit("").alias("key"), F.lit("}}").alias("value"))
    (opening.unionByName(lines).unionByName(closing).repartitionByRange("at", "key").sortWithinPartitions("at", "key")
     .select("value").write.mode("overwrite").text(path))


def write_heat_log(measured: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K6: the measured-heat samples (W2) as a header CSV directory, one part per task."""
    measured.write.mode(mode).option("header", True).csv(path)
