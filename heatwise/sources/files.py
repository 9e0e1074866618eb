"""File sources: trace CSVs, report CSVs read back, results documents, metric text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatwise.functions import text as X
from heatwise.operators.clean import rename_legacy
from heatwise.schema import RAW_NAME, TASKS


def _by_name(strings: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` taken by header name; absent or unreadable values are null."""
    have = set(strings.columns)
    return strings.select(*[
        (F.trim(strings[f.name]) if f.dataType != T.StringType() else strings[f.name]).try_cast(f.dataType).alias(f.name)
        if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_tasks_csv(spark: SparkSession, path: str, schema: T.StructType | None = TASKS,
                   infer: bool = False) -> DataFrame:
    """Header CSV with an explicit schema, bound by header name.

    The order of the file's columns does not matter, further columns are left out, and
    a column that the file lacks is null.  Inference costs an extra pass; opt-in.
    """
    if schema is None or infer:
        return rename_legacy(spark.read.option("header", True).option("inferSchema", True).csv(path))
    strings = rename_legacy(read_strings_csv(spark, path))
    for name, header in RAW_NAME.items():
        if header in strings.columns and name not in strings.columns:
            strings = strings.withColumnRenamed(header, name)
    return _by_name(strings, schema)


_LINE, _FILE = "_corrupt_line", "_source_file"


def read_tasks_csv_checked(spark: SparkSession, path: str, schema: T.StructType = TASKS,
                           escape: str = "\\") -> tuple[DataFrame, DataFrame]:
    """S1 with P6 at the source: (accepted, rejected) of a header CSV.

    The CSV reader's corrupt-record channel gives the lines with too few or too many fields
    and those with open quotes; of the others, those where a value that is not blank does not
    fit its column's type are rejected too.  ``rejected`` is (file, reason, field, line): reason
    is ``quotes``, ``fields`` or ``value``, field the first column that does not fit.
    A value that begins with a quote counts as an open one: the reader gives such a value for
    a quote that closes before the field does.  ``escape`` is what stands before a quote inside
    quotes (``sinks.write_csv`` writes a backslash, other programs the quote itself).
    ``accepted`` is bound by header name like ``read_tasks_csv``.  Every line that is not blank
    and no header comes out once in one of the two; files in folders below are read too.  Files whose headers differ are refused.
    """
    header = spark.read.option("header", True).option("recursiveFileLookup", True).csv(path).columns
    lines = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _LINE]])
    raw = (spark.read.schema(lines).option("header", True).option("enforceSchema", False).option("columnPruning", False)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE).option("escape", escape)
           .option("recursiveFileLookup", True).csv(path)
           .select("*", F.col("_metadata.file_name").alias(_FILE)))
    typed = {f.name: f.dataType for f in schema.fields}
    known = {c: "sl_no" if c == "SL.No" else {h: n for n, h in RAW_NAME.items()}.get(c, c) for c in header}
    misfits = [F.when((F.trim(F.col(f"`{c}`")) != "") & F.trim(F.col(f"`{c}`")).try_cast(typed[known[c]]).isNull(), F.lit(c))
               for c in header if known[c] in typed and typed[known[c]] != T.StringType()]
    open_quote = F.regexp_count(F.col(_LINE), F.lit('"')) % 2 == 1
    stray = F.lit(False)
    for c in header:
        stray = stray | F.coalesce(F.col(f"`{c}`").startswith('"'), F.lit(False))
    reason = (F.when(F.col(_LINE).isNotNull() & open_quote, "quotes").when(F.col(_LINE).isNotNull(), "fields")
              .when(stray, "quotes").when(F.col("_misfit").isNotNull(), "value"))
    judged = raw.withColumn("_misfit", F.coalesce(*misfits, F.lit(None).cast("string"))).withColumn("_reason", reason)
    fields = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in header])
    rejected = judged.where("_reason IS NOT NULL").select(
        F.col(_FILE).alias("file"), F.col("_reason").alias("reason"),
        F.when(F.col("_reason") == "value", F.col("_misfit")).alias("field"), F.coalesce(_LINE, fields).alias("line"))
    good = judged.where("_reason IS NULL").select(*[F.col(f"`{c}`").alias(known[c]) for c in header])
    blank = [F.when(F.trim(F.col(c)) != "", F.col(c)).alias(c) if typed.get(c, T.StringType()) != T.StringType() else F.col(c)
             for c in known.values()]
    return _by_name(good.select(*blank), schema), rejected


def read_strings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every column a string."""
    return spark.read.option("header", True).csv(path)


def head_rows(df: DataFrame, n: int = 1000) -> DataFrame:
    """S3: the first n rows in a stated order (all columns, nulls first)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in df.columns]).limit(n)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def read_report_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A report CSV read back; an absent path gives an empty table of the schema."""
    if not _exists(spark, path):
        import warnings
        warnings.warn(f"report not found: {path}")
        return spark.createDataFrame([], schema)
    return _by_name(read_strings_csv(spark, path), schema)


ENTRY_SCHEMA = T.StructType([
    T.StructField("result_key", T.StringType()),
    T.StructField("metrics", T.StructType([
        T.StructField("count", T.LongType()),
        T.StructField("avg_cpu_usage", T.DoubleType()),
        T.StructField("avg_max_cpu", T.DoubleType()),
        T.StructField("avg_memory", T.DoubleType()),
        T.StructField("avg_memory_usage", T.DoubleType()),
        T.StructField("avg_heat_generation", T.DoubleType()),
        T.StructField("total_energy_consumption", T.DoubleType()),
        T.StructField("avg_duration", T.DoubleType()),
        T.StructField("total_heat", T.DoubleType()),
        T.StructField("failure_rate", T.DoubleType()),
        T.StructField("failed_tasks", T.LongType()),
    ])),
])

META_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("headers", T.ArrayType(T.StringType())),
])


def read_results(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The results document written by ``sinks.write_results``.

    Returns (meta, entries); entries are flattened to (result_key, metric columns).
    Both parts are JSON lines, so reading is split over tasks like any table.
    """
    meta = spark.read.schema(META_SCHEMA).json(f"{path}/meta")
    entries = spark.read.schema(ENTRY_SCHEMA).json(f"{path}/entries").select("result_key", "metrics.*")
    return meta, entries


_ENTRY = r'"((?:[^"\\]|\\.)*)"\s*:\s*\{([^{}]*)$'


def read_results_object(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A results document that is one JSON object, ``{…, "analysis_results": {key: {…}, …}}``.

    Returns (meta, entries) like ``read_results``.  The object is never held whole: the text
    is read as records that end with ``}``, which Spark splits by byte ranges like lines,
    so an object of a million keys is read by many tasks.  A record holds one entry, since
    an entry is flat; what stands before the first or after the last one is the envelope,
    in any order.  Numbers that don't fit and absent metrics are null.  Keys and headers
    must not hold braces.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(F.col("value").alias("piece"))
    key, body = F.regexp_extract("piece", _ENTRY, 1), F.regexp_extract("piece", _ENTRY, 2)
    metrics = ENTRY_SCHEMA["metrics"].dataType
    found = pieces.withColumns({"key": F.from_json(F.concat(F.lit('["'), key, F.lit('"]')), "array<string>")[0], "body": body})
    is_entry = F.col("piece").rlike(_ENTRY) & ~((F.col("key") == "analysis_results") & (F.trim("body") == ""))
    entries = (found.filter(is_entry)
               .select(F.col("key").alias("result_key"), F.from_json(F.concat(F.lit("{"), "body", F.lit("}")), metrics).alias("m"))
               .select("result_key", "m.*"))
    # the envelope's fields: before "analysis_results" (its record opens the object) or after its end
    head = F.regexp_extract("piece", r'(?s)^\s*\{(.*?),?\s*"analysis_results"', 1)
    tail = F.regexp_extract("piece", r"^\s*,([^{}]*)$", 1)
    fields = F.when(F.length(F.trim(head)) > 0, head).when(F.length(F.trim(tail)) > 0, tail)
    some = pieces.select(F.from_json(F.concat(F.lit("{"), F.regexp_replace(fields, r",\s*$", ""), F.lit("}")), META_SCHEMA).alias("e"))
    meta = some.filter("e IS NOT NULL").agg(*[F.max(f"e.{f.name}").alias(f.name) for f in META_SCHEMA.fields])
    return meta, entries


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of metric files (column ``value``)."""
    return spark.read.text(path)


def extract_score(lines: DataFrame, metric: str | None = None, line: str = "value") -> DataFrame:
    """The last number of each line that names ``metric`` (all lines if None)."""
    sel = lines if metric is None else lines.filter(F.col(line).contains(metric))
    return sel.withColumn("score", X.last_number(line))


# The score file of each task and the words that mark its score.
SCORE_FILES = {
    "Task Failure Rate Prediction": ("auc_failure_score.txt", "AUC Score"),
    "Heat Produced Prediction": ("rmse_heat.txt", "RMSE"),
    "Energy Consumed Prediction": ("rmse_energy.txt", "RMSE"),
    "Task Execution Time Prediction": ("rmse_duration.txt", "RMSE"),
}


def read_scores(spark: SparkSession, path: str, files: dict[str, tuple[str, str]] = SCORE_FILES) -> DataFrame:
    """(task, file, metric, score), one row per listed task.

    The score is the last number of the first line of the task's file (or folder of part
    files) that names the metric and holds a number; null where there is none or no file.
    First is by part file, byte range and place in it, so a long file may be read by many tasks.
    """
    asked = spark.createDataFrame([(t, f, m) for t, (f, m) in files.items()], "task string, file string, metric string")
    if not _exists(spark, path):
        return asked.withColumn("score", F.lit(None).cast("double"))
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        "value", F.regexp_extract(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))),
                                  r"([^/]+?)(?:/part-[^/]*)?$", 1).alias("file"),
        F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"))
    scored = lines.withColumn("score", X.last_number("value")).where("score IS NOT NULL")
    found = (scored.join(F.broadcast(asked), "file").where(F.col("value").contains(F.col("metric")))
             .groupBy("task").agg(F.min_by("score", "place").alias("score")))
    return asked.join(found, "task", "left")


def extract_number_pairs(lines: DataFrame, line: str = "value") -> DataFrame:
    """First two numbers of a line as (time, approx_heat); lines with fewer are skipped."""
    t, h = X.number_pair(line)
    return lines.select(t.alias("time"), h.alias("approx_heat")).filter(F.col("time").isNotNull())
