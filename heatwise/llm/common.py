"""Helpers shared by the text operators: tables, lineage cuts, checked broadcasts, shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heatwise.session import scratch_path

# Rows up to which a side may be broadcast; its size is counted before.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    Cuts the lineage, survives the loss of an executor, and gives the optimiser the
    real size of an intermediate table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else as it is.

    Beyond the bound the same join runs as a shuffled one, with the same rows.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def plain_words(text: Column) -> Column:
    """Lower-case runs of letters and digits; none gives an empty array."""
    spaced = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def shingles(words: str, size: int, of) -> Column:
    """``of(run of size words)`` for each place of the array column ``words``.

    Fewer words give the whole sequence as one shingle, no words give none.
    """
    n = F.size(F.col(words))
    places = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(places, lambda i: of(F.slice(F.col(words), i + 1, size)))


def with_shingle_hashes(df: DataFrame, text: str, size: int = 5) -> DataFrame:
    """``df`` with ``sh``: the 64-bit hashes of the word shingles of column ``text``, in order."""
    return (df.withColumn("words", plain_words(F.col(text)))
            .withColumn("words", F.transform("words", lambda w: F.xxhash64(w)))
            .withColumn("sh", shingles("words", size, lambda run: F.xxhash64(run))).drop("words"))


def named(column: str) -> Column:
    """A column by its plain name, whatever characters that holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def packed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, doc_id, th): all columns of a row as one struct, its id and text hash as in ``keyed_documents``.

    Columns of ``docs`` can't meet a join's own names that way; ``unpacked`` gives them back.
    """
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    return docs.select(F.struct(*[named(c).alias(c) for c in docs.columns]).alias("doc"),
                       named(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"))


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("doc").getField(c).alias(c) for c in columns])


def keyed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, text): the id, a hash of the text that tells rows of one id apart, and the text, null as empty."""
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    return docs.select(named(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def text_slices(batch: pa.RecordBatch, column: int, rows: int = 2048, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``rows`` rows and about ``size`` bytes of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + size, side="right"))))
        yield batch.slice(at, end - at)
        at = end
