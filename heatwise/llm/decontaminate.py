"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item leaks into a document if at least ``threshold`` of the item's word shingles
stand anywhere in it.  The items are partitioned by size (number of distinct shingles,
classes by powers of two).  An item's sketch is its k smallest shingle hashes, with k
from the class's upper size u: an item that leaks can lack no more than (1 - threshold) u
of its shingles, so k = floor((1 - threshold) u) + 1 minima hold one that the document
has, whatever the document's length.  Documents thus need no signature of their own:
their shingle hashes below the classes' largest minimum probe the sketches, and only
pairs that meet there are verified by exact containment of the shingles' words.

A Jaccard signature of a document could not find them: an item of 30 shingles in a
document of 20,000 has a similarity of 0.0015.

DataFrame functions only; nothing but counts and one bound reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatwise.llm.common import (broadcast_checked, keyed_documents, land, packed_rows, plain_words, shingles, unpacked,
                                 with_shingle_hashes)


def item_sketches(items: DataFrame, threshold: float = 0.8, size: int = 5) -> DataFrame:
    """(item, h) rows: the k smallest shingle hashes of each item, k by its size class."""
    n = F.size("sh")
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(n)))
    minima = F.floor(F.round(upper * (1 - threshold), 9)).cast("int") + 1
    return (with_shingle_hashes(items, "text", size).withColumn("sh", F.array_sort(F.array_distinct("sh")))
            .select("item", F.explode(F.slice("sh", 1, minima)).alias("h")))


def _leaks(docs: DataFrame, items: DataFrame, threshold: float, size: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, th, item_id, n_shingles, n_shared) of every leak; rows that repeat an id are told apart by their text's hash."""
    text = F.coalesce(items["text"].cast("string"), F.lit(""))
    items = items.select(items["item_id"].cast("long").alias("item_id"), text.alias("text")).distinct()
    items = land(items.withColumn("item", F.xxhash64("item_id", "text")), "test-items")
    sketches = land(item_sketches(items, threshold, size), "item-sketches")
    highest = sketches.agg(F.max("h")).first()[0]
    if highest is None:
        highest = -(1 << 63)

    rows = keyed_documents(docs, id_col, text_col)
    probes = (with_shingle_hashes(rows, "text", size)
              .select("doc_id", "th", F.explode(F.filter("sh", lambda h: h <= F.lit(highest))).alias("h")))
    met = land(probes.join(broadcast_checked(sketches), "h").select("doc_id", "th", "item").distinct(), "met-items")

    words = items.withColumn("words", plain_words(F.col("text")))
    runs = words.withColumn("run", F.array_distinct(shingles("words", size, lambda r: F.array_join(r, " "))))
    item_runs = runs.select("item", "item_id", F.size("run").alias("n_shingles"), F.explode("run").alias("run"))
    suspects = broadcast_checked(met.select("doc_id", "th").distinct().withColumnsRenamed({"doc_id": "d", "th": "t"}))
    here = (rows.join(suspects, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left_semi")
            .withColumn("words", plain_words(F.col("text")))
            .select("doc_id", "th", F.explode(F.array_distinct(
                shingles("words", size, lambda r: F.array_join(r, " ")))).alias("run")))
    shared = (here.join(broadcast_checked(land(item_runs, "item-shingles")), "run")
              .groupBy("doc_id", "th", "item", "item_id", "n_shingles").agg(F.count_distinct("run").alias("n_shared"))
              .where(F.col("n_shared") >= F.ceil(F.round(F.col("n_shingles") * threshold, 9))))
    pairs = met.withColumnsRenamed({"doc_id": "d", "th": "t", "item": "i"})
    return shared.join(pairs, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))
                       & (F.col("item") == F.col("i")), "left_semi")


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.8, size: int = 5,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every leak.

    ``items`` has item_id and text.  Words are lower-case runs of letters and digits; an
    item of fewer than ``size`` words is one shingle of all its words, and is found only
    in a document of the same words.  Null, empty or wordless texts leak nothing and
    hold nothing.  Rows that repeat an id are told apart by their text, and a pair of
    ids comes out once, with its largest containment; null ids come out as null; other
    columns are left out.
    """
    best = F.max(F.struct((F.col("n_shared") / F.col("n_shingles")).alias("containment"),
                          F.col("n_shared").cast("long").alias("n_shared"),
                          F.col("n_shingles").cast("long").alias("n_shingles"))).alias("best")
    found = _leaks(docs, items, threshold, size, id_col, text_col)
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.n_shingles", "best.n_shared", "best.containment")


def drop_leaky(docs: DataFrame, items: DataFrame, threshold: float = 0.8, size: int = 5,
               id_col: str = "doc_id", text_col: str = "text", per_row: bool = False) -> DataFrame:
    """The rows of ``docs`` whose id has no leak, all columns as they are.

    With ``per_row`` the rows that leak nothing themselves: a clean row stays beside a
    leaking one of the same id, and null ids, which name no document, don't fall together.
    """
    found = _leaks(docs, items, threshold, size, id_col, text_col)
    rows = packed_rows(docs, id_col, text_col)
    if per_row:
        leaky = land(found.select(F.col("doc_id").alias("d"), F.col("th").alias("t")).distinct(), "leaky-rows")
        same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))
    else:
        leaky = land(found.select(F.col("doc_id").alias("d")).distinct(), "leaky-documents")
        same = F.col("doc_id").eqNullSafe(F.col("d"))
    return unpacked(rows.join(broadcast_checked(leaky), same, "left_anti"), docs.columns)
