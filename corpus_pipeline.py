"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, BPE encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next one's docs.
All stages but the last return the columns of documents, with the decisions of the
stage in effect.  Null and empty texts fail the quality rules.  A later stage judges
what its predecessor kept: a text that line dedup empties is like any other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatwise.llm.common import land, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and the trees keep."""
    from heatwise.llm.quality_gbt import keep_good, train

    return keep_good(docs, train(docs, table(spark, sf_dir, "labels"), max_labels=20_000))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat; ``n_chars`` follows the text."""
    from heatwise.llm.line_dedup import dedup_lines

    kept = dedup_lines(docs, min_chars=20, min_docs=3)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id."""
    from heatwise.llm.simhash_dedup import keep_one

    return keep_one(docs, shingle=3)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no test item; rows that share an id, or have none, are judged each."""
    from heatwise.llm.decontaminate import drop_leaky

    return drop_leaky(docs, table(spark, sf_dir, "benchmark"), threshold=0.8, size=5, per_row=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left, with the digests of ids and decoded text."""
    from heatwise.llm.bpe_trie import encode_documents

    out = encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)
    return out.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("simhash_near_dedup", near_copies),
          ("decontamination", leaks), ("bpe_codec", encode)]
ORACLE_SQL = None  # trees and token ids can't be said in SQL; tests hold run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in turn to ``documents``; each result is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
