"""Registered text queries against their SQL, and the pipeline against a brute-force version."""

import hashlib
import os
import sys

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import corpus_pipeline
from _compare import assert_same
from test_line_dedup import brute as brute_lines
from test_native import shingles
from test_simhash import groups, slow_fingerprint

from heatwise.llm import quality_gbt, queries


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_is_its_sql(spark, sf_dir, duck, key):
    assert_same(queries.QUERIES[key](spark, sf_dir).toPandas(), duck.execute(queries.ORACLE[key]).df())


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))


def test_pipeline_is_brute_force(spark, sf_dir):
    import duckdb

    def rows(name, cols):
        return duckdb.sql(f"SELECT {cols} FROM '{sf_dir}/{name}.parquet'").fetchall()

    docs = rows("documents", "doc_id, text")
    forest = quality_gbt.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = []
    for i, t in docs:
        base, x = quality_gbt.statistics(t or "")
        if not quality_gbt.base_failed(base[0], base[4]) and (forest is None or forest.score(np.array([x]))[0] >= 0.5):
            kept.append((i, t))
    kept = [(i, t) for i, t, _, _ in brute_lines(kept)]
    of = groups([slow_fingerprint(t) for _, t in kept])
    least = {}
    for (i, _), g in zip(kept, of):
        least[g] = min(i, least.get(g, i))
    kept = [(i, t) for (i, t), g in zip(kept, of) if least[g] == i]
    items = [set(shingles(t)) for _, t in rows("benchmark", "item_id, text")]
    kept = [(i, t) for i, t in kept
            if not any(s and 5 * len(s & have) >= 4 * len(s) for have in [set(shingles(t))] for s in items)]
    coder = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = []
    for i, t in kept:
        ids = coder.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert got == sorted(want) and 0 < len(got) < len(docs)


def test_stages_pass_further_columns_and_edges(spark, sf_dir):
    text = " ".join(f"Word{i} stands here, and so on." for i in range(60))
    rows = [(1, text, "en", "s", 5, "k"), (1, text, "en", "s", 5, "k"), (2, None, None, None, None, None), (3, "", "en", "s", 0, "k"),
            (None, text.replace("Word7 ", "Other "), "en", "s", 5, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string")
    for docs in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.land(stage(spark, docs, sf_dir), name)
            assert docs.columns == df.columns, name
        out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
        assert {r.doc_id for r in out} <= {1, None} and len(out) <= 2
