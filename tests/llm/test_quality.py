"""Quality rules: base counts by brute force, monotonic trees, held-out accuracy."""

import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from heatwise.llm import quality_gbt as Q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if runs[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\té#|\x0b\x1c日", max_size=80))
def test_base_counts(text):
    assert Q.statistics(text)[0] == brute(text)


def test_trees_keep_their_direction():
    rnd = np.random.default_rng(0)
    x = rnd.random((600, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) < 0.6) ^ (rnd.random(600) < 0.1)).astype(float)
    forest = Q.fit_forest(x, y, np.array([-1, 0, 1]), trees=30)
    line = np.linspace(0, 1, 200)
    for base in rnd.random((20, 3)):
        falling, rising = np.tile(base, (200, 1)), np.tile(base, (200, 1))
        falling[:, 0], rising[:, 2] = line, line
        assert (np.diff(forest.score(falling)) <= 1e-12).all()
        assert (np.diff(forest.score(rising)) >= -1e-12).all()


def test_scoring_is_walking_the_trees():
    rnd = np.random.default_rng(1)
    x, y = rnd.random((300, 4)), rnd.integers(0, 2, 300).astype(float)
    f = Q.fit_forest(x, y, np.zeros(4, int), trees=5)
    for row, got in zip(x[:50], f.score(x[:50])):
        total = f.bias
        for node in f.roots:
            while f.left[node] != node:
                node = f.left[node] if row[f.feature[node]] <= f.threshold[node] else f.right[node]
            total += f.value[node]
        assert abs(1 / (1 + np.exp(-total)) - got) < 1e-12


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    forest = Q.train(docs, labels.where("doc_id % 2 = 0"))
    out = Q.score_documents(docs, forest).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    assert ((out.score >= 0.5) == (out.quality == 1)).mean() > 0.95
    again = Q.train(docs.repartition(7), labels.repartition(3).where("doc_id % 2 = 0"))
    assert (again.value == forest.value).all() and (again.feature == forest.feature).all()


def test_edges(spark):
    rows = [(1, None, "k"), (2, "", "k"), (None, "a " * 60, "k"), (3, " ".join(f"w{i}" for i in range(80)), "k"),
            (3, " ".join(f"w{i}" for i in range(80)), "k"), (4, "x\n" * 100_000, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.train(df, none) is None
    out = sorted(map(repr, ((r.doc_id, r.n_words, r.base_failed, r.score, r.kept) for r in Q.score_documents(df, None).collect())))
    assert out == sorted(map(repr, [(1, 0, True, None, False), (2, 0, True, None, False), (None, 60, True, None, False),
                                    (3, 80, False, None, True), (3, 80, False, None, True), (4, 100_000, True, None, False)]))
    kept = Q.keep_good(df, None).collect()
    assert [r.doc_id for r in kept] == [3, 3] and kept[0].kept == "k"
    assert Q.score_documents(df.limit(0), None).count() == 0 and Q.keep_good(df.limit(0), None).count() == 0
    odd = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    assert Q.train(df, odd) is None  # one class only
