"""Hierarchical weighted hash tree: draws, movement, numbering, edges."""

import hashlib
import math
import zlib

import pytest

from heatwise.llm import hash_tree as H


def slow_shard(key, tree):
    """One descent in plain Python."""
    here = [(r, f"{r}/{k}", f"{r}/{k}/{s}", s, w) for r, k, s, w in tree if w > 0]
    for level in range(3):
        weights = {}
        for row in here:
            weights[row[level]] = weights.get(row[level], 0) + row[4]

        def draw(path):
            bits = int(hashlib.md5(f"{key}|{path}".encode()).hexdigest()[:13], 16)
            return math.log((bits + 0.5) / 2**52) / weights[path], path
        best = max(weights, key=draw)
        here = [row for row in here if row[level] == best]
    return here[0][3] if here else None


def shards(spark, keys, tree):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    return {r.k: r.s for r in df.select("k", H.shard_of(df.k, tree).alias("s")).collect()}


def test_descent_is_the_plain_one(spark):
    tree = H.reweigh(H.reweigh(H.layout(12, 3, 2), 4, 2.5), 7, 0.0)
    got = shards(spark, range(400), tree)
    assert got == {k: slow_shard(k, tree) for k in range(400)}
    assert 7 not in got.values()


@pytest.mark.parametrize("n", [1, 5, 40])
def test_one_more_shard_takes_rows_only_into_itself(spark, n):
    tree = H.layout(n)
    before = shards(spark, range(4000), tree)
    for _ in range(2):
        tree = H.grow(tree)
        after = shards(spark, range(4000), tree)
        new = max(s for _, _, s, _ in tree)
        assert {after[k] for k in before if after[k] != before[k]} == {new}
        moved = sum(after[k] != before[k] for k in before) / 4000
        assert 0.5 / (new + 1) < moved < 1.6 / (new + 1)
        before = after


def test_a_changed_weight_moves_rows_of_its_subtrees_only(spark):
    tree = H.layout(40)
    where = {s: (r, f"{r}/{k}") for r, k, s, _ in tree}
    before = shards(spark, range(6000), tree)
    for weight in (3.0, 0.0):
        after = shards(spark, range(6000), H.reweigh(tree, 17, weight))
        moves = [(before[k], after[k]) for k in before if before[k] != after[k]]
        assert moves
        for a, b in moves:
            if where[a][0] != where[b][0]:  # between regions: the changed one gives or takes
                assert where[17][0] == (where[b][0] if weight else where[a][0])
            elif where[a][1] != where[b][1]:  # within a region: the changed rack gives or takes
                assert where[17][1] == (where[b][1] if weight else where[a][1])
            else:
                assert 17 == (b if weight else a)


def test_weights_decide_shares(spark):
    tree = [("a", "x", 0, 1.0), ("a", "y", 1, 2.0), ("b", "x", 2, 5.0)]
    got = list(shards(spark, range(8000), tree).values())
    for s, share in ((0, 1 / 8), (1, 2 / 8), (2, 5 / 8)):
        assert abs(got.count(s) / 8000 - share) < 0.02


def test_edges(spark):
    rows = [(None, None, 1), (None, "", 2), (1, "é", 3), (1, "é", 4), (2, "x" * 300_000, 5)] + [(None, "t", i) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    tree = H.layout(5)
    got = [tuple(r) for r in H.place(docs, tree, H.grow(tree)).collect()]
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    for s in {r[3] for r in got}:
        assert sorted(r[4] for r in got if r[3] == s) == list(range(sum(r[3] == s for r in got)))
    assert len({r[3] for r in got if r[0] is None}) == 1
    assert H.place(docs.limit(0), tree).collect() == []
    assert all(r.shard is None for r in H.place(docs, []).collect())


def test_copies_cross_as_one_row_and_all_get_slots(spark):
    docs = spark.range(20_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'same' AS text")
    got = H.place(docs, H.layout(40)).agg({"slot": "max", "*": "count"}).collect()[0]
    assert sorted(got) == [19_999, 20_000]
    distinct = H.place(docs, H.layout(40)).select("slot").distinct().count()
    assert distinct == 20_000


def test_files_of_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i % 50, f"t{i}", {"a": 1}) for i in range(300)], "doc_id long, text string, `m.x` map<string,int>")
    tree = H.layout(6)
    H.write_shards(docs, tree, str(tmp_path / "out"), rows_per_file=20)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.text, r["m.x"]["a"], r.shard) for r in back.collect()) == sorted(
        (i % 50, f"t{i}", 1, slow_shard(i % 50, tree)) for i in range(300))
