"""SimHash groups against a brute-force version over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from heatwise.llm import simhash_dedup as S


def slow_fingerprint(text, size=3):
    words = [w.lower() for w in (text or "").encode().split()]
    if not words:
        return 0
    runs = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    bits = [sum(xxhash.xxh64_intdigest(r, 42) >> b & 1 for r in runs) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(runs))


def groups(fps):
    top = list(range(len(fps)))

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    values = np.array(fps, dtype=np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values) <= 3):
            top[find(int(j))] = find(i)
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    for t in ["", " \n", "One", "one two", "a b c", "A b C d e f g " * 40, "é É ß \x0b x\x1cy z", None]:
        assert S.fingerprint((t or "").encode()) == slow_fingerprint(t)


@pytest.mark.parametrize("seed", [1, 2])
def test_links_lose_nothing(spark, seed):
    rnd = random.Random(seed)
    fps = []
    for _ in range(60):  # chains and stars at distances of one to four bits
        x = rnd.getrandbits(64)
        fps.append(x)
        for _ in range(rnd.randint(0, 6)):
            y = rnd.choice(fps[-3:]) if rnd.random() < 0.5 else x
            for b in rnd.sample(range(64), rnd.randint(1, 4)):
                y ^= 1 << b
            fps.append(y)
    dense = rnd.getrandbits(64)  # a crowded ball
    fps += [dense ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 2))) for _ in range(300)]
    fps = sorted(set(fps))
    want = groups(fps)
    signed = [int(np.uint64(x).view(np.int64)) for x in fps]
    points = spark.createDataFrame([(x,) for x in signed], "fp long")
    close = {r.node: r.grp for r in S.components(S.ball_links(points)).collect()}
    first = [(x, close.get(x, x)) for x in signed]
    grouped = spark.createDataFrame(first, "fp long, grp long")
    far = {r.node: r.grp for r in S.components(S.half_links(grouped)).collect()}
    got = [far.get(g, g) for _, g in first]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def _docs():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(0, 60, 2):
        words = [rnd.choice(vocabulary) for _ in range(300)]
        rows.append((i, " ".join(words)))
        words[rnd.randrange(300)] = "changed"
        rows.append((i + 1, "\n".join(words).upper()))
    return rows + [(100, None), (101, ""), (102, " \t"), (None, "w1 w2"), (103, "w1 W2"), (4, rows[4][1]), (4, rows[4][1] + " x"),
                   (104, "w " * 200_000)]


def test_near_duplicates_and_keep_one(spark):
    rows = _docs()
    fps = [slow_fingerprint(t) if len(t or "") < 100_000 else S.fingerprint(t.encode()) for _, t in rows]
    of = groups(fps)
    least = {}
    for (i, _), g in zip(rows, of):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted(repr((i, f"{f:016x}", least.get(g))) for (i, _), f, g in zip(rows, fps, of))
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, component_id string")
    assert sorted(repr(tuple(r)) for r in S.near_duplicates(df).collect()) == want
    kept = S.keep_one(df).collect()
    assert len(kept) == len(set(of))
    assert sorted(repr(r.doc_id) for r in kept) == sorted(repr(least.get(g)) for g in set(of))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).count() == 0 and S.keep_one(df).count() == 0


def test_no_pairs_of_copies(spark):
    df = spark.createDataFrame([(i, "one and the same text for all") for i in range(3000)], "doc_id long, text string")
    assert {r.component_id for r in S.near_duplicates(df).collect()} == {0}
    assert [r.doc_id for r in S.keep_one(df).collect()] == [0]
