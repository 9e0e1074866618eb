"""Runs against a brute-force version, the digests against the contract, edges."""

import hashlib
import random
import zlib

import numpy as np

from heatwise.llm import periodic_runs as R


def brute(w, least=12):
    """Maximal stretches per period, the least period of a stretch only."""
    n, out = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            if i + p - s >= max(least, 2 * p):
                out.setdefault((s, i + p), p)
    return sorted((s, e - s, p) for (s, e), p in out.items())


def some_text(rnd):
    kind, n = rnd.random(), rnd.randint(0, 150)
    if kind < 0.3:
        return [rnd.randint(0, 1) for _ in range(n)]
    if kind < 0.4:
        return [0] * n
    if kind < 0.8:
        out = []
        while len(out) < n:
            out += [rnd.randint(0, 3) for _ in range(rnd.randint(1, 14))] * rnd.randint(1, 6)
        return out
    a, b = [0], [0, 1]  # Fibonacci words are full of runs
    while len(b) < n:
        a, b = b, b + a
    return b


def test_runs_are_brute_force():
    rnd = random.Random(4)
    for least in (2, 12, 13):
        for _ in range(120):
            texts = [some_text(rnd) for _ in range(rnd.randint(1, 6))]
            got = R.runs_of([np.array(t, dtype=np.int64) for t in texts], least)
            assert [[tuple(x) for x in g.tolist()] for g in got] == [brute(t, least) for t in texts]


def test_grammar_extensions_are_plain_ones():
    rnd = random.Random(5)
    text = some_text(rnd) + some_text(rnd) + [0] * 40 + [0, 1] * 30
    whole = np.array([0, *[x + 2 for x in text], 1])
    grammar = R.Grammar(whole, 2)
    x = np.array([rnd.randrange(1, len(whole) - 1) for _ in range(600)])
    y = np.array([rnd.choice([j for j in range(1, len(whole) - 1) if j != i]) for i in x])
    for back in (False, True):
        step = -1 if back else 1
        for i, j, got in zip(x, y, grammar.common(x, y, back)):
            n = 0
            while whole[i + step * n] == whole[j + step * n]:
                n += 1
            assert n == got
    assert (grammar.blocky[:-1]).any() and not grammar.blocky.all()


def test_chunks_do_not_matter(monkeypatch):
    texts = [np.array(some_text(random.Random(i)), dtype=np.int64) for i in range(20)]
    want = [g.tolist() for g in R.runs_of(texts)]
    monkeypatch.setattr(R, "CHUNK", 7)
    assert [g.tolist() for g in R.runs_of(texts)] == want


def test_long_texts():
    rnd = np.random.default_rng(1)
    unit = rnd.integers(0, 5000, 30_000)
    text = np.concatenate([rnd.integers(0, 5000, 1000), unit, unit, unit[:5], np.full(200_000, 7)])
    got = [tuple(x) for x in R.runs_of([text])[0].tolist()]
    assert (1000, 60_005, 30_000) in got and got[-1][1:] == (200_000, 1)


def slow_digest(i, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 == 0 and n:
        g, first = h // 10, list(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [first[a + (x - a) % p] if x >= a else first[x] for x in range(n)]
    runs = brute(words)
    gone = {x for s, size, q in runs for x in range(s + q, s + size)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join("%d,%d,%d\n" % r for r in runs).encode()),
            sha(b" ".join(w for x, w in enumerate(words) if x not in gone)))


def test_query_is_brute_force(spark):
    rnd = random.Random(7)
    rows = [(i, "".join(f"w{x}" + rnd.choice(" \t\n\x0b ") for x in some_text(rnd))) for i in range(250)]
    rows += [(None, None), (3, ""), (3, " \n"), (None, "é é " * 30), (9, "a " * 5000), (9, "a " * 5000), (20, "x\x1cy z " * 8)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, runs int")
    got = R.digest(R.find_runs(docs, rewrite=R.planted))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(str(slow_digest(i, t)) for i, t in rows)
    assert R.find_runs(docs.limit(0)).collect() == []


def test_spans_and_texts(spark):
    docs = spark.createDataFrame([(1, "x " + "a b c " * 5 + "y")], "doc_id long, text string")
    row = R.find_runs(docs, keep_text=True).collect()[0]
    assert [tuple(r) for r in row.runs] == [(1, 15, 3)] and row.n_words == 17
    assert row.collapsed == "x a b c y" and row.text == "x " + "a b c " * 5 + "y"
