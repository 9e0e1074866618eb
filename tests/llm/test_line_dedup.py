"""Line dedup against a brute-force version; the minimal perfect hash by its definition."""

from collections import defaultdict

import numpy as np
import pytest

from heatwise.llm import line_dedup as L


def brute(rows, min_chars=20, min_docs=3):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))

    below = -(1 << 63)
    holders = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].append(below if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == (below if i is None else i)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 50, 1000, 20000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)
    keys = np.unique(keys)
    seeds = L.build_perfect_hash(keys)
    assert sorted(L.places(keys, seeds, len(keys)).tolist()) == list(range(len(keys)))
    other = L.places(keys + np.uint64(1), seeds, len(keys))
    assert other.min() >= 0 and other.max() < len(keys)


def _rows():
    hot = "This Line is in very many documents, and Long"
    rnd = np.random.default_rng(1)
    pool = [f"shared line number {k} ÄÖ long enough" for k in range(30)] + ["short", "", " \t ", hot]
    rows = []
    for i in range(120):
        lines = [pool[k] for k in rnd.integers(0, len(pool), rnd.integers(0, 9))]
        if i % 3 == 0:
            lines += ["  " + hot.upper() + "\r", hot]
        rows.append((i, "\n".join([*lines, f"own line of document {i} here"])))
    exact = "twenty code points é"
    rows += [(200, exact), (201, exact + " "), (202, "\t" + exact), (203, exact[:-1]), (204, exact[:-1]), (205, exact[:-1])]
    rows += [(300, None), (301, ""), (None, hot), (None, hot), (50, rows[50][1]), (400, "\n".join([hot] * 5000))]
    return rows


@pytest.mark.parametrize("shard_keys", [1 << 14, 4])
def test_dedup_is_brute_force(spark, monkeypatch, shard_keys):
    monkeypatch.setattr(L, "SHARD_KEYS", shard_keys)
    rows = _rows()
    df = spark.createDataFrame([(i, t, "l", 5) for i, t in rows], "doc_id long, text string, lang string, n_lines long")
    out = L.dedup_lines(df, salts=3)
    assert out.columns == ["doc_id", "text", "lang", "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=repr)
    assert got == brute(rows)


def test_empty_table_and_no_repeats(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert L.dedup_lines(empty).count() == 0
    one = spark.createDataFrame([(1, "a line that nobody else has\nx")], "doc_id long, text string")
    assert [(r.text, r.n_lines, r.n_dropped) for r in L.dedup_lines(one).collect()] == [("a line that nobody else has\nx", 2, 0)]
