"""Periodic runs in word sequences by recompression.

A run is a stretch of consecutive words with smallest period q and at least
``max(min_words, 2 q)`` words that no neighbouring word extends.  The texts of a batch
are laid end to end with a symbol of its own between any two.  Alternate block
compression (equal neighbours become one symbol) and pair compression (symbols of
class 0 before class 1 become one) shrink that sequence until each text is one symbol;
the levels are the run-length grammar.  Equal stretches are compressed alike but for
their borders, so two cursors that climb, step and descend the levels together answer
how far two places agree (forward and backward) in a number of steps that grows with
the count of levels.

Candidates come from the harmonic grid: a run of period p agrees with itself p words
later on at least ``g = max(min_words - p, p)`` places, so one of the places 0, g, 2 g,
... lies in it.  That is n log n candidates for n words; those whose two words agree
are extended to both sides by the grammar.  No suffix array, no table of all pairs.

Map-only: a task holds one slice of texts (about ``SLICE_BYTES``, one text at least)
and its levels, a small multiple of that slice; candidates are made ``CHUNK`` at a time.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatwise.llm.common import text_slices

SLICE_BYTES = 2 << 20
CHUNK = 1 << 20


class Grammar:
    """The levels of a recompressed sequence whose symbols below ``marks`` occur once each.

    These marks are never compressed; the first and the last symbol must be marks, so
    that no common extension leaves the sequence.
    """

    def __init__(self, symbols: np.ndarray, marks: int):
        level, fresh, turn = symbols.astype(np.int64), int(symbols.max()) + 1, 0
        syms, ups, firsts, blocky = [level], [], [], []

        def climb(opens: np.ndarray, codes: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], block: bool) -> None:
            nonlocal level, fresh
            first = np.flatnonzero(opens)
            which, code = codes(first)
            up = level[first].copy()
            names, at = np.unique(code, return_inverse=True)
            up[which] = fresh + at
            fresh += len(names)
            ups.append(np.cumsum(opens) - 1)
            firsts.append(np.append(first, len(level)))
            blocky.append(block)
            level = up
            syms.append(level)

        while True:
            opens = np.append(True, level[1:] != level[:-1])
            if not opens.all():
                def blocks(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                    sizes = np.diff(np.append(first, len(level)))
                    which = np.flatnonzero(sizes > 1)
                    return which, level[first[which]] << 32 | sizes[which]
                climb(opens, blocks, True)
            plain = level >= marks
            if not (plain[1:] & plain[:-1]).any():
                break
            turn += 1
            # a class bit for each symbol, drawn anew each turn; the order with more pairs is taken
            drawn = (level * (0x9E3779B97F4A7C15 >> 1 | 1) ^ (turn * 0x2545F4914F6CDD1D & (1 << 62) - 1))
            drawn = (drawn ^ drawn >> 29) * 0x3F58476D1CE4E5B9
            side = drawn >> 40 & 1
            near = plain[1:] & plain[:-1]
            up, down = near & (side[:-1] < side[1:]), near & (side[:-1] > side[1:])
            pair = up if np.count_nonzero(up) >= np.count_nonzero(down) else down
            if not pair.any():
                continue
            opens = np.append(True, ~pair)

            def pairs(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                which = np.flatnonzero(np.append(pair, False)[first])
                return which, level[first[which]] << 32 | level[first[which] + 1]
            climb(opens, pairs, False)

        def joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            at = np.cumsum([0] + [len(x) for x in parts])
            return (np.concatenate(parts) if parts else np.zeros(0)).astype(np.int32), at.astype(np.int64)

        self.top = len(ups)
        self.sym, self.sym_at = joined(syms)
        self.up, self.up_at = joined(ups + [np.zeros(0)])
        self.first, self.first_at = joined(firsts + [np.zeros(0)])
        self.blocky = np.array(blocky + [False])

    def common(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols from ``x`` and from ``y`` on (``back``: up to them) agree, for places x != y."""
        out = np.zeros(len(x), dtype=np.int64)
        who, a, b = np.arange(len(x)), x.astype(np.int64), y.astype(np.int64)
        lev, falling = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=bool)
        start = a.copy()
        while len(who):
            here = self.sym_at[lev]
            same = self.sym[here + a] == self.sym[here + b]
            done = ~same & (lev == 0)
            if done.any():
                out[who[done]] = np.abs(a[done] - start[done])
                go = ~done
                who, a, b, lev, falling, start, same = who[go], a[go], b[go], lev[go], falling[go], start[go], same[go]
                if not len(who):
                    break
            # unequal symbols: both cursors go to the first (last) symbol below
            fall = np.flatnonzero(~same)
            below = lev[fall] - 1
            base = self.first_at[below]
            a[fall] = self.first[base + a[fall] + back] - back
            b[fall] = self.first[base + b[fall] + back] - back
            # equal: climb where both are the border of equal symbols above, else step on
            eq = np.flatnonzero(same)
            if len(eq):
                le, ae, be = lev[eq], a[eq], b[eq]
                inner = le < self.top
                some = np.minimum(le, self.top - 1) if self.top else le
                step = np.ones(len(eq), dtype=np.int64)
                rise = np.zeros(len(eq), dtype=bool)
                if self.top:
                    ua = self.up[self.up_at[some] + np.where(inner, ae, 0)].astype(np.int64)
                    ub = self.up[self.up_at[some] + np.where(inner, be, 0)].astype(np.int64)
                    base = self.first_at[some]
                    if back:
                        left_a, left_b = ae - self.first[base + ua] + 1, be - self.first[base + ub] + 1
                        edge = (self.first[base + ua + 1] == ae + 1) & (self.first[base + ub + 1] == be + 1)
                    else:
                        left_a, left_b = self.first[base + ua + 1] - ae, self.first[base + ub + 1] - be
                        edge = (self.first[base + ua] == ae) & (self.first[base + ub] == be)
                    above = self.sym_at[some + 1]
                    rise = inner & edge & ~falling[eq] & (self.sym[above + ua] == self.sym[above + ub])
                    step = np.where(inner & self.blocky[le], np.minimum(left_a, left_b), 1)
                step = -step if back else step
                a[eq] = np.where(rise, ua if self.top else ae, ae + step)
                b[eq] = np.where(rise, ub if self.top else be, be + step)
                lev[eq] = le + rise
            lev[fall] = below
            falling[fall] = True
        return out


def runs_of(texts: list[np.ndarray], min_words: int = 12) -> list[np.ndarray]:
    """For each array of word numbers (from 0) its runs, rows (start, length, period) by start, then period."""
    n = np.array([len(t) for t in texts], dtype=np.int64)
    marks = len(texts) + 1
    base = np.cumsum(np.append(1, n[:-1] + 1)) if len(texts) else np.zeros(0, dtype=np.int64)
    whole = np.empty(int(n.sum()) + marks, dtype=np.int64)
    whole[0] = 0
    for k, t in enumerate(texts):
        whole[base[k]:base[k] + n[k]] = t
        whole[base[k]:base[k] + n[k]] += marks
        whole[base[k] + n[k]] = k + 1
    asked = np.where(n >= max(min_words, 2), n // 2, 0)
    if not asked.any():
        return [np.zeros((0, 3), dtype=np.int64) for _ in texts]
    grammar = Grammar(whole, marks)
    plain = grammar.sym[:len(whole)]

    of = np.repeat(np.arange(len(texts)), asked)
    period = np.arange(len(of)) - np.repeat(np.cumsum(asked) - asked, asked) + 1
    order = np.argsort(period, kind="stable")
    of, period = of[order], period[order]
    grid = np.maximum(min_words - period, period)
    counts = -((period - n[of]) // grid)
    ends = np.cumsum(counts)
    starts = base[of]
    found: list[np.ndarray] = []
    # at each place the last word and the period of a known run: what such a run answers is not asked again
    known_end, known_q = np.zeros(len(whole), dtype=np.int64), np.ones(len(whole), dtype=np.int64)
    at, small = 0, int(np.searchsorted(period, min_words, side="right"))
    while at < len(of):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + CHUNK, side="right")))
        to = min(to, small) if at < small else to
        c = counts[at:to]
        k = np.arange(int(ends[to - 1]) - before) - np.repeat(ends[at:to] - c - before, c)
        i = np.repeat(starts[at:to], c) + k * np.repeat(grid[at:to], c)
        p = np.repeat(period[at:to], c)
        hit = np.flatnonzero(plain[i] == plain[i + p])
        i, p = i[hit], p[hit]
        ask = (p % known_q[i] != 0) | (i + p >= known_end[i])
        i, p = i[ask], p[ask]
        after = grammar.common(i, i + p)
        ahead = grammar.common(i - 1, i + p - 1, back=True)
        good = after + ahead >= np.maximum(min_words - p, p)
        i, p, after, ahead = i[good], p[good], after[good], ahead[good]
        if len(i):
            rows = np.unique(np.stack([i - ahead, i + p + after, p], axis=1), axis=0)
            found.append(rows)
            if at < small:  # runs of few words to a period answer most of the later candidates
                for s, e, q in rows[np.argsort(-rows[:, 2], kind="stable")].tolist() if len(rows) <= 4096 else ():
                    known_end[s:e], known_q[s:e] = e, q
        at = to
    if not found:
        return [np.zeros((0, 3), dtype=np.int64) for _ in texts]
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))  # the least period of a stretch
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    text = np.searchsorted(base, rows[:, 0], side="right") - 1
    out = np.stack([rows[:, 0] - base[text], rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)
    cuts = np.searchsorted(text, np.arange(1, len(texts)))
    return np.split(out, cuts)


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay if every run keeps its first period only."""
    if not len(runs):
        return np.ones(n, dtype=bool)
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


SCHEMA = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string, "
          "collapsed string")


def find_runs(docs: DataFrame, min_words: int = 12, rewrite: Callable[[int | None, int], np.ndarray | None] | None = None,
              id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, runs, text, collapsed: one row per row of ``docs``.

    Words are runs of characters other than ASCII white space.  ``runs`` holds (start,
    length, period) by start, then period; ``collapsed`` the words that stay if every run
    keeps its first period only, joined by one space.  ``rewrite(id, n)`` may give, for a
    text of n words, the numbers of the words to read in their place.  ``text`` is the
    sequence searched, joined by one space, with ``keep_text``, else null.

    Null, empty and white texts have no words, no runs and an empty ``collapsed``; null
    and repeated ids are rows like others; further columns are left out.  A text of any
    length is searched whole.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary").alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 1, size=SLICE_BYTES):
                yield _search_slice(part, min_words, rewrite, keep_text)

    return rows.mapInArrow(search, SCHEMA)


def _search_slice(part: pa.RecordBatch, min_words: int, rewrite, keep_text: bool) -> pa.RecordBatch:
    ids = part.column(0).to_pylist()
    words = [t.split() for t in part.column(1).to_pylist()]
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    texts = []
    for k, (i, ws) in enumerate(zip(ids, words)):
        picked = rewrite(i, len(ws)) if rewrite is not None and ws else None
        if picked is not None:
            words[k] = ws = [ws[x] for x in picked.tolist()]
        texts.append(np.array(list(map(numbers.__getitem__, ws)), dtype=np.int64))
    runs = runs_of(texts, min_words)
    collapsed = []
    for ws, r in zip(words, runs):
        if len(r):
            ws = [ws[x] for x in np.flatnonzero(kept_words(len(ws), r)).tolist()]
        collapsed.append(b" ".join(ws))
    flat = np.concatenate(runs) if runs else np.zeros((0, 3), dtype=np.int64)
    spans = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], names=["start", "length", "period"])
    offsets = pa.array(np.cumsum([0] + [len(r) for r in runs]), pa.int32())
    shown = pa.array([b" ".join(ws) for ws in words], pa.binary()) if keep_text else pa.nulls(len(words), pa.binary())
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array([len(ws) for ws in words], pa.int64()), pa.ListArray.from_arrays(offsets, spans),
         shown.cast(pa.string()), pa.array(collapsed, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "text", "collapsed"])


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: least start, then period) and the digests of runs and kept words."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    out = found.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.p")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The rewriting that the query's contract states: every tenth id by CRC-32 gets a periodic tail.

    With h the CRC-32 of the decimal id and g = h // 10, word i from a = g % n on reads as
    word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).  A null id is left alone.
    """
    if doc_id is None:
        return None
    h = zlib.crc32(b"%d" % doc_id)
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    words = np.arange(n)
    words[a:] = a + (words[a:] - a) % p
    return words
