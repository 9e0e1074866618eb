"""Quality rules: fixed base rules and gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled rows and flattened into numpy node
arrays (feature, threshold, children, value), which score a whole batch of documents
per tree level.  Chosen features carry a monotonic constraint: more symbols, repeated
lines or repeated words can only lower a document's score.

Statistics and scoring are map-only; only the labelled sample, at most
``max_labels`` rows of a dozen numbers, is gathered to fit the trees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatwise.llm.common import named

_SPACE, _SYMBOLS, _MARKS = b" \t\n\x0b\x0c\r", b"#*$%&|<>", b".,!?;:"
_UPPER, _LOWER, _DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_HIGH = bytes(range(128, 256))  # of code points beyond ASCII; counted as letters

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Features of the trees and the direction in which each may move the score (0: either).
FEATURES = {
    "log_words": 0, "chars_per_word": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_word_share": -1,
    "distinct_word_share": 0, "upper_share": 0, "digit_share": 0, "punctuation_per_word": 0, "line_end_share": 0,
    "short_word_share": 0, "top_word_share": -1,
}
MONOTONE = np.array(list(FEATURES.values()))

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, score double, kept boolean")


# ---- statistics ------------------------------------------------------------------

def repeat_words(words: list[bytes], size: int = 3) -> int:
    """Words that stand in a window of ``size`` words found at least twice in the text."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    key = ids[:n]
    for k in range(1, size):  # windows numbered anew at each step, so the product stays small
        _, key = np.unique(key * len(number) + ids[k:n + k], return_inverse=True)
    often = np.bincount(key)[key] > 1
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covered, np.flatnonzero(often), 1)
    np.add.at(covered, np.flatnonzero(often) + size, -1)
    return int((np.cumsum(covered) > 0).sum())


def _count(raw: bytes, members: bytes) -> int:
    return len(raw) - len(raw.translate(None, members))


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The five base counts and the features of one text."""
    raw = text.encode()
    words = raw.split()  # bytes: ASCII white space only
    n = len(words)
    lines = text.split("\n")
    filled = [x for x in lines if x.strip(" \t\n\x0b\x0c\r")]
    dup_lines = len(filled) - len(set(filled))
    chars = len(text) - _count(raw, _SPACE)
    symbols = _count(raw, _SYMBOLS)
    repeats = repeat_words(words)
    base = [n, chars, symbols, dup_lines, repeats]
    upper = _count(raw, _UPPER)
    letters = upper + _count(raw, _LOWER) + len(text) - (len(raw) - _count(raw, _HIGH))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    per = 1.0 / max(n, 1)
    ended = sum(x.rstrip().endswith((".", "!", "?", ":")) for x in filled)
    features = [np.log1p(n), chars * per, symbols * per, dup_lines / max(len(filled), 1), repeats * per,
                len(counts) * per, upper / max(letters, 1), _count(raw, _DIGITS) / max(chars, 1),
                _count(raw, _MARKS) * per, ended / max(len(filled), 1),
                sum(len(w) <= 2 for w in words) * per, max(counts.values(), default=0) * per]
    return base, features


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


# ---- trees -----------------------------------------------------------------------

@dataclass
class Forest:
    """Trees as flat node arrays; a leaf's children are the leaf itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality of each row."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node]
        return 1.0 / (1.0 + np.exp(-total))


def fit_forest(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 3,
               rate: float = 0.15, bins: int = 64, min_weight: float = 2.0, l2: float = 1.0) -> Forest:
    """Newton boosting of the logistic loss on binned features with monotonic constraints.

    A split on a constrained feature is taken only if its children's values are in
    order; their mid value then bounds all values below on either side.
    """
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(m)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    total = np.full(n, bias)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def add() -> int:
        k = len(value)
        feature.append(0), threshold.append(0.0), left.append(k), right.append(k), value.append(0.0)
        return k

    def best_split(rows, g, h, low, high):
        def weight(gs, hs):
            return np.clip(-gs / (hs + l2), low, high)

        def loss(gs, hs, w):
            return gs * w + 0.5 * (hs + l2) * w * w

        gs, hs = g[rows].sum(), h[rows].sum()
        stay = loss(gs, hs, weight(gs, hs))
        best = (1e-6, None)
        for j in range(m):
            if not len(cuts[j]):
                continue
            size = len(cuts[j]) + 1
            gl = np.cumsum(np.bincount(binned[rows, j], weights=g[rows], minlength=size))[:-1]
            hl = np.cumsum(np.bincount(binned[rows, j], weights=h[rows], minlength=size))[:-1]
            wl, wr = weight(gl, hl), weight(gs - gl, hs - hl)
            gain = stay - loss(gl, hl, wl) - loss(gs - gl, hs - hl, wr)
            ok = (hl >= min_weight) & (hs - hl >= min_weight) & (monotone[j] * (wr - wl) >= 0)
            gain = np.where(ok, gain, -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (j, k, wl[k], wr[k]))
        return best[1]

    def grow(node, rows, g, h, low, high, level):
        split = best_split(rows, g, h, low, high) if level < depth and len(rows) > 1 else None
        if split is None:
            gs, hs = g[rows].sum(), h[rows].sum()
            value[node] = rate * float(np.clip(-gs / (hs + l2), low, high))
            total[rows] += value[node]
            return
        j, k, wl, wr = split
        goes = binned[rows, j] <= k
        mid = (wl + wr) / 2
        bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid)), 0: ((low, high), (low, high))}
        feature[node], threshold[node] = j, float(cuts[j][k])
        left[node], right[node] = add(), add()
        for child, part, (lo, hi) in zip((left[node], right[node]), (rows[goes], rows[~goes]), bounds[int(monotone[j])]):
            grow(child, part, g, h, lo, hi, level + 1)

    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-total))
        roots.append(add())
        grow(roots[-1], np.arange(n), p - y, np.maximum(p * (1 - p), 1e-6), -np.inf, np.inf, 0)
    return Forest(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value),
                  np.array(roots), depth, bias)


# ---- Spark -------------------------------------------------------------------------

def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def train(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000, id_col: str = "doc_id",
          text_col: str = "text") -> Forest | None:
    """Trees fitted on at most ``max_labels`` labelled documents, chosen by a hash of the id.

    Labels with a null id or quality are left out; of repeated labels the smallest
    quality counts; of documents that share an id each is a row, within twice the bound.
    Without rows of both classes there is no model.
    """
    chosen = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("quality"))
              .where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t or "")[1] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))],
                                             names=["quality", "x"])

    rows = (_slim(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("quality", "text")
            .mapInArrow(run, "quality int, x array<double>").limit(2 * max_labels).toPandas())
    if rows["quality"].nunique() < 2:
        return None
    # in a fixed order, so that the sums don't depend on the partitioning
    x, y = np.array(rows["x"].tolist()), rows["quality"].to_numpy(dtype=float)
    order = np.lexsort((*x.T, y))
    return fit_forest(x[order], y[order], MONOTONE)


def score_documents(docs: DataFrame, forest: Forest | None, threshold: float = 0.5, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Statistics, score and verdict of every row.

    ``kept`` is false if a base rule fails, else whether the score reaches
    ``threshold``; without a model the score is null and the base rules alone decide.
    Null or empty text has no words and fails; repeated rows come out each; a null id
    stays null; other columns are left out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(forest)  # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [statistics(t or "") for t in batch.column(1).to_pylist()]
            if not got:
                continue
            base = np.array([b for b, _ in got], dtype=np.int64)
            failed = np.array([base_failed(b[0], b[4]) for b, _ in got])
            if sent.value is None:
                score, kept = pa.nulls(len(got), pa.float64()), ~failed
            else:
                p = sent.value.score(np.array([x for _, x in got]))
                score, kept = pa.array(p), ~failed & (p >= threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(base[:, i]) for i in range(5)), pa.array(failed), score, pa.array(kept)],
                names=["doc_id", *BASE, "base_failed", "score", "kept"])

    return _slim(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, forest: Forest | None, threshold: float = 0.5, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are."""
    from pyspark.sql import types as T

    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [statistics(t or "") for t in batch.column(1).to_pylist()]
            if not got:
                continue
            kept = np.array([not base_failed(b[0], b[4]) for b, _ in got])
            if sent.value is not None:
                kept &= sent.value.score(np.array([x for _, x in got])) >= threshold
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(kept)),
                                              batch.column(1).filter(pa.array(kept))], names=["row", "text"])

    others = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*[named(c).alias(c) for c in others]).alias("row"), named(text_col).cast("string").alias("text"))
    schema = T.StructType([packed.schema["row"], T.StructField("text", T.StringType())])
    out = packed.mapInArrow(run, schema)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
