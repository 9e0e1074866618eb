"""Hard-negative mining by a secondary-sort shuffle.

For every anchor row: its first positives (rows of its label by descending integer
inner product, ties by id), and for each positive the first rows of other labels whose
score lies in a window below the positive's.

Pairs that can matter are packed into byte keys (anchor, descending score, kind, id)
and dealt by ``repartitionAndSortWithinPartitions``: one iterator per partition reads an
anchor's pairs in descending score, opens a window at each positive, emits negatives
into the open windows and forgets an anchor when the next one begins.  Nothing is held
per anchor but its open windows.

The stated queries meet all rows in blocks: anchors in blocks of ``ANCHORS``, rows in
blocks of ``ROWS``; a copy of each anchor block is sent to every row block (an equi-join
on the block number), where one matrix product scores the pairs.  A pair leaves its block
only if it can be in the result: for positives the block's own first ones; then, with the
scores of the true positives known, for each window the block's own first negatives.
Both are exact, since the first k of all rows are among the first k of their blocks.
Products run in float32 or float64 where the components prove that no sum is rounded, and
in Python integers otherwise.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatwise.llm.common import land

ANCHORS, ROWS = 512, 8192
_KEY = struct.Struct(">QQBQ")
_SIGN = 1 << 63
_LOW, _HIGH = -_SIGN, _SIGN - 1
POSITIVE, NEGATIVE = 0, 1


def pack(anchor: int, score: int, kind: int, vec_id: int) -> bytes:
    """A key whose byte order is (anchor, descending score, positives first, id)."""
    return _KEY.pack(anchor + _SIGN, _HIGH - score, kind, vec_id + _SIGN)


def unpack(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, vec_id = _KEY.unpack(key)
    return anchor - _SIGN, _HIGH - score, kind, vec_id - _SIGN


def _dealt(key: bytes) -> int:
    return zlib.crc32(key[:8])


def _floor(x):
    """Floor of a double as a double; ``F.floor`` gives a long, which huge components do not fit."""
    near = F.rint(x)
    return F.when(near > x, near - 1.0).otherwise(near)


def usable_rows(table: DataFrame, scale: int = 256, id_col: str = "vec_id", label_col: str = "label",
                vector_col: str = "embedding") -> DataFrame:
    """(vec_id, label, parts): ``parts`` is floor(scale * x) of each component, as doubles.

    Rows with a null id, label or vector, or a null or non-finite component (before or
    after scaling), take no part.
    """
    parts = F.transform(table[vector_col].cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    rows = table.select(table[id_col].cast("long").alias("vec_id"), table[label_col].cast("long").alias("label"),
                        parts.alias("parts"))
    finite = F.forall("parts", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("parts").isNotNull() & finite)
            .withColumn("parts", F.transform("parts", _floor)))


BLOCK = "block long, tag binary, id binary, label binary, n int, width int, vectors binary"


def _blocks(rows: DataFrame, size: int, scores: bool = False) -> tuple[DataFrame, int]:
    """``rows`` as blocks of about ``size`` rows, packed into numpy buffers, and how many there are.

    Rows are dealt to the blocks 0, 1, ... by a hash of their tag, which is unique, so no
    key makes a block larger than others and a task that runs again makes the same ones.
    Vectors of fewer components are filled with zeros, which leaves their products as
    they are.  ``scores``: a column of long arrays goes with each row.
    """
    many = max(1, -(-rows.count() // size))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.column(1)[k].values
                vectors = part.field("parts")
                edges = vectors.offsets.to_numpy()
                lengths = np.diff(edges)
                width = int(lengths.max())
                full = np.zeros((len(part), width))
                full[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
                small = width and np.abs(full).max() <= 32767
                longs = [part.field(c).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
                         for c in ("tag", "vec_id", "label")]
                out = [batch.column(0).slice(k, 1), *[pa.array([x], pa.binary()) for x in longs],
                       pa.array([len(part)], pa.int32()), pa.array([width if small else -width], pa.int32()),
                       pa.array([full.astype("<i2" if small else "<f8").tobytes()], pa.binary())]
                names = [f.split()[0] for f in BLOCK.split(", ")]
                if scores:
                    out.append(pa.array([part.field("scores").to_pylist()], pa.list_(pa.list_(pa.int64()))))
                    names.append("scores")
                yield pa.RecordBatch.from_arrays(out, names=names)

    whole = F.struct("tag", "vec_id", "label", "parts", *(["scores"] if scores else []))
    return (rows.groupBy(F.pmod(F.xxhash64("tag"), F.lit(many)).alias("block")).agg(F.collect_list(whole).alias("rows"))
            .mapInArrow(build, BLOCK + (", scores array<array<long>>" if scores else ""))), many


def _exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of two matrices of whole numbers; beyond 64 bits the nearest long."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    bound = width * float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max())
    if bound < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in m] for m in (a.astype(np.float64), b.astype(np.float64))]
    return np.array([[max(_LOW, min(_HIGH, sum(x * y for x, y in zip(u, v)))) for v in whole[1]] for u in whole[0]],
                    dtype=np.int64)


def _score_pairs(met: DataFrame, find) -> DataFrame:
    """(anchor, anchor_id, score, id) of the pairs that ``find`` picks in each meeting of two blocks.

    ``find`` gets the anchors' block and the rows' block, the latter by ascending id, and
    gives places in the first, scores, and places in the second.
    """
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                m = batch.slice(k, 1).to_pylist()[0]
                a = _Block(m, "a_")
                i, s, j = find(a, b := _Block(m, ""), m)
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a.tag[i], a.id[i], s, b.id[j])],
                                                     names=["anchor", "anchor_id", "score", "id"])

    return met.mapInArrow(score, "anchor long, anchor_id long, score long, id long")


class _Block:
    """Numpy views of a packed block, rows by ascending id."""

    def __init__(self, m: dict, mark: str):
        self.tag, self.id, self.label = (np.frombuffer(m[mark + c], "<i8") for c in ("tag", "id", "label"))
        n, width = m[mark + "n"], m[mark + "width"]
        self.vectors = np.frombuffer(m[mark + "vectors"], "<i2" if width > 0 else "<f8").reshape(n, abs(width))
        if not mark:
            order = np.argsort(self.id, kind="stable")
            self.tag, self.id, self.label, self.vectors = (
                x[order] for x in (self.tag, self.id, self.label, self.vectors))


def _joined(parts: list[tuple]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, dtype=np.int64)] * 3


def _firsts(group: np.ndarray, score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first ``k`` of each group by descending score, then place."""
    order = np.lexsort((place, -score, group))
    g = group[order]
    heads = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(g)) - np.repeat(heads, np.diff(np.append(heads, len(g))))
    return order[rank < k]


def _best_positives(k: int):
    def find(a: _Block, b: _Block, m: dict) -> list[np.ndarray]:
        out = []
        for label in np.intersect1d(a.label, b.label):
            ai, bi = np.flatnonzero(a.label == label), np.flatnonzero(b.label == label)
            s = _exact_scores(a.vectors[ai], b.vectors[bi])
            other = a.tag[ai][:, None] != b.tag[bi][None, :]
            if len(bi) > k + 1:  # a row below the block's score k + 1 is none of its first k others
                other &= s >= np.partition(s, len(bi) - k - 1, axis=1)[:, len(bi) - k - 1, None]
            x, y = np.nonzero(other)
            first = _firsts(x, s[x, y], y, k)
            x, y = x[first], y[first]
            out.append((ai[x], s[x, y], bi[y]))
        return _joined(out)
    return find


def _best_negatives(k: int, low: int, high: int):
    def find(a: _Block, b: _Block, m: dict) -> list[np.ndarray]:
        out = []
        windows = [[w for w in (window(s, low, high) for s in scores) if w] for scores in m["a_scores"]]
        for label in np.unique(a.label):
            ai, bi = np.flatnonzero(a.label == label), np.flatnonzero(b.label != label)
            s = _exact_scores(a.vectors[ai], b.vectors[bi])
            for i, row in zip(ai.tolist(), s):
                if not windows[i]:
                    continue
                at = np.flatnonzero((row >= min(w[0] for w in windows[i])) & (row <= max(w[1] for w in windows[i])))
                at = at[np.lexsort((at, -row[at]))]
                falling = -row[at]
                keep = np.zeros(len(at), dtype=bool)
                for least, most in windows[i]:
                    x = int(np.searchsorted(falling, -most, side="left"))
                    keep[x:min(x + k, int(np.searchsorted(falling, -least, side="right")))] = True
                at = at[keep]
                out.append((np.full(len(at), i), row[at], bi[at]))
        return _joined(out)
    return find


def _sorted_pairs(pairs: DataFrame, partitions: int):
    """The secondary sort: (packed key, anchor id), each anchor whole in one partition, in key order."""
    return (pairs.rdd.map(lambda r: (pack(r.anchor, r.score, r.kind, r.id), r.anchor_id))
            .repartitionAndSortWithinPartitions(partitions, _dealt))


def _first_positives(k: int):
    def read(pairs: Iterator[tuple[bytes, int]]) -> Iterator[tuple[int, int, int, int]]:
        last, seen = None, 0
        for key, anchor_id in pairs:
            anchor, score, _, vec_id = unpack(key)
            seen = seen + 1 if anchor == last else 1
            last = anchor
            if seen <= k:
                yield anchor, anchor_id, score, vec_id
    return read


def window(score: int, low: int, high: int) -> tuple[int, int] | None:
    """The whole scores s with low * score <= 100 * s <= high * score; None if there are none."""
    least, most = -(-low * score // 100), high * score // 100
    return (max(least, _LOW), min(most, _HIGH)) if least <= most else None


def _emit_negatives(negatives: int, low: int, high: int):
    def read(pairs: Iterator[tuple[bytes, int]]) -> Iterator[tuple[int, int, int, int, int, int]]:
        last, opened = None, []
        for key, anchor_id in pairs:
            anchor, score, kind, vec_id = unpack(key)
            if anchor != last:
                last, opened = anchor, []
            if kind == POSITIVE:
                span = window(score, low, high)
                if span:
                    opened.append([vec_id, score, *span, 0])
                continue
            for w in opened:
                if w[2] <= score <= w[3]:
                    w[4] += 1
                    yield anchor_id, w[0], w[4], vec_id, w[1], score
            opened = [w for w in opened if w[4] < negatives and w[2] <= score]
    return read


def mine(table: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         label_of=None, scale: int = 256, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor(id)`` and ``label_of(id, label)`` are expressions over columns.  A row's
    score is its integer inner product with the anchor over the components both have; ties
    go to the smaller id.  Window of a positive: low * score <= 100 * negative <= high *
    score, so a positive below zero has none.

    Rows that cannot take part: see ``usable_rows``.  Rows that repeat an id are rows of
    their own, as anchors too; an anchor's own row is no positive of it, its twins are.
    An empty vector scores zero with every row; scores beyond 64 bits count as the nearest
    long.  No usable anchor, positive or negative gives no row.
    """
    spark = table.sparkSession
    rows = usable_rows(table, scale, id_col, label_col, vector_col)
    if label_of is not None:
        rows = rows.withColumn("label", label_of(F.col("vec_id"), F.col("label")).cast("long")).filter("label IS NOT NULL")
    # the tag tells rows of one id apart; written once, so that no later run of a task changes it
    rows = land(rows.withColumn("tag", F.monotonically_increasing_id()), "vectors")
    anchors = rows.filter(is_anchor(F.col("vec_id")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed, many = _blocks(rows, ROWS)
    packed = land(packed, "vector-blocks")
    deal = min(max(many, parts), 100_000)  # few bytes, much work: not to be merged into fewer tasks

    def met(asked: DataFrame) -> DataFrame:
        """Each anchor block beside each row block, dealt by the number of the row block."""
        copies = (asked.select(*[F.col(c).alias(f"a_{c}") for c in asked.columns])
                  .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(many - 1)).cast("array<long>"))))
        return copies.repartition(deal, "block").join(packed.repartition(deal, "block"), "block")

    def kind(pairs: DataFrame, which: int) -> DataFrame:
        return pairs.withColumn("kind", F.lit(which))

    pair = T.StructType([T.StructField(c, T.LongType()) for c in ("anchor", "anchor_id", "score", "id")])
    near = _score_pairs(met(_blocks(anchors, ANCHORS)[0]), _best_positives(positives))
    firsts = _sorted_pairs(kind(near, POSITIVE), parts).mapPartitions(_first_positives(positives))
    firsts = land(spark.createDataFrame(firsts, pair, verifySchema=False), "positives")

    opened = (firsts.filter(F.col("score") >= 0).groupBy(F.col("anchor").alias("tag"))
              .agg(F.collect_set("score").alias("scores")))  # at most ``positives`` an anchor
    asked = land(anchors.join(opened, "tag"), "asked-anchors")
    far = _score_pairs(met(_blocks(asked, ANCHORS, scores=True)[0]), _best_negatives(negatives, low, high))
    both = kind(firsts, POSITIVE).unionByName(kind(far, NEGATIVE))
    mined = _sorted_pairs(both, parts).mapPartitions(_emit_negatives(negatives, low, high))
    return spark.createDataFrame(mined, T.StructType([
        T.StructField(c, T.IntegerType() if c == "rank" else T.LongType())
        for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")]),
        verifySchema=False)
