"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance d meet in a variant that lies between them.  With a
maximum distance of 3 the ball of half the radius (one bit) makes all pairs up to two
bits meet: members of one variant are at most two bits apart, so they are linked as a
star, without a pair list.  What is left are pairs three bits apart.  Of the two 32-bit
halves of such a pair one differs in at most one bit, so the same ball on a half makes
them meet there; colliding members of different groups are verified on all 64 bits.
(The other side of the whole-word ball would be 2,081 variants a fingerprint instead of
34; see the README.)

All of this runs on distinct fingerprints; copies collapse before anything is emitted.
Groups are the connected components of the links, found by alternating large-star and
small-star rounds on the edge table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatwise.llm.common import keyed_documents, land, packed_rows, unpacked

SEED = 42
MAX_DISTANCE = 3


def fingerprint(text: bytes, size: int = 3) -> int:
    """64-bit SimHash over word shingles: a bit is set if it is in over half the hashes."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - size + 1
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist())),
                         dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8),
                              axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, fp) of every row: a hash of the text, and the fingerprint as a signed 64-bit integer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, size) for t in batch.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "th", "fp"])

    rows = keyed_documents(docs, id_col, text_col)
    return rows.select("doc_id", "th", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, th long, fp long")


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of equal neighbours."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return starts, np.append(starts[1:], len(keys))


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Sorted batches as column arrays that never cut a run of the first column in two."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        cols = [batch.column(i).to_numpy() for i in range(batch.num_columns)]
        if not len(cols[0]):
            continue
        if held is not None:
            cols = [np.concatenate([a, b]) for a, b in zip(held, cols)]
        if cols[0][0] == cols[0][-1]:
            held = cols
            continue
        cut = int(np.searchsorted(cols[0], cols[0][-1]))
        yield [c[:cut] for c in cols]
        held = [c[cut:] for c in cols]
    if held is not None:
        yield held


def _edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def ball_links(points: DataFrame) -> DataFrame:
    """Edges that connect all fingerprints up to two bits apart: a star per variant with two members or more."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for at in range(0, len(fps), 4096):
                own = fps[at:at + 4096]
                balls = own.view(np.uint64)[:, None] ^ flips
                yield pa.RecordBatch.from_arrays([pa.array(balls.ravel().view(np.int64)), pa.array(np.repeat(own, 65))],
                                                 names=["variant", "fp"])

    def star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for variant, fp in _whole_runs(batches):
            starts, ends = _runs(variant)
            first = np.repeat(fp[starts], ends - starts)
            link = first != fp
            if link.any():
                pairs = np.unique(np.stack([first[link], fp[link]]), axis=1)
                yield _edge_batch(pairs[0], pairs[1])

    return (points.select("fp").mapInArrow(emit, "variant long, fp long")
            .repartition("variant").sortWithinPartitions("variant").mapInArrow(star, "a long, b long"))


def half_links(points: DataFrame) -> DataFrame:
    """Edges between groups: fingerprints of different ``grp`` at most three bits apart.

    Each half emits itself if it has an even number of bits, else itself and its 32
    neighbours, so that halves up to one bit apart meet; the other half is verified.
    Members of one group need no link, so a crowded ball costs nothing here.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(32, dtype=np.uint64)])
        for batch in batches:
            all_fp, all_grp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at in range(0, len(all_fp), 4096):
                fp, grp = all_fp[at:at + 4096], all_grp[at:at + 4096]
                for side in (0, 1):
                    half = (fp.view(np.uint64) >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF)
                    odd = (np.bitwise_count(half) & 1).astype(bool)
                    keys = np.concatenate([half[~odd], (half[odd][:, None] ^ flips).ravel()]) << np.uint64(1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((keys | np.uint64(side)).view(np.int64)),
                         pa.array(np.concatenate([fp[~odd], np.repeat(fp[odd], 33)])),
                         pa.array(np.concatenate([grp[~odd], np.repeat(grp[odd], 33)]))], names=["key", "fp", "grp"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fp, grp in _whole_runs(batches):
            order = np.lexsort((grp, key))
            key, fp, grp = key[order], fp[order].view(np.uint64), grp[order]
            # each member meets those of its key that stand behind its own group
            left = np.arange(len(key))
            right = np.append(np.flatnonzero((key[1:] != key[:-1]) | (grp[1:] != grp[:-1])) + 1, len(key))
            right = np.repeat(right, np.diff(np.append(0, right)))
            found: list[np.ndarray] = []
            while len(left):
                inside = right < len(key)
                left, right = left[inside], right[inside]
                inside = key[left] == key[right]
                left, right = left[inside], right[inside]
                near = np.bitwise_count(fp[left] ^ fp[right]) <= MAX_DISTANCE
                if near.any():
                    found.append(np.unique(np.stack([grp[left[near]], grp[right[near]]]), axis=1))
                    if sum(f.shape[1] for f in found) > 1 << 18:
                        found = [np.unique(np.concatenate(found, axis=1), axis=1)]
                right = right + 1
            if found:
                pairs = np.unique(np.concatenate(found, axis=1), axis=1)
                yield _edge_batch(pairs[0], pairs[1])

    return (points.select("fp", "grp").mapInArrow(emit, "key long, fp long, grp long")
            .repartition("key").sortWithinPartitions("key").mapInArrow(verify, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, grp) of every node that has an edge; ``grp`` is the least node of its component.

    Large-star and small-star rounds: each joins the edges to the least neighbour per
    node, an aggregate with map-side minima, and is cut by a checkpoint; the number of
    rounds grows with the logarithm of the longest path.
    """
    now = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
           .distinct().checkpoint())
    before = None
    while True:
        # large star: every node sends its larger neighbours to its least neighbour
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: every node sends its smaller neighbours and itself to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = small.checkpoint()
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    return now.groupBy("u").agg(F.min("v").alias("grp")).withColumnRenamed("u", "node").unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("grp")).distinct())


def _grouped(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, fp) of every row, and (fp, grp) of every distinct fingerprint."""
    fps = land(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    points = fps.select("fp").distinct().checkpoint()
    close = components(ball_links(points))
    grouped = points.join(close, points.fp == close.node, "left").select(
        "fp", F.coalesce("grp", "fp").alias("grp")).checkpoint()
    merged = components(half_links(grouped)).withColumnsRenamed({"grp": "top"})
    return fps, grouped.join(merged, grouped.grp == merged.node, "left").select(
        "fp", F.coalesce("top", "grp").alias("grp")).checkpoint()


def near_duplicates(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Fingerprints link at ``MAX_DISTANCE`` or fewer differing bits; ``component_id`` is
    the least id that is reachable, itself included.  Null or empty text has fingerprint
    zero and is linked like any other; repeated rows come out each; a null id is never
    the least, and a component with null ids only has a null ``component_id``; other
    columns are left out.
    """
    fps, of = _grouped(docs, shingle, id_col, text_col)
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least")).join(of, "fp")
    named = least.groupBy("grp").agg(F.min("least").alias("component_id"))
    named = of.join(named, "grp").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each group, with the least id, all columns as they are.

    Of rows that share the least id the one with the smallest text hash stays, of rows
    that share the text too any one; a null id comes after all others.
    """
    fps, of = _grouped(docs, shingle, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    first = fps.groupBy("fp").agg(F.min(order).alias("first"))
    first = land(first.join(of, "fp").groupBy("grp").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias("d"), F.col("first.th").alias("t")), "group-heads")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))
    kept = packed_rows(docs, id_col, text_col).join(first, same, "left_semi")
    # rows that repeat id and text: only these are compared again
    again = land(fps.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("doc_id").alias("d"), F.col("th").alias("t")), "repeated-rows")
    if again.isEmpty():
        return unpacked(kept, docs.columns)
    single, several = kept.join(again, same, "left_anti"), kept.join(again, same, "left_semi")
    return unpacked(single.unionByName(several.dropDuplicates(["doc_id", "th"])), docs.columns)
