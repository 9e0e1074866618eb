"""Line dedup by probing sharded minimal perfect hashes.

The keys of all lines are hashed to 128 bits.  The hashes that enough documents hold
are cut into shards by hash range; each shard becomes a minimal perfect hash (hash and
displace: a seed per bucket sends the shard's n hashes to n places without a gap) with
compact arrays beside it: fingerprint, number of documents, and the document that
keeps the line.  Documents don't join lines: their line hashes stream past the arrays
of their shard, one shard in memory at a time, and hits come back as line numbers to
drop.

Sizes: a shard has about ``SHARD_KEYS`` hashes whatever the input; a hot line only adds
probes, and the probes of a shard are spread over ``salts`` copies of its arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatwise.llm.common import land, named

STRIP = b" \t\n\x0b\x0c\r"
SHARD_KEYS = 1 << 14
BUCKET_KEYS = 4
SALT_PROBES = 1 << 20  # probes of repeated lines that one salt of a shard gets, about
NO_DOC = np.iinfo(np.int64).min  # stands for a null id, below every other id


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def _line_hashes(text: bytes, min_chars: int) -> list[tuple[int, bytes]]:
    """(line number, 16-byte hash of its key) of each line that may be dropped.

    The key is the line with ASCII white space stripped at both ends and A-Z lower-cased.
    """
    out = []
    for i, line in enumerate(text.split(b"\n")):
        key = line.strip(STRIP).lower()
        if len(key) >= min_chars and _long_enough(key, min_chars):
            out.append((i, xxhash.xxh3_128_digest(key)))
    return out


# ---- minimal perfect hash ------------------------------------------------------

def _mix(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit value of hash and seed."""
    with np.errstate(over="ignore"):
        z = x + (seed + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(keys, np.uint64(0xB5)) % np.uint64(buckets)).astype(np.int64)


def buckets_of(n: int) -> int:
    return max(1, -(-n // BUCKET_KEYS))


def build_perfect_hash(keys: np.ndarray) -> np.ndarray:
    """Seed per bucket such that ``places`` sends the n distinct 64-bit keys onto 0..n-1.

    Buckets are seeded from the largest to the smallest.  All buckets of a size try the
    same seed at once; those that get free and distinct places, and don't clash with
    one another, keep it, the others go on with the next seed.
    """
    n = len(keys)
    buckets = buckets_of(n)
    seeds = np.zeros(buckets, dtype=np.uint32)
    of = _bucket(keys, buckets)
    order = np.argsort(of, kind="stable")
    sizes = np.bincount(of, minlength=buckets)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    taken = np.zeros(n, dtype=bool)
    for size in range(int(sizes.max(initial=0)), 0, -1):
        open_ = np.flatnonzero(sizes == size)
        if size == 1:
            # a bucket of one key takes a free place outright: its seed names the place
            free = np.flatnonzero(~taken)
            seeds[open_] = np.uint32(1 << 31) | free[:len(open_)].astype(np.uint32)
            break
        members = keys[order[starts[open_][:, None] + np.arange(size)]]
        seed = 0
        while len(open_):
            place = (_mix(members, np.uint64(seed)) % np.uint64(n)).astype(np.int64)
            low = np.sort(place, axis=1)
            ok = ~taken[place].any(axis=1) & (low[:, 1:] != low[:, :-1]).all(axis=1)
            if ok.any():
                good = np.flatnonzero(ok)
                # of good buckets that want one place only the first may have it
                owner = np.full(n, len(open_), dtype=np.int64)
                np.minimum.at(owner, place[good].ravel(), np.repeat(good, size))
                won = good[(owner[place[good]] == good[:, None]).all(axis=1)]
                taken[place[won].ravel()] = True
                seeds[open_[won]] = seed
                rest = np.ones(len(open_), dtype=bool)
                rest[won] = False
                open_, members = open_[rest], members[rest]
            seed += 1
    return seeds


def places(keys: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    """The place of each key; a key that the hash was not built for gets any place."""
    seed = seeds[_bucket(keys, len(seeds))]
    named = (seed >> np.uint32(31)).astype(bool)
    place = (_mix(keys, seed.astype(np.uint64)) % np.uint64(n)).astype(np.int64)
    return np.where(named, np.minimum((seed & np.uint32((1 << 31) - 1)).astype(np.int64), n - 1), place)


# ---- Spark ---------------------------------------------------------------------

def _hash_table(docs: DataFrame, min_chars: int) -> DataFrame:
    """(high, low, doc_id) of each distinct line key of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(NO_DOC).to_numpy()
            for at in range(0, batch.num_rows, 256):
                per = [{h for _, h in _line_hashes(t or b"", min_chars)}
                       for t in batch.column(1).slice(at, 256).to_pylist()]
                both = np.frombuffer(b"".join(h for p in per for h in p), dtype="<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[:, 0]), pa.array(both[:, 1]),
                     pa.array(np.repeat(ids[at:at + 256], [len(p) for p in per]))],
                    names=["high", "low", "doc_id"])

    return docs.mapInArrow(run, "high long, low long, doc_id long")


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(high, low, n_docs, keeper) of the keys that at least ``min_docs`` document rows hold.

    Counted per key with map-side sums, so a line of every document is no hot key.
    """
    return (_hash_table(docs, min_chars).groupBy("high", "low")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
            .where(F.col("n_docs") >= min_docs))


def _shard_key(high: np.ndarray, low: np.ndarray, seed: int) -> np.ndarray:
    return high.view(np.uint64) ^ _mix(low.view(np.uint64), np.uint64(seed))


def build_shards(repeated: DataFrame, shards: int) -> DataFrame:
    """One row per shard: its size, the seed of its keys, and seeds, fingerprints, keepers, counts as packed arrays."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        high, low = pdf["high"].to_numpy(), pdf["low"].to_numpy()
        n, seed = len(pdf), 0
        while len(np.unique(keys := _shard_key(high, low, seed))) < n:
            seed += 1
        seeds = build_perfect_hash(keys)
        at = places(keys, seeds, n)
        prints, counts, keepers = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        prints[at], counts[at], keepers[at] = low, pdf["n_docs"].to_numpy(), pdf["keeper"].to_numpy()
        packed = seeds.tobytes() + prints.tobytes() + keepers.tobytes() + counts.tobytes()
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "n": [n], "seed": [seed], "arrays": [packed]})

    return (repeated.withColumn("shard", F.pmod(F.col("high"), F.lit(shards)).cast("int")).groupBy("shard")
            .applyInPandas(pack, "shard int, n long, seed long, arrays binary"))


def unpack(arrays: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(seeds, fingerprints, keepers, counts) of a shard."""
    cut = 4 * buckets_of(n)
    rest = np.frombuffer(arrays, dtype=np.int64, offset=cut) if cut % 8 == 0 else np.frombuffer(arrays[cut:], np.int64)
    return np.frombuffer(arrays[:cut], dtype=np.uint32), rest[:n], rest[n:2 * n], rest[2 * n:]


def hot_shards(repeated: DataFrame, shards: int, salts: int, probes: int = SALT_PROBES) -> dict[int, int]:
    """Salts of the shards whose repeated lines are probed more than ``salts * probes`` times.

    The probes of all lines together bound their number: one hot shard for every ``salts *
    probes`` lines at most, so the list that reaches the driver and the tasks is short.
    """
    load = repeated.groupBy(F.pmod(F.col("high"), F.lit(shards)).cast("int").alias("shard")).agg(F.sum("n_docs").alias("n"))
    return {r["shard"]: -(-r["n"] // probes) for r in load.where(F.col("n") > salts * probes).collect()}


def dropped_lines(docs: DataFrame, arrays: DataFrame, shards: int, min_chars: int, salts: int,
                  hot: dict[int, int] | None = None) -> DataFrame:
    """(row, line) of every line to drop: documents probe the arrays of their lines' shards.

    Probes and arrays meet under a key for (shard, salt), arrays first (their line number
    is -1), and are read as a stream: a task goes through its keys one after the other and
    holds one shard and one batch.  A shard has ``salts`` salts; one of ``hot`` as many as
    that says, with keys after all others.
    """
    hot = hot or {}
    hot_ids = np.array(sorted(hot), dtype=np.int64)
    hot_salts = np.array([hot[h] for h in sorted(hot)], dtype=np.int64)
    hot_first = shards * salts + np.cumsum(hot_salts) - hot_salts

    def part_of(shard: np.ndarray, row: np.ndarray) -> np.ndarray:
        part = shard * salts + (row % np.uint64(salts)).astype(np.int64)
        if len(hot_ids):
            at = np.minimum(np.searchsorted(hot_ids, shard), len(hot_ids) - 1)
            own = hot_first[at] + (row % hot_salts[at].astype(np.uint64)).astype(np.int64)
            part = np.where(hot_ids[at] == shard, own, part)
        return part

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_rows, all_ids = batch.column(1).to_numpy(), batch.column(0).fill_null(NO_DOC).to_numpy()
            for at in range(0, batch.num_rows, 256):
                per = [_line_hashes(t or b"", min_chars) for t in batch.column(2).slice(at, 256).to_pylist()]
                sizes = [len(p) for p in per]
                both = np.frombuffer(b"".join(h for p in per for _, h in p), dtype="<i8").reshape(-1, 2)
                row = np.repeat(all_rows[at:at + 256], sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part_of(both[:, 0] % shards, row.view(np.uint64)).astype(np.int32)),
                     pa.array(np.array([i for p in per for i, _ in p], dtype=np.int32)),
                     pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(np.repeat(all_ids[at:at + 256], sizes)),
                     pa.array(row)],
                    names=["part", "line", "high", "low", "doc_id", "row"])

    asked = (docs.mapInArrow(probes, "part int, line int, high long, low long, doc_id long, row long")
             .withColumn("arrays", F.lit(None).cast("binary")))
    first, many = F.col("shard") * salts, F.lit(salts)
    if hot:
        known = docs.sparkSession.createDataFrame(
            [(int(i), int(f), int(n)) for i, f, n in zip(hot_ids, hot_first, hot_salts)], "shard int, first int, many int")
        arrays = arrays.join(F.broadcast(known), "shard", "left")
        first, many = F.coalesce("first", first), F.coalesce("many", many)
    held = (arrays.withColumn("salt", F.explode(F.sequence(F.lit(0), many - 1)))
            .select((first + F.col("salt")).cast("int").alias("part"), F.lit(-1).alias("line"),
                    F.col("n").alias("high"), F.col("seed").alias("low"), F.lit(0).cast("long").alias("doc_id"),
                    F.lit(0).cast("long").alias("row"), "arrays"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = -1
        for batch in batches:
            part, line, high, low, doc, row = (batch.column(i).to_numpy() for i in range(6))
            edges = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (line[:-1] < 0)))
            for a, b in zip(edges, np.append(edges[1:], len(part))):
                if line[a] < 0:
                    held, n, seed = part[a], int(high[a]), int(low[a])
                    seeds, prints, keepers, _ = unpack(batch.column(6)[int(a)].as_py(), n)
                    continue
                if part[a] != held:
                    continue  # no repeated line has this shard
                at = places(_shard_key(high[a:b], low[a:b], seed), seeds, n)
                hit = (prints[at] == low[a:b]) & (keepers[at] != doc[a:b])
                if hit.any():
                    yield pa.RecordBatch.from_arrays([pa.array(row[a:b][hit]), pa.array(line[a:b][hit])],
                                                     names=["row", "line"])

    return (asked.unionByName(held).repartition("part").sortWithinPartitions("part", "line")
            .mapInArrow(answer, "row long, line int"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, salts: int = 8,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text of the lines that stay and two counts, ``n_lines`` and ``n_dropped``.

    Keys of at least ``min_chars`` code points that at least ``min_docs`` document rows
    hold lose their lines except in the row(s) with the largest id that holds them.
    Null or empty text is one empty line (kept text empty); each repeated row counts as
    a document of its own, and those with the largest id all keep the line; a null id is
    below every other; all other columns are passed through, but for columns that have
    the names of the two counts, in any case of letters, which are replaced.
    """
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    doc_id = named(id_col).cast("long")
    counts = ("n_lines", "n_dropped")
    slim = docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("row"), text.cast("binary").alias("text"))
    repeated = land(repeated_lines(slim.select("doc_id", "text"), min_chars, min_docs), "repeated-lines")
    shards = max(1, -(-repeated.count() // SHARD_KEYS))
    arrays = land(build_shards(repeated, shards), "line-arrays")
    hot = hot_shards(repeated, shards, salts)
    drops = dropped_lines(slim, arrays, shards, min_chars, salts, hot).groupBy("row").agg(F.collect_set("line").alias("gone"))
    others = [c for c in docs.columns if c != text_col and c.lower() not in counts]
    here = docs.select(F.struct(*[named(c).alias(c) for c in others]).alias("doc"), text.alias("text"),
                       F.xxhash64(doc_id, text).alias("row"))
    joined = here.join(drops, "row", "left").select("doc", "text", "gone")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for value, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if gone:
                    lines, gone = value.split("\n"), set(gone)
                    kept.append("\n".join([x for i, x in enumerate(lines) if i not in gone]))
                    n_lines.append(len(lines))
                    n_dropped.append(len(gone))
                else:
                    kept.append(value)
                    n_lines.append(value.count("\n") + 1)
                    n_dropped.append(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_dropped, pa.int64())], names=["doc", "text", "n_lines", "n_dropped"])

    schema = T.StructType([joined.schema["doc"], T.StructField("text", T.StringType()),
                           T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    out = joined.mapInArrow(keep, schema)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("doc").getField(c).alias(c)
                        for c in docs.columns if c == text_col or c.lower() not in counts], *counts)


def digest(kept: DataFrame) -> DataFrame:
    """doc_id, counts and the SHA-256 of the kept text."""
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
