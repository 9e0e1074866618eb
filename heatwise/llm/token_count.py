"""Token counts by rank-synchronous array merging.

Pre-tokens of a batch of documents are held as one ragged numpy array.  In each
round every sequence looks up the ranks of its neighbouring pairs and applies its
own lowest-ranked pair wherever it stands; sequences without a ranked pair are done.
The count of a document is the sum of the surviving symbols of its pre-tokens.

Map-only: no shuffle, no collected state.  A Python worker keeps a bounded table of
chunk counts so that a chunk is merged once for many documents.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from heatwise.llm.common import text_slices

# White space as the vocabularies' pattern engine has it, and the
# pattern that cuts text into pre-tokens before merging.
SPACES = "\t-\r \x85\xa0  -     　"
PRE_TOKEN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACES}\p{{L}}\p{{N}}]+"
             rf"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")

# A chunk is a maximal run without white space with the one space before it, or the
# white space between; pre-tokens never cross a chunk's border.
_CHUNK = re.compile(rf" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]")
_PRE_TOKEN = regex.compile(PRE_TOKEN)

CACHE_CHUNKS = 300_000
NO_RANK = np.iinfo(np.int64).max

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class MergeRanks:
    """Pair ranks of a vocabulary file as sorted numpy arrays."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.width = max(vocab.values()) + 1
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.levels = self._hashed(left * self.width + right)
        letters = byte_letters()
        self.byte_ids = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int64)
        self.specials = [t["content"] for t in spec["added_tokens"]]

    @staticmethod
    def _slot(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        odd = np.uint64(0x9E3779B97F4A7C15 + 2 * level)
        return (keys.astype(np.uint64) * odd) >> np.uint64(64 - bits)

    def _hashed(self, keys: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Hash tables key -> rank; keys that meet in a slot go to the next, smaller table."""
        levels, left = [], np.arange(len(keys))
        while len(left) or not levels:
            bits = max(4, int(np.ceil(np.log2(len(left) + 1))) + 4)
            slots = self._slot(keys[left], len(levels), bits)
            _, first = np.unique(slots, return_index=True)
            held, rank = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, NO_RANK)
            held[slots[first]], rank[slots[first]] = keys[left[first]], left[first]
            levels.append((bits, held, rank))
            left = np.delete(left, first)
        return levels

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        out = np.full(len(keys), NO_RANK)
        for level, (bits, held, rank) in enumerate(self.levels):
            slot = self._slot(keys, level, bits)
            found = held[slot] == keys
            out[found] = rank[slot[found]]
        return out

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each byte string after all merges."""
        sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        out = np.zeros(len(tokens), dtype=np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join(tokens), dtype=np.uint8)]
        seq = np.repeat(np.arange(len(tokens)), sizes)
        ranks = np.full(len(ids), NO_RANK)  # of the pair that starts at each symbol
        inside = np.flatnonzero(seq[:-1] == seq[1:])
        ranks[inside] = self.rank(ids[inside], ids[inside + 1])
        while len(ids):
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            lowest = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.append(starts, len(ids))))
            live = lowest != NO_RANK
            if not live.all():
                out += np.bincount(seq[~live], minlength=len(out))
                ids, seq, ranks, lowest = ids[live], seq[live], ranks[live], lowest[live]
                if not len(ids):
                    break
            hit = ranks == lowest
            # of overlapping hits (a a a) every second one merges, from the left
            if (hit[1:] & hit[:-1]).any():
                place = np.arange(len(hit))
                first = hit & ~np.append(False, hit[:-1])
                hit &= (place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0
            at = np.flatnonzero(hit)
            ids[at] = self.merged[ranks[at]]
            stay = np.ones(len(ids), dtype=bool)
            stay[at + 1] = False
            moved = np.cumsum(stay)[at] - 1
            ids, seq, ranks = ids[stay], seq[stay], ranks[stay]
            # only pairs beside a merged symbol change
            touched = np.zeros(len(ids), dtype=bool)
            touched[moved] = True
            touched[:-1] |= touched[1:]
            ranks[touched] = NO_RANK
            near = np.flatnonzero(touched[:-1] & (seq[:-1] == seq[1:]))
            ranks[near] = self.rank(ids[near], ids[near + 1])
        return out


def chunk_counts(ranks: MergeRanks, chunks: Iterable[str]) -> dict[str, int]:
    """Token count of each distinct chunk, all merged together."""
    chunks = list(chunks)
    place: dict[str, int] = {}
    tokens, owner = [], []
    for i, c in enumerate(chunks):
        for t in _PRE_TOKEN.findall(c):
            tokens.append(place.setdefault(t, len(place)))
            owner.append(i)
    if not tokens:
        return dict.fromkeys(chunks, 0)
    each = ranks.count([t.encode() for t in place])
    sums = np.bincount(owner, weights=each[tokens], minlength=len(chunks)).astype(np.int64)
    return dict(zip(chunks, sums.tolist()))


_LOADED: dict[int, MergeRanks] = {}


def _ranks(raw) -> MergeRanks:
    if raw.id not in _LOADED:
        _LOADED[raw.id] = MergeRanks(raw.value)
    return _LOADED[raw.id]


class _Vocabulary:
    """The vocabulary file's bytes, broadcast (a file of a few MB)."""

    def __init__(self, spark, path: str):
        with open(path, "rb") as f:
            self._sent = spark.sparkContext.broadcast(f.read())
        self.id = self._sent._jbroadcast.id()

    def __getstate__(self):
        return {"_sent": self._sent, "id": self.id}

    @property
    def value(self) -> bytes:
        return self._sent.value


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token count of every whole text.

    Null text counts as empty (0 bytes, 0 tokens); repeated rows are counted each; a
    null id stays null; other columns are left out.  Special strings inside a text are
    one token each.  ``over_limit`` is n_tokens > limit.
    """
    raw = _Vocabulary(docs.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(raw)
        special = re.compile("|".join(map(re.escape, sorted(ranks.specials, key=len, reverse=True))) or r"(?!)")
        known: dict[str, int] = {}
        for batch in batches:
            for part in text_slices(batch, 1):
                ids, n_bytes, n_tokens = part.column(0), [], []
                cut = []
                for text in part.column(1).to_pylist():
                    text = text or ""
                    n_bytes.append(len(text.encode()))
                    parts = special.split(text) if special.search(text) else [text]
                    cut.append((len(parts) - 1, [_CHUNK.findall(p) for p in parts]))
                new = {c for _, parts in cut for p in parts for c in p if c not in known}
                if len(known) + len(new) > CACHE_CHUNKS:
                    known = {}
                    new = {c for _, parts in cut for p in parts for c in p}
                known.update(chunk_counts(ranks, new))
                for extra, parts in cut:
                    n_tokens.append(extra + sum(sum(map(known.__getitem__, p)) for p in parts))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                     pa.array([n > limit for n in n_tokens], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, SCHEMA)
