"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct words of a batch are inserted into a trie of symbols.  A depth-first
walk carries, for every prefix on the path, the last token of that prefix's
encoding; the last token of a longer prefix follows from these alone: it is the one
token that ends there and stands beside the last token of what precedes it without
any merge across the border.  The candidates are the tokens that the prefix ends with,
kept by a state of the walk (the longest beginning of a token it ends with).  A prefix
shared by many words is thus encoded once, and a word's ids are read off by stepping
back from its end.

Map-only: no shuffle, no collected state; a Python worker keeps bounded tables of
encoded words and of chunks between white space.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import json
import re
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from heatwise.llm.common import text_slices
from heatwise.llm.token_count import SPACES, _Vocabulary, byte_letters

# Fixed value: the pattern whose matches are the words.
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACES}\p{{L}}\p{{N}}]+"
# Fixed value: the same pattern as the vocabulary file states it for its engine.
ENGINE_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD = regex.compile(WORD)
_SPACES = re.compile(f"[{SPACES}]+")
# control characters that Python's split takes as white space and the vocabulary's engine doesn't
_ODD = re.compile("[\x1c-\x1f]")

CACHE_WORDS = 300_000
SCHEMA = "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string, decoded string"


@functools.cache
def unassigned() -> re.Pattern[str]:
    """A pattern for one code point that Python's character tables don't assign."""
    category = unicodedata.category
    none = [c for c in range(sys.maxunicode + 1) if category(chr(c)) == "Cn"]
    first = [c for k, c in enumerate(none) if not k or none[k - 1] != c - 1]
    last = [c for k, c in enumerate(none) if k + 1 == len(none) or none[k + 1] != c + 1]
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last)) + "]")


class TrieEncoder:
    """Encoder over a vocabulary with ranked merges and an end-of-word suffix."""

    def __init__(self, raw: bytes, unassigned_points: str | None = None):
        spec = json.loads(raw)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.specials.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {(self.vocab[a], self.vocab[b]): (r, self.vocab[a + b]) for r, (a, b) in enumerate(pairs)}
        self._classes, self._unassigned = None, re.compile(unassigned_points) if unassigned_points else unassigned()
        self.letters = byte_letters()
        # symbol of each byte inside a word and at its end
        self.inner = {b: chr(self.vocab[x]) for b, x in self.letters.items()}
        self.ending = {b: chr(self.vocab[x + self.suffix]) for b, x in self.letters.items()}
        # the two tokens that each merged token is made of
        self.halves = {whole: pair for pair, (_, whole) in sorted(self.rank.items(), key=lambda x: -x[1][0])}
        self.born = {whole: r for r, whole in sorted(self.rank.values(), reverse=True)}
        # tokens as strings of one character a symbol (a last letter with the suffix is one symbol)
        spelled: dict[str, int] = {}
        for token in self.born:
            s = self._spell(token)
            if self.merge([ord(c) for c in s]) == [token]:
                spelled[s] = token
        self._link(spelled)
        self._beside: dict[tuple[int, int], bool] = {}

    def _link(self, spelled: dict[str, int]) -> None:
        """States of what a prefix ends with: the longest beginning of a token.

        ``step``: state and symbol (in one number) to the state of the longer beginning;
        ``shorter``: the state of the next shorter beginning that a state ends with;
        ``endings``: the tokens of two symbols and more that a state ends with, the longest first.
        """
        self.step: dict[int, int] = {}
        self.shorter, self.endings = [0], [()]
        level = {"": 0}
        for size in range(1, max(map(len, spelled), default=0) + 1):
            longer = {}
            for s in {t[:size] for t in spelled if len(t) >= size}:
                before, symbol = level[s[:-1]], ord(s[-1])
                longer[s] = state = len(self.shorter)
                # the shorter state is of an earlier level, whose steps are all known
                back = self._after(self.shorter[before], symbol) if before else 0
                self.step[before << 21 | symbol] = state
                self.shorter.append(back)
                own = ((size, spelled[s]),) if s in spelled else ()
                self.endings.append(own + self.endings[back])
            level = longer

    def _after(self, state: int, symbol: int) -> int:
        """State of the longest beginning of a token after one more symbol."""
        while True:
            after = self.step.get(state << 21 | symbol)
            if after is not None:
                return after
            if not state:
                return 0
            state = self.shorter[state]

    def _spell(self, token: int) -> str:
        text = self.tokens[token]
        body = text.removesuffix(self.suffix) if self.suffix else text
        units = list(body)
        if len(body) < len(text):
            units[-1] += self.suffix
        return "".join(chr(self.vocab[u]) for u in units)

    def word_symbols(self, word: str) -> str:
        raw = word.encode()
        return raw[:-1].decode("latin-1").translate(self.inner) + self.ending[raw[-1]]

    def merge(self, symbols: list[int]) -> list[int]:
        """Plain BPE of a short run of symbols."""
        run = list(symbols)
        while len(run) > 1:
            best = min(((self.rank[p][0], i) for i, p in enumerate(zip(run, run[1:])) if p in self.rank),
                       default=None)
            if best is None:
                break
            i = best[1]
            run[i:i + 2] = [self.rank[run[i], run[i + 1]][1]]
        return run

    def _fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay side by side, that is no merge crosses their border.

        Undoes the two tokens' merges from the last to the first; at each step the two
        symbols at the border may not have a merge that comes before the one undone.
        """
        key = (left, right)
        ok = self._beside.get(key)
        if ok is None:
            if len(self._beside) > 1_000_000:
                self._beside.clear()
            before, from_left = float("inf"), False
            while True:
                across = self.rank.get((left, right))
                # of equal rank the leftmost pair merges first
                if across is not None and (across[0] < before or across[0] == before and not from_left):
                    ok = False
                    break
                a, b = self.born.get(left, -1), self.born.get(right, -1)
                if a < 0 and b < 0:
                    ok = True
                    break
                from_left = a > b
                before = a if from_left else b
                if from_left:
                    left = self.halves[left][1]
                else:  # also of the same merge on both sides: the right one came last
                    right = self.halves[right][0]
            self._beside[key] = ok
        return ok

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of each distinct word, by one depth-first walk over their trie.

        The words in symbol order are the trie in depth-first order: a node is a prefix,
        and what a word shares with the one before it is the part of the path that stays.
        """
        step, shorter, endings, fits = self.step, self.shorter, self.endings, self._fits
        beside = self._beside
        out: dict[str, list[int]] = {}
        # by depth on the path: last token of the prefix that ends there, its length, and the prefix's state
        token_at, size_at, state_at = [0] * 64, [0] * 64, [0] * 64
        before = ""
        word_of = {self.word_symbols(w): w for w in words}
        for path in sorted(word_of):
            end, shared = len(path), 0
            for x, y in zip(before, path):  # nodes that this word shares with the one before it
                if x != y:
                    break
                shared += 1
            before = path
            if end >= len(token_at):
                token_at += [0] * end
                size_at += [0] * end
                state_at += [0] * end
            depth, state = shared, state_at[shared]
            for letter in path[shared:]:
                depth += 1
                symbol = ord(letter)
                after = step.get(state << 21 | symbol)
                while after is None and state:
                    state = shorter[state]
                    after = step.get(state << 21 | symbol)
                state = state_at[depth] = after or 0
                token, size = symbol, 1
                for n, t in endings[state]:
                    if n == depth:
                        token, size = t, n
                        break
                    pair = (token_at[depth - n], t)
                    ok = beside.get(pair)
                    if ok or ok is None and fits(*pair):
                        token, size = t, n
                        break
                token_at[depth], size_at[depth] = token, size
            ids = []
            while end:
                ids.append(token_at[end])
                end -= size_at[end]
            ids.reverse()
            out[word_of[path]] = ids
        return out

    def words(self, chunks: Iterable[str]) -> dict[str, list[str]]:
        """Words of chunks without white space: NFC, lower case letter by letter (no final sigma), then the pattern."""
        chunks = list(chunks)
        # asked of all letters at once, since that pattern is slow
        newer = self._unassigned.search("".join(set("".join(chunks)))) is not None
        return {c: self._newer_words(c) if newer and self._unassigned.search(c) else self._words(c) for c in chunks}

    def _words(self, chunk: str) -> list[str]:
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        chunk = chunk.lower()
        if chunk.isalpha():
            return [chunk]
        if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return _WORD.findall(chunk)

    def _newer_words(self, chunk: str) -> list[str]:
        """Words of a chunk with code points that Python's tables don't assign.

        The vocabulary's engine follows other versions of the character tables, so what
        is a letter or digit there, and its lower case, is asked of the engine's own classes.
        """
        if self._classes is None:
            from tokenizers import Regex, normalizers, pre_tokenizers

            self._classes = (normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]),
                             pre_tokenizers.Split(Regex(ENGINE_WORD), behavior="removed", invert=True))
        plain, split = self._classes
        return [w for w, _ in split.pre_tokenize_str(plain.normalize_str(chunk))]

    def decode(self, ids: Iterable[int]) -> str:
        """Token strings joined by a space: the file names no decoder."""
        return " ".join(self.tokens[i] for i in ids)


class _Recent:
    """Two generations of at most ``limit`` entries (or those of one call): what is asked for again
    moves to the younger one, so that frequent keys stay and memory is bounded."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict[str, tuple[bytes, int]] = {}
        self.old: dict[str, tuple[bytes, int]] = {}

    def unknown(self, keys: set[str]) -> list[str]:
        """The keys without an entry; all others are in the younger generation then."""
        new = [k for k in keys if k not in self.young]
        if len(self.young) + len(new) > self.limit:
            self.old, self.young, new = self.young, {}, list(keys)
        young, old = self.young, self.old
        young.update([(k, old[k]) for k in new if k in old])
        return [k for k in new if k not in old]


class _Chunks(_Recent):
    """Ids of white-space-free chunks, as bytes, and their number: a word never crosses white space.

    A chunk's words (without case and marks beside them) recur in other chunks; their ids
    are kept in a table of their own.
    """

    def __init__(self, encoder: TrieEncoder):
        super().__init__(CACHE_WORDS // 2)
        self.encoder = encoder
        self.of_words = _Recent(CACHE_WORDS)

    def add(self, chunks: set[str]) -> dict[str, tuple[bytes, int]]:
        """Ids as bytes and their number of chunks, these among them."""
        split = self.encoder.words(self.unknown(chunks))
        encoded = self.encoder.encode_words(self.of_words.unknown({w for ws in split.values() for w in ws}))
        known, young = self.of_words.young, self.young
        known.update([(w, (struct.pack(f"<{len(run)}I", *run), len(run))) for w, run in encoded.items()])
        for c, ws in split.items():
            if len(ws) == 1:
                young[c] = known[ws[0]]
            else:
                ids = b"".join([known[w][0] for w in ws])
                young[c] = (ids, len(ids) // 4)
        return young


_LOADED: dict[int, _Chunks] = {}  # of a Python worker, across the tasks that it runs


def _encoded_chunks(raw: _Vocabulary, unassigned_points: str) -> _Chunks:
    if raw.id not in _LOADED:
        _LOADED.clear()
        _LOADED[raw.id] = _Chunks(TrieEncoder(raw.value, unassigned_points))
    return _LOADED[raw.id]


def _chunks_of(text: str) -> list[str]:
    return [c for c in _SPACES.split(text) if c] if _ODD.search(text) else text.split()


def _joined(runs: list[tuple[bytes, int]], indices: np.ndarray, ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the runs that ``indices`` name, end to end, and where each document's ids begin and end.

    ``ends`` are the positions in ``indices`` at which the documents meet, from 0 on.
    """
    store = np.frombuffer(b"".join([ids for ids, _ in runs]), dtype="<u4")
    size = np.array([n for _, n in runs], dtype=np.int64)
    first = np.cumsum(size) - size
    sizes = size[indices]
    upto = np.concatenate([[0], np.cumsum(sizes)])
    return store[np.repeat(first[indices] - upto[:-1], sizes) + np.arange(upto[-1])], upto[ends]


def encode_documents(docs: DataFrame, vocabulary_path: str, keep_ids: bool = True, keep_text: bool = False,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text and the text that they decode to.

    Returns doc_id, n_tokens, ids, ids_sha256 (ids as little-endian 32-bit integers),
    decoded_sha256, decoded; ``ids`` / ``decoded`` are null unless kept.  Special
    strings inside a text become their own ids.  Null text is empty (no ids, empty
    decoded text); repeated rows are encoded each; a null id stays null; other columns
    are left out.
    """
    raw, points = _Vocabulary(docs.sparkSession, vocabulary_path), unassigned().pattern  # found once, on the driver

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _encoded_chunks(raw, points)
        encoder = known.encoder
        special = re.compile("(" + ("|".join(map(re.escape, sorted(encoder.specials, key=len, reverse=True)))
                                    or r"(?!)") + ")")
        own = {s: (struct.pack("<I", i), 1) for s, i in encoder.specials.items()}
        # what each id adds to a decoded text
        spoken = pa.array([encoder.tokens.get(i, "") + " " for i in range(max(encoder.tokens) + 1)], pa.large_string())

        def encoded(part: pa.RecordBatch) -> pa.RecordBatch:
            chunks: list[str] = []
            ends = [0]
            for text in part.column(1).to_pylist():
                text = text or ""
                if special.search(text):
                    # a special string is cut out wherever it stands, so no other chunk equals one
                    for i, p in enumerate(special.split(text)):
                        chunks += [p] if i % 2 else _chunks_of(p)
                else:
                    chunks += _chunks_of(text)
                ends.append(len(chunks))
            coded = pa.array(chunks, pa.large_string()).dictionary_encode()
            distinct, chunks = coded.dictionary.to_pylist(), []
            look = known.add(set(distinct) - own.keys())
            ids, bounds = _joined([own.get(c) or look[c] for c in distinct], coded.indices.to_numpy(), ends)
            said = spoken.take(pa.array(ids))
            letters = np.frombuffer(said.buffers()[1], dtype=np.int64)[bounds]
            said = memoryview(said.buffers()[2] or b"")
            spans = list(zip(bounds, bounds[1:]))
            decoded = [said[x:max(x, y - 1)] for x, y in zip(letters, letters[1:])]
            return pa.RecordBatch.from_arrays([
                part.column(0),
                pa.array(np.diff(bounds), pa.int64()),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.view("<i4"), pa.int32()))
                if keep_ids else pa.nulls(len(spans), pa.list_(pa.int32())),
                pa.array([hashlib.sha256(ids[x:y]).hexdigest() for x, y in spans], pa.string()),
                pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
                pa.array([str(d, "utf-8") if keep_text else None for d in decoded], pa.string()),
            ], names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256", "decoded"])

        for batch in batches:
            for part in text_slices(batch, 1, size=4 << 20):
                gc.disable()  # strings, numbers and tuples of them only: no cycles to look for
                try:
                    out = encoded(part)
                finally:
                    gc.enable()
                yield out

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, SCHEMA)


def decode_documents(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id and the decoded text of rows with ``ids``; null ids decode to the empty text."""
    raw, points = _Vocabulary(encoded.sparkSession, vocabulary_path), unassigned().pattern

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoded_chunks(raw, points).encoder
        for batch in batches:
            texts = [encoder.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "decoded"])

    return encoded.select(encoded["doc_id"].cast("long").alias("doc_id"), "ids").mapInArrow(
        run, "doc_id long, decoded string")
