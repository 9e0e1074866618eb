"""BPE codec and token counts against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from heatwise.llm import bpe_trie, token_count

TEXTS = ["", "   ", "\n\n a  b\t\n", "Hello wörld's 123  foo\n\nÉa ﬁ", "a<|endoftext|>b <|startoftext|> x",
         "<|endoftext|><|endoftext|>", "a" * 3000, "ab" * 500 + " " + "é" * 100, "Σας ΣΑΣ İ ́e", "\x1c\x1f x\x85y\xa0z",
         "日本語 テスト 😀😀", "don'ts WE'LL 'REx", "0123456789 " * 50, "=" * 700]


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def bytes_():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder():
    with open(P.path("word_bpe_49k.json"), "rb") as f:
        return bpe_trie.TrieEncoder(f.read())


@pytest.fixture(scope="module")
def ranks():
    with open(P.path("byte_bpe_50k.json"), "rb") as f:
        return token_count.MergeRanks(f.read())


def _rows():
    rnd = random.Random(5)
    letters = "abcdefgh étion ABC'.,\n\t 12日́<|>"
    more = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    return [(i, t, "x") for i, t in enumerate(TEXTS + more)] + [(0, TEXTS[3], "x"), (None, "a b", "x"), (7777, None, "x")]


def test_encode_documents_is_the_library(spark, words):
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = bpe_trie.encode_documents(df, P.path("word_bpe_49k.json"), keep_text=True)
    got = sorted(map(repr, ((r.doc_id, r.n_tokens, r.ids, r.ids_sha256, r.decoded, r.decoded_sha256)
                            for r in out.collect())))
    want = []
    for i, t, _ in rows:
        ids = words.encode(t or "", add_special_tokens=False).ids
        text = words.decode(ids, skip_special_tokens=False)
        want.append(repr((i, len(ids), ids, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), text,
                          hashlib.sha256(text.encode()).hexdigest())))
    assert got == sorted(want)
    back = bpe_trie.decode_documents(out, P.path("word_bpe_49k.json")).collect()
    assert sorted(repr((r.doc_id, r.decoded)) for r in back) == sorted(
        repr((r.doc_id, r.decoded)) for r in out.collect())


def test_count_tokens_is_the_library(spark, bytes_):
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, over_limit string")
    got = sorted(map(repr, (tuple(r) for r in token_count.count_tokens(df, P.path("byte_bpe_50k.json"), 20).collect())))
    want = []
    for i, t, _ in rows:
        n = len(bytes_.encode(t or "", add_special_tokens=False).ids)
        want.append(repr((i, len((t or "").encode()), n, n > 20)))
    assert got == sorted(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_trie.encode_documents(df, P.path("word_bpe_49k.json")).count() == 0
    assert token_count.count_tokens(df, P.path("byte_bpe_50k.json")).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abeinthrsto'0é", min_size=1, max_size=25), max_size=8))
def test_trie_is_plain_merging(encoder, words):
    got = encoder.encode_words(words)
    for w in words:
        assert got[w] == encoder.merge([ord(c) for c in encoder.word_symbols(w)])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=6))
def test_counts_of_any_text(ranks, bytes_, texts):
    for t in texts:
        t = t.replace("<|endoftext|>", "")
        try:
            t.encode()
        except UnicodeEncodeError:
            continue
        chunks = token_count._CHUNK.findall(t)
        known = token_count.chunk_counts(ranks, set(chunks))
        assert sum(known[c] for c in chunks) == len(bytes_.encode(t, add_special_tokens=False).ids)


def test_chunk_table_stays_bounded(encoder, monkeypatch):
    monkeypatch.setattr(bpe_trie, "CACHE_WORDS", 50)
    known = bpe_trie._Chunks(encoder)
    for i in range(0, 400, 20):
        batch = {f"w{j}" for j in range(i, i + 20)} | {"often"}
        got = known.add(batch)
        assert batch <= set(got) and len(known.young) + len(known.old) <= 150
    assert got["often"] == known.add({"often"})["often"]


@pytest.mark.parametrize("texts", [[None], ["", None, " \n "], ["<|endoftext|>", None], [None, "a b", ""]])
def test_batches_of_null_and_empty_texts(spark, words, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_tokens, r.ids, r.decoded)
           for r in bpe_trie.encode_documents(df, P.path("word_bpe_49k.json"), keep_text=True).collect()}
    for i, t in enumerate(texts):
        ids = words.encode(t or "", add_special_tokens=False).ids
        assert got[i] == (len(ids), ids, words.decode(ids, skip_special_tokens=False))
