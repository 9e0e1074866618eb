"""Stages on tables with awkward columns, hot lines, malformed pages, and every code point."""

import os
import random
import sys
import time

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from test_line_dedup import brute as brute_lines

from heatwise.llm import bpe_trie, decontaminate, html_extract, line_dedup, pii, quality_gbt, simhash_dedup

ODD = ["_d", "_t", "_leaky", "_leaky_text", "_found", "a.b", "N_LINES", "d", "t", "doc", "th", "found", "row", "gone", "fp", "taken", "`q`"]


def odd_documents(spark):
    text = " ".join(f"Word{i} stands{i * 7} here." for i in range(60))
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, text.replace("Word7 ", "Other ")), (None, "call +49 30 1234567 or a@b.org"),
            (4, "What is the airspeed velocity of an unladen swallow in the rain")]
    kinds = "doc_id long, text string, " + ", ".join(f"`{c.replace('`', '``')}` int" for c in ODD)
    return spark.createDataFrame([(*r, *range(len(ODD))) for r in rows], kinds), rows


def same_columns(out, docs, tmp_path, but=()):
    assert [c for c in out.columns if c not in but] == [c for c in docs.columns if c.lower() not in but]
    path = str(tmp_path / "out")
    out.write.parquet(path)
    back = out.sparkSession.read.parquet(path).collect()
    for r in back:
        for k, c in enumerate(ODD):
            assert c.lower() in but or r[c] == k
    return back


def test_quality_keeps_odd_columns(spark, tmp_path):
    docs, rows = odd_documents(spark)
    assert len(same_columns(quality_gbt.keep_good(docs, None), docs, tmp_path)) == 3


def test_line_dedup_keeps_odd_columns(spark, tmp_path):
    docs, rows = odd_documents(spark)
    out = line_dedup.dedup_lines(docs, 20, 2)
    assert len(same_columns(out, docs, tmp_path, ("n_lines", "n_dropped"))) == len(rows)


def test_near_dedup_keeps_odd_columns(spark, tmp_path):
    docs, rows = odd_documents(spark)
    back = same_columns(simhash_dedup.keep_one(docs), docs, tmp_path)
    assert sum(r.doc_id == 1 for r in back) == 1


@pytest.mark.parametrize("per_row", [True, False])
def test_decontamination_keeps_odd_columns(spark, tmp_path, per_row):
    docs, rows = odd_documents(spark)
    items = spark.createDataFrame([(1, rows[-1][1])], "item_id long, text string")
    back = same_columns(decontaminate.drop_leaky(docs, items, per_row=per_row), docs, tmp_path)
    assert sorted(str(r.doc_id) for r in back) == sorted(str(i) for i, _ in rows[:-1])


def test_sanitise_keeps_odd_columns(spark, tmp_path):
    docs, rows = odd_documents(spark)
    back = same_columns(pii.sanitise(docs), docs, tmp_path)
    assert any(r.text == "call [PHONE] or [EMAIL]" for r in back) and sum(r.text is None for r in back) == 1


def test_a_line_of_every_document_gets_more_salts(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 4)
    hot = "this very line stands in every document of all"
    rows = [(i, f"{hot}\nline number {i // 4} of some documents\nown line of document {i} only") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    repeated = line_dedup.repeated_lines(docs.selectExpr("doc_id", "CAST(text AS BINARY) AS text"), 20, 3)
    shards = -(-repeated.count() // 4)
    found = line_dedup.hot_shards(repeated, shards, salts=2, probes=20)
    assert len(found) == 1 and 20 <= list(found.values())[0] <= 25
    plain = line_dedup.hot_shards
    monkeypatch.setattr(line_dedup, "hot_shards", lambda r, s, salts: plain(r, s, salts, 20))
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(docs, 20, 3, salts=2).collect())
    assert got == sorted(brute_lines(rows))


MALFORMED = {
    "tags without end": "<a" * 500_000, "unclosed quotes": "<div class=\"a " * 70_000, "odd quotes": "<a \"'>" * 150_000,
    "unclosed skipped": "<svg>" * 200_000, "nested": "<div>" * 100_000 + "x" + "</div>" * 100_000,
    "inline nested": "<b>" * 100_000 + "x", "paragraphs": "<p><b>" * 60_000, "crossed": "<div><b>" * 50_000 + "</i></p>" * 50_000,
    "long attribute": "<div " + "a" * 1_000_000 + ">", "attributes": "<div " + "a= " * 300_000 + ">", "declarations": "<!" * 500_000,
    "comments": "<!--" * 250_000, "articles": "<article>" * 50_000 + "<header><p>" * 20_000, "forms": "<nav><form>" * 50_000 + "<article>" * 50,
}


@pytest.mark.parametrize("name", sorted(MALFORMED))
def test_malformed_pages_take_linear_time(name):
    page = MALFORMED[name]

    def seconds(text):
        began = time.process_time()
        html_extract.page_lines(text)
        return time.process_time() - began

    small, whole = min(seconds(page[:len(page) // 8]) for _ in range(2)), seconds(page)
    assert whole < 12 and whole < 24 * max(small, 0.02)


def test_common_lines_halved_are_as_long(monkeypatch):
    rnd = random.Random(3)
    for _ in range(300):
        a, b = (np.array([rnd.randint(0, 9) for _ in range(rnd.randint(0, 40))], dtype=np.uint64) for _ in range(2))
        monkeypatch.setattr(html_extract, "LCS_BITS", 1 << 28)
        whole = html_extract.common_lines(a, b)
        monkeypatch.setattr(html_extract, "LCS_BITS", 50)
        halved = html_extract.common_lines(a, b)
        assert whole.sum() == halved.sum()
        rest = iter(b.tolist())
        assert all(x in rest for x in a[halved].tolist())


def test_every_code_point_encodes_as_the_library_does():
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    with open(path, "rb") as f:
        chunks = bpe_trie._Chunks(bpe_trie.TrieEncoder(f.read()))
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    # of Han, Hangul and the planes above, whose blocks are uniform, every 97th
    points = [c for c in points if not (0x3400 <= c <= 0x9FFF or 0xAC00 <= c <= 0xD7A3 or c >= 0x20000) or c % 97 == 0]
    rnd = random.Random(2)
    texts = [f"a{chr(c)}b" for c in points]
    texts += ["".join(chr(rnd.choice(points)) for _ in range(rnd.randint(1, 12))) for _ in range(4000)]
    for at in range(0, len(texts), 10_000):
        part = texts[at:at + 10_000]
        for text, want in zip(part, library.encode_batch(part, add_special_tokens=False)):
            cut = bpe_trie._chunks_of(text)
            look = chunks.add(set(cut))
            got = np.frombuffer(b"".join(look[c][0] for c in cut), "<u4").tolist()
            assert got == want.ids, [hex(ord(c)) for c in text]
