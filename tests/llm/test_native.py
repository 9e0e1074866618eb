"""Decontamination, license scan and personal data against brute force."""

import hashlib
import random
import re

import pytest

from heatwise.llm import decontaminate as D
from heatwise.llm import licenses as L
from heatwise.llm import pii


def shingles(text, size=5):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def _items(rnd, vocabulary):
    return [(i, " ".join(rnd.choice(vocabulary) for _ in range(n))) for i, n in enumerate(
        [1, 3, 5, 6, 9, 12, 20, 20, 33, 64, 65, 130, 400])] + [(90, None), (91, ""), (92, "..."), (3, "five more words here now")]


def test_leaks_are_brute_force(spark):
    rnd = random.Random(7)
    vocabulary = [f"v{i}" for i in range(50)]
    items = _items(rnd, vocabulary)
    docs = []
    for i in range(150):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 200))]
        for _ in range(rnd.randint(0, 3)):
            piece = (rnd.choice(items)[1] or "").split()
            for _ in range(rnd.randint(0, 2)):  # edits, so that containment lies on either side of the threshold
                if piece:
                    piece[rnd.randrange(len(piece))] = "edited"
            at = rnd.randint(0, len(words))
            words[at:at] = piece
        docs.append((i, ", ".join(words).upper()))
    docs += [(500, None), (501, ""), (502, "--"), (None, items[6][1]), (503, items[1][1]), (7, docs[7][1]),
             (7, items[8][1]), (504, "x " * 100_000 + items[10][1])]
    want = {}
    for i, t in docs:
        have = set(shingles(t))
        for k, s in items:
            need = set(shingles(s))
            n = len(need & have)
            if need and 5 * n >= 4 * len(need):
                want[i, k] = max(want.get((i, k), (0,)), (n / len(need), n, len(need)))
    df = spark.createDataFrame([(i, t, 9) for i, t in docs], "doc_id long, text string, item_id int")
    found = D.find_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): (r.containment, r.n_shared, r.n_shingles) for r in found}
    assert len(found) == len(got) and got == want and len(want) > 50
    kept = D.drop_leaky(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    leaky = {i for i, _ in want}
    assert sorted(repr(r.doc_id) for r in kept) == sorted(repr(i) for i, _ in docs if i not in leaky)


def test_clean_rows_stay_beside_leaking_rows_of_their_id(spark, tmp_path):
    import corpus_pipeline

    item, clean = "one two three four five six seven", "nothing of the test stands in this text"
    rows = [(None, clean, 1), (None, f"x {item} y", 2), (None, None, 3), (5, clean, 4), (5, item, 5), (5, item, 6), (6, clean, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(r.n for r in corpus_pipeline.leaks(spark, df, str(tmp_path)).collect()) == [1, 3, 4, 7]


def test_leaks_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_leaks(docs, none).count() == 0
    assert D.find_leaks(docs.limit(0), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0


def brute_licenses(docs, texts):
    out = {}
    known = {k: set(shingles(t)) for k, t in texts.items() if shingles(t)}
    every = set().union(*known.values())
    for i, t in docs:
        places = [(p, s) for p, s in enumerate(shingles(t)) if s in every]
        for k, need in known.items():
            span = 1
            while span < len(need):
                span *= 2
            windows = {}
            for p, s in places:
                for w in (p // span, p // span - 1):
                    if w >= 0 and s in need:
                        windows.setdefault(w, []).append((p, s))
            for got in windows.values():
                n = len({s for _, s in got})
                if n >= -(-8 * len(need) // 10):
                    out[i, k] = max(out.get((i, k), (0, 0, 0)), (n, -min(p for p, _ in got), len(need)))
    return {x: (n, m, -p) for x, (m, p, n) in out.items()}


def test_licenses_are_brute_force(spark):
    rnd = random.Random(3)
    names = sorted(L.TEMPLATES)
    docs = []
    for i in range(80):
        words = [f"u{rnd.randrange(300)}" for _ in range(rnd.randint(0, 150))]
        for _ in range(rnd.randint(0, 4)):
            piece = L.TEMPLATES[rnd.choice(names)].split()
            for _ in range(rnd.choice([0, 0, 1, 2, 5])):
                piece[rnd.randrange(len(piece))] = "edited"
            at = rnd.randint(0, len(words))
            words[at:at] = piece
        docs.append((i, " ".join(words)))
    docs += [(200, None), (201, ""), (None, L.TEMPLATES["mit-notice"]), (5, docs[5][1]), (202, "*** " + L.TEMPLATES["no-warranty"].upper()),
             (203, "y " * 50_000 + L.TEMPLATES["gpl-header"])]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, license string")
    found = L.scan_licenses(df).collect()
    got = {(r.doc_id, r.license): (r.n_shingles, r.n_shared, r.first_word) for r in found}
    assert len(found) == len(got) and got == brute_licenses(docs, L.TEMPLATES) and len(got) > 50
    assert L.scan_licenses(df.limit(0)).count() == 0
    assert L.scan_licenses(df, spark.createDataFrame([], "license string, text string")).count() == 0


def test_usual_notices_and_several_texts_of_a_license(spark):
    notices = {"mit-notice-licensed": "licensed under the MIT license", "cc-by-sa-4.0-short": "Licensed under CC BY-SA 4.0",
               "isc-notice": "Licensed under the ISC License", "agpl-notice": "licensed under the GNU Affero General Public License",
               "lgpl-2.1-header": L.TEMPLATES["gpl-2.0-header"].replace("program", "library").replace("General", "Lesser General").replace("2 of", "2.1 of")}
    df = spark.createDataFrame([(k, f"some words and then {t}, with more") for k, t in enumerate(notices.values())], "doc_id long, text string")
    got = {(r.doc_id, r.license) for r in L.scan_licenses(df).collect()}
    assert {(i, k) for i, k in enumerate(notices)} <= got
    texts = [("x", "one two three four five six"), ("x", "alpha beta gamma delta epsilon"), ("x", None), ("y", "un deux trois quatre cinq")]
    docs = [(1, "so one two three four five six"), (2, "so alpha beta gamma delta epsilon"), (3, "nothing at all stands here")]
    found = L.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(texts, "license string, text string"))
    assert sorted(map(tuple, found.collect())) == [(1, "x", 2, 2, 1), (2, "x", 1, 1, 1)]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 if d > "4" else 2 * int(d))
               for i, d in enumerate(reversed(digits))) % 10 == 0


def brute_pii(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    out = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


PII_TEXTS = [
    "", None, "a.b+c@d.example.com_x@y.org z@nodot q@w.e.r.t.", "é@x.yé 日本 me@日本.com a@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 007.0.0.255 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111  1111", "+1 (017) 555-7713 +44 20 7946 0958. +1-2", "+1(5)+49 30 901820",
    "1 " * 3000, "7" * 4000, "a" * 4000 + "@", "x@" + "a." * 4000 + "b", "+" * 2000 + "1" + "2" * 14, "0.0.0.0" * 300, "@.@.@ 12-34-", "😀😀 me@x.org 😀 10.0.0.1"]


def test_pii_is_brute_force(spark):
    rnd = random.Random(11)
    more = ["".join(rnd.choice("ab1290@.+-() %é\n") for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    texts = PII_TEXTS + more
    rows = [(i, t, "e") for i, t in enumerate(texts)] + [(None, texts[2], "e"), (2, texts[2], "e"), (2, "other@mail.example 1.1.1.1", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    got = sorted(map(repr, (tuple(r)[:6] for r in pii.digest(pii.find_pii(df)).collect())))
    want = []
    for i, t, _ in rows:
        found = brute_pii(t or "")
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)
        want.append(repr((i, *(sum(f[3] == k for f in found) for k in pii.BASE_KINDS), hashlib.sha256(text.encode()).hexdigest())))
    assert got == sorted(want)
    assert pii.find_pii(df.limit(0)).count() == 0


@pytest.fixture()
def told(spark):
    common = [(i, "the usual words stand here and there again") for i in range(200)]
    near = [(300 + i, "the usual nickname Zorblatt writes from me@secret.example about zorquil there") for i in range(4)]
    alone = [(400, "a zorblatt without any address"), (401, "zorquil zorquix zorquin zormel zortal")]
    alone += [(402 + i, f"zor{x} zorblax") for i, x in enumerate(["aaa", "bbb"] * 15)]
    return spark.createDataFrame(common + near + alone, "doc_id long, text string")


def test_revealing_terms(spark, told):
    rows = pii.keyed_documents(told)
    terms = {r.term: r.kind for r in pii.revealing_terms(rows, pii.entity_spans(rows), pii.Disclosure(threshold=0.8)).collect()}
    # beside the address in four documents and hardly anywhere else; words of every document tell nothing
    assert {"zorblatt", "zorquil", "nickname", "writes", "from", "about"} == set(terms)
    assert terms["zorblatt"] == "general" and terms["nickname"] == "removed"
    found = {r.doc_id: r.spans for r in pii.digest(pii.find_pii(told, pii.Disclosure(threshold=0.8))).collect()}
    text = "the usual nickname Zorblatt writes from me@secret.example about zorquil there"
    for word, kind in (("nickname", "removed"), ("Zorblatt", "general"), ("me@secret.example", "email")):
        assert f"{kind}:{text.index(word)}:{text.index(word) + len(word)}" in found[300].split(",")
    assert found[0] == "" and found[400] == "general:2:10"


def test_sanitise(spark, told):
    out = {r.doc_id: r.text for r in pii.sanitise(told, pii.Disclosure(threshold=0.8)).collect()}
    assert out[0] == "the usual words stand here and there again"
    assert out[300] == "the usual [REMOVED] Zor* [REMOVED] [REMOVED] [EMAIL] [REMOVED] zor* there"
    assert len(out) == told.count()
    one = spark.createDataFrame([(1, None, 5), (2, "mail a@b.cd now", 6), (2, "mail a@b.cd now", 6)], "doc_id long, text string, start int")
    assert sorted((r.doc_id, r.text or "", r.start) for r in pii.sanitise(one).collect()) == [
        (1, "", 5), (2, "mail [EMAIL] now", 6), (2, "mail [EMAIL] now", 6)]
