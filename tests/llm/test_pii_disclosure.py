"""Disclosure statistics of the sanitisation against brute force over passages."""

import collections
import math
import random
import re

from heatwise.llm import pii
from tests.llm.test_native import EMAIL, brute_pii

SPACE = r"[\x20\t-\r]"
LONG = r"[^\x20\t-\r]"
KINDS = ["email", "ip", "card", "phone"]


def shared(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "email":
        return "@" + hit.split("@")[-1].lower()
    if kind == "ip":
        return ".".join(hit.split(".")[:3]) + ".*"
    if kind == "card":
        return digits[:6] + "*"
    return digits[:-7] + "*" if len(digits) > 7 else None


def brute_terms(rows, rule):
    """term to kind; rows are (doc_id, text)."""
    block = re.compile(rf"(?:{LONG}{{1,320}}{SPACE}{{0,320}}|{SPACE}{{1,320}}){{1,{2 * rule.window}}}")
    word = re.compile(r"[^\W\d_]{3,}")
    n_all, n_c, n_t, n_ct, docs = 0, collections.Counter(), collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for i, text in rows:
        text = text or ""
        blocks = list(block.finditer(text))
        terms = []
        for b in blocks:
            words = {w.lower() for w in word.findall(EMAIL.sub(" ", b[0]))}
            terms.append(words | {w[:rule.stem] + "*" for w in words})
        protected = [set() for _ in blocks]
        for start, _, end, kind in brute_pii(text):
            at = max(k for k, b in enumerate(blocks) if b.start() <= start)
            hit = text[start:end]
            protected[at] |= {(kind, e) for e in (hit, shared(kind, hit)) if e}
        for a in range(-1, len(blocks)):
            both = slice(max(a, 0), a + 2)
            here, who = set().union(*terms[both]), set().union(*protected[both])
            n_all += 1
            n_t.update(here)
            n_c.update(who)
            for c in who:
                for t in here:
                    n_ct[c, t] += 1
                    docs[c, t].add((i, text))

    def told(c, t):
        return (n_c[c] < n_all and math.log(n_all * n_ct[c, t] / (n_c[c] * n_t[t]))
                >= rule.threshold * math.log(n_all / n_c[c]) - 1e-12)

    enough = {k for k, d in docs.items() if len(d) >= rule.min_docs}
    out = {}
    for c, t in enough:
        if not t.endswith("*") and told(c, t):
            out[t] = "general"
    for c, t in enough:
        if t in out and (c, t[:rule.stem] + "*") in enough and told(c, t[:rule.stem] + "*"):
            out[t] = "removed"
    return out


def corpus(seed):
    rnd = random.Random(seed)
    common = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 6))) for _ in range(60)]
    names = ["Zorblatt", "zorquil", "Quexington", "mirabel", "Ümlaut", "niño"]
    rows = []
    for i in range(300):
        words = [rnd.choice(common) for _ in range(rnd.choice([0, 3, 30, 120]))]
        if i % 5 == 0:
            k = rnd.randrange(len(names))
            who = [f"p{i % 3}.x@Mail{k}.example.org", f"10.{k}.7.{i % 200}", "4111 1111 1111 1111", f"+1 ({k}17) 555-{7000 + i}"][i // 5 % 4]
            at = rnd.randint(0, len(words))
            words[at:at] = [who]
            # names far from the value too, with numbers and other values between them
            words[max(0, at - 5):max(0, at - 5)] = [names[k]] + ["12.5 99", "1.2.3.4", "a@b.cd"][:rnd.randint(0, 3)]
        rows.append((i, rnd.choice([" ", "\n", "  ", "　 "]).join(words)))
    rows += [(1000, None), (1001, ""), (1002, " \n "), (None, rows[5][1]), (None, rows[5][1]), (5, rows[5][1]),
             (1003, "x" * 1000 + " Zorblatt p0.x@mail0.example.org"), (1004, "日本語" * 400 + " 10.1.7.5 mirabel")]
    return rows


def test_terms_are_brute_force(spark):
    for seed, rule in ((1, pii.Disclosure(threshold=0.5)), (2, pii.Disclosure(threshold=0.7, min_docs=2, window=3)), (3, pii.Disclosure())):
        rows = corpus(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        keyed = pii.keyed_documents(df)
        got = {r.term: r.kind for r in pii.revealing_terms(keyed, pii.entity_spans(keyed), rule).collect()}
        want = brute_terms(rows, rule)
        assert got == want
        assert seed == 3 or set(got.values()) == {"general", "removed"} or "removed" in got.values()


def test_blocks_leave_nothing_out(spark):
    texts = [t for _, t in corpus(4) if t] + ["a" * 5000, " " * 5000, "\n".join("x" * 700), "😀" * 900 + " y"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    blocks = df.select("text", pii._blocks(pii.Disclosure()).alias("b")).collect()
    assert all("".join(r.b) == r.text for r in blocks)
    assert max(len(x) for r in blocks for x in r.b) <= 16 * 640


def test_entities_that_share_a_domain_recur(spark):
    """No address stands twice; the domain does, and the name beside it tells the domain, however many numbers lie between."""
    rows = [(i, "plain words without anything of note stand here") for i in range(100)]
    rows += [(200 + i, f"Zorblatt 1 2 3 4 5 a@b.cd wrote 77 from me{i}@secret.example") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.digest(pii.find_pii(df)).collect()}
    assert all("removed:0:8" in found[200 + i].split(",") for i in range(4)) and found[0] == ""


def test_no_findings_no_terms(spark):
    df = spark.createDataFrame([(1, "no values at all"), (2, None)], "doc_id long, text string")
    keyed = pii.keyed_documents(df)
    assert pii.revealing_terms(keyed, pii.entity_spans(keyed)).count() == 0


def test_sanitise_long_texts_is_brute_force(spark):
    rnd = random.Random(5)
    texts = ["😀é plain " * rnd.randint(0, 40) + " ".join(
        rnd.choice(["a@b.cd", "10.0.0.1", "+1 (017) 555-7713", "4111 1111 1111 1111", "word", "日本語", "x" * 700])
        for _ in range(n)) for n in (0, 1, 7, 60, 400, 3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    for i, text in enumerate(texts):
        want, at = "", 0
        for start, _, end, kind in brute_pii(text):
            if start >= at:
                want, at = want + text[at:start] + f"[{kind.upper()}]", end
        assert got[i] == want + text[at:]
