"""HTML extraction: line alignment by brute force, landmarks, and page differencing on Spark."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from heatwise.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><div id="cookie-notice"><p>We use cookies</p></div><header class="site"><h1>Site</h1></header>
<nav><ul><li><a href="/x">a</a></ul></nav><!-- <p>no</p> --><main><article class="post"><header><h1>Title &amp; co</h1>
<p class=byline>By X</p></header><p>One<br>two&nbsp;three <a href="x>y">link</a>&hellip;<p>Second<script>x="</p>"</script> part
<div class="ad-slot">Buy</div><aside>side</aside><section id="comments"><article class="comment">Nice</article></section>
<form><p>Mail</p></form><ul><li>item</li></ul></article></main><footer>foot</footer></body></html>"""


def kept(source):
    return [x.text for x in H.page_lines(source) if x.scope != H.CHROME]


def test_landmarks():
    assert kept(PAGE) == ["Title & co", "One two three link…", "Second part", "item"]


@pytest.mark.parametrize("source, want", [
    ("", []), ("plain", ["plain"]), ("a < b &lt;c&gt;", ["a < b <c>"]), ("<p>a<p>b</div>c", ["a", "b", "c"]),
    ("<nav>m<article><p>text</article>", ["text"]), ("<p>x<script>never closed", ["x"]), ("<p>x<!-- never closed", ["x"]),
    ("<p title='a>b' data-x=\"</p>\">in</p>", ["in"]), ("<article><p><b>T<br><p>U</article><p>after", ["T", "U"]),
    ("<div class='no-sidebar'>a</div><div class='left-sidebar'>b</div>", ["a"]), ("<p hidden>h</p><p>v</p>", ["v"]),
])
def test_broken_and_plain_sources(source, want):
    assert kept(source) == want


def slow_length(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 5), max_size=14))
def test_common_lines_are_a_longest_subsequence(a, b):
    got = H.common_lines(np.array(a, np.uint64), np.array(b, np.uint64))
    assert got.sum() == slow_length(a, b)
    rest = iter(b)
    assert all(x in rest for x in np.array(a)[got].tolist())


def test_pages_without_landmarks_are_differenced(spark):
    def page(own):
        return f"<div>Home | News | Sport</div><div>{own}</div><div>All rights reserved by us</div>"

    text = {k: f"The own and rather long text of page {k}, which no other page of the host has." for k in range(6)}
    rows = [(k, f"https://a.example/news/{k}", page(text[k])) for k in range(4)]
    rows += [(4, "https://b.example/only", page(text[4]))]  # no partner: nothing is shared
    rows += [(5, "http://a.example/zzz", page(text[5])), (6, "http://a.example/zzz2", page(text[5]))]  # a copy and its original
    rows += [(7, None, None), (None, "https://c.example/x", "<p>c"), (9, "", ""), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    out = {(r.page_id, r.url): r for r in H.extract_pages(df).collect()}
    assert H.extract_pages(df).count() == len(rows)
    for k in range(4):
        assert out[k, rows[k][1]].text == text[k] and out[k, rows[k][1]].n_template == 2
    assert out[4, "https://b.example/only"].text.count("\n\n") == 2
    assert out[5, "http://a.example/zzz"].text == text[5]  # its copy says nothing, the other neighbour does
    assert out[7, None].text == "" and out[7, None].n_chars == 0 and out[None, "https://c.example/x"].text == "c"
    assert H.extract_pages(df.limit(0)).count() == 0


def test_lines_outside_a_marked_article_are_differenced(spark):
    def page(k):
        return (f"<div>Home | News</div><div>Headline {k}</div><article><p>Text of article {k}, and a line of all.</p><p>Read on</p>"
                f"</article><div>Lead out of page {k}</div><div>All rights reserved</div><nav>menu {k}</nav>")

    rows = [(k, f"https://a.example/{k}", page(k)) for k in range(3)]
    rows += [(3, "https://b.example/", "<div>Long own text of a plain page.</div><main>In short.</main>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r for r in H.extract_pages(df).collect()}
    for k in range(3):
        assert out[k].text.split("\n\n") == [f"Headline {k}", f"Text of article {k}, and a line of all.", "Read on", f"Lead out of page {k}"]
        assert out[k].n_template == 3
    assert out[3].text == "Long own text of a plain page.\n\nIn short."


@pytest.mark.parametrize("source, want", [
    ("<article><h2 id='search'>a</h2><section id='related-work'><p id='how-to-reply'>b<h3 id='share-of-market'>c</section></article>",
     ["a", "b", "c"]),
    ("<h2 id='search'>a</h2><p id='how-to-reply'>b</p><span id='alert'>c</span>", ["a", "b", "c"]),
    ("<body><form id='aspnet'><div>a<nav>m</nav><div>b</div></div></form></body>", ["a", "b"]),
    ("<form><div>Head</div><article>a</article></form>", ["a"]), ("<div>Some text</div><form><p>Mail</p></form>", ["Some text"]),
])
def test_names_and_forms_that_are_no_landmark(source, want):
    assert kept(source) == want


def test_form_around_an_article_is_open():
    assert [(x.text, x.role) for x in H.page_lines("<form><div>Head</div><article>a</article></form>")] == [("Head", H.OPEN), ("a", H.BODY)]


def test_alignment_confirms_chrome_names(spark):
    def page(k, extra=""):
        return (f"<article><p>Text of article {k}.</p>{extra}<div class='ad-slot'>Buy {k}</div><p>More of {k}.</p></article>"
                f"<div class='page-footer'>foot {k}</div>")

    rows = [(k, f"https://a.example/{k}", page(k, "<div class='alert-levels'><p>Levels</p><p>of alert</p></div>" * (k == 1))) for k in range(3)]
    rows += [(3, "https://b.example/", page(3)), (4, "https://c.example/1", "<div class='alert-levels'>One<nav>x</nav></div><p>Own one"),
             (5, "https://c.example/2", "<p>Own text of another page")]
    out = {r.page_id: r for r in H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(3):
        assert out[k].text.split("\n\n") == [f"Text of article {k}.", *["Levels", "of alert"] * (k == 1), f"More of {k}."]
        assert out[k].n_template == 2
    assert out[3].text == "Text of article 3.\n\nBuy 3\n\nMore of 3." and out[3].n_template == 1  # nobody confirms
    assert out[4].text == "One\n\nOwn one" and out[4].n_template == 1


def test_runs_of_copies_are_stepped_over(spark):
    def page(own, note=""):
        return f"<div>Home | News | Sport</div><div>{own}</div><div>All rights reserved by us</div><div>{note}</div>"

    text = {k: f"The own and rather long text of page {k}, which no other page of the host has. " * 4 for k in "abcdefg"}
    rows = [(0, "http://h.example/a", page(text["a"])), (9, "http://h.example/z", page(text["b"]))]
    rows += [(k, f"http://h.example/m{k}", page(text["c"])) for k in range(1, 5)]  # equal lines
    rows += [(k, f"http://h.example/n{k}", page(text["d"], f"seen {k}")) for k in range(5, 9)]  # near copies
    rows += [(k, f"http://h.example/o{k}", page(text["e"], f"seen {k}")) for k in range(20, 26)]  # another run of them
    rows += [(k, "http://only.example/a", page(text["f"], f"seen {k}")) for k in range(30, 34)]  # recrawls of one URL
    rows += [(k, f"http://short.example/{k}", page(f"own {k}")) for k in range(40, 44)]  # mostly template
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    out = {r.page_id: r.text for r in H.extract_pages(df).collect()}
    whole = {k: text[k].strip() for k in text}
    assert out[0] == whole["a"] and out[9] == whole["b"]
    assert [out[k] for k in range(1, 5)] == [whole["c"]] * 4
    assert [out[k] for k in range(5, 9)] == [f"{whole['d']}\n\nseen {k}" for k in range(5, 9)]
    assert [out[k] for k in range(20, 26)] == [f"{whole['e']}\n\nseen {k}" for k in range(20, 26)]
    assert all(whole["f"] in out[k] for k in range(30, 34))  # nothing but copies, so nothing is template
    assert [out[k] for k in range(40, 44)] == [f"own {k}" for k in range(40, 44)]


def test_nearest_is_by_path_over_partitions(spark):
    rows = [(i, "h" if i % 3 else "hot", f"/p/{i:03d}") for i in range(200)]
    df = spark.createDataFrame([(p, h, q) for p, h, q in rows], "page long, host string, path string").repartition(9)
    got = {}
    for r in H._nearest(df).collect():
        got.setdefault(r.page, []).append((r.turn, r.partner))
    order = sorted((h, q, p) for p, h, q in rows)
    for k, (h, q, p) in enumerate(order):
        near = {x[2] for x in (order[k - 1:k] if k else []) + order[k + 1:k + 2] if x[0] == h}
        assert {x for _, x in got[p]} == near


def test_articles_of_the_tables(spark):
    import html
    import re

    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r.page_id: r.html for r in rows.collect()}
    for r in H.extract_pages(rows).collect():
        body = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
