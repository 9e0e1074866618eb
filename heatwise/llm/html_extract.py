"""Main text of web pages by nearest-URL page differencing.

Pages of a host are ordered by URL path and each is paired with its nearest neighbours.
The text lines of a pair are aligned by longest common subsequence, and lines that both
pages have are template text and deleted.

Text alone can't decide every line: a menu or an advert may differ on each page, and two
articles may share a paragraph.  So the lines carry what their markup says.  A line in a
page landmark (menu, header, footer, sidebar, form, notice, advert, comments) is aligned
by its landmark instead of its words, and goes whether a partner has it or not; a line in
an article body is aligned by its words and stays.  All other lines stand or fall by the
alignment, also those outside the article of a page that marks one.  A partner of which
nearly all text is shared is a copy and says nothing about the template.  Pages of equal
lines are one page for the pairing; a page between copies is compared with the nearest
pages before and after the run of copies.  Where nothing but copies is on the host, short
pages may share their template only: lines that two further pages at other paths share
are set aside, and if the rest is the page's own, they are the template.

Only hashes and lengths of lines are shuffled for pairing; the order over all hosts is a
range-partitioned sort, so a host with a third of all pages is spread like any other.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatwise.llm.common import broadcast_checked, land
from heatwise.llm.html_scan import Elements, Tags

COPY_SHARE = 0.8
BODY, OPEN, CHROME = 2, 1, 0
# chrome by a name that may mislead: goes unless a partner lacks it, or only if a partner has it
LIKELY, UNLIKELY = 3, 4
OUTSIDE = "outside"
_FORM = "form\x00"

# Elements and names by which pages mark what isn't article text.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
_SKIPPED = _RAW | {"noscript", "template", "svg", "button", "select", "object", "canvas", "audio", "video"}
_CHROME_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head"}
_CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog",
                 "alert", "menu", "menubar", "toolbar"}
_CHROME_NAMES = {"nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer",
                 "sidebar", "aside", "widget", "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adbox",
                 "banner", "sponsor", "sponsored", "promo", "promoted", "promotion", "cookie", "cookies", "consent",
                 "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup",
                 "login", "share", "sharing", "social", "related", "recommended", "comment", "comments", "commentlist",
                 "disqus", "respond", "reply", "replies", "copyright", "toolbar", "pagination", "pager", "search",
                 "searchform", "skip", "disclaimer"}
# of an article's own names only these say that it isn't the page's article
_SIDE_ARTICLE = {"comment", "comments", "reply", "replies", "ad", "ads", "advert", "promo", "related", "sponsored"}
_BODY_NAMES = {"content", "main-content", "article-body", "article-content", "post-content", "post-body",
               "entry-content", "story-body", "article", "maincontent", "article-text"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_BLOCKS = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl",
           "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
           "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody",
           "td", "tfoot", "th", "thead", "tr", "ul", "head", "caption"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# what a class or id name may mark as chrome; of others only the class counts, outside an article
_CONTAINERS = _BLOCKS - _HEADINGS - {"p", "li", "dt", "dd", "pre", "hr", "tr", "td", "th", "thead", "tbody", "tfoot", "caption",
                                     "summary", "figcaption", "address"}
_DOUBT = {"?": LIKELY, "*": UNLIKELY}  # first letter of a landmark's name
_NEGATED = ("no", "without", "with", "has", "non", "is")

_ATTRIBUTE = re.compile(r"(?<![a-zA-Z_:-])([a-zA-Z_:-]++)\s*+=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_URL = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://)?([^/?#]*)([^?#]*)")


@dataclass
class Line:
    text: str
    scope: int
    mark: str  # landmark of a line that isn't text of the article

    @property
    def role(self) -> int:
        """Scope for the alignment, which decides the lines outside a marked article and the doubtful landmarks."""
        if self.scope == CHROME:
            return OPEN if self.mark == OUTSIDE else _DOUBT.get(self.mark[:1], CHROME)
        return self.scope


def _named(value: str, names: set[str]) -> str | None:
    """The first class or id name that is one of ``names``, by itself or by its first or last part."""
    for name in value.lower().split():
        if name in names:
            return name
        parts = re.split(r"[-_]+", name)
        if parts[0] not in _NEGATED and (parts[0] in names or parts[-1] in names):
            return name
    return None


def _kind(tag: str, attributes: str, in_body: bool) -> tuple[int | None, str]:
    """(scope that the element opens, landmark), None if it leaves the scope as it is.

    A name marks a block container.  In an article body only its class does, and in doubt;
    outside, a name of which only a part is known is in doubt.
    """
    found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
    role = found.get("role", "").strip().lower()
    names = f"{found.get('class', '')} {found.get('id', '')}"
    if tag in ("article", "main"):
        side = _named(names, _SIDE_ARTICLE)
        return (CHROME, f"{tag}.{side}") if side else (BODY, "")
    if tag in ("html", "body"):
        return None, ""
    if role in ("main", "article") or found.get("itemprop", "") == "articleBody":
        return BODY, ""
    if role in _CHROME_ROLES:
        return CHROME, f"role.{role}"
    if tag == "header" and in_body:
        return None, "header"
    if tag in _CHROME_TAGS:
        return CHROME, tag
    style = found.get("style", "").replace(" ", "").lower()
    if "display:none" in style or found.get("aria-hidden", "").lower() == "true" or re.search(
            r"(?:^|\s)hidden(?:\s|$)", re.sub(_ATTRIBUTE, " ", attributes)):
        return CHROME, "hidden"
    if names.strip():
        if any(n in _BODY_NAMES for n in names.lower().split()):
            return BODY, ""
        if tag not in _CONTAINERS or in_body:
            names = "" if in_body and tag not in _CONTAINERS else found.get("class", "")
        if side := _named(names, _CHROME_NAMES):
            return CHROME, f"*{side}" if in_body else side if side in _CHROME_NAMES else f"?{side}"
    return None, ""


def page_lines(source: str) -> list[Line]:
    """Text lines (blocks) of a page in order, with scope and landmark.

    White space inside a line is one space; a line break element is white space.  A form
    that wraps the page is no landmark: one that holds an article, or, on a page without,
    more text than stands outside of it and of other landmarks.
    """
    lines, around = _lines(source, frozenset())
    sizes: dict[str, int] = {}
    for x in lines:
        name = x.mark if x.mark.startswith(_FORM) else "" if x.scope == OPEN else None
        if name is not None:
            sizes[name] = sizes.get(name, 0) + len(x.text)
    if not any(x.scope == BODY for x in lines):
        around |= {k for k, n in sizes.items() if k and n > sizes.get("", 0)}
    if around:
        lines = _lines(source, frozenset(around))[0]
    marked = any(x.scope == BODY for x in lines)
    for x in lines:
        if x.mark.startswith(_FORM):
            x.mark = "form"
        if marked and x.scope == OPEN:  # by the markup alone they are no text of the article
            x.scope, x.mark = CHROME, OUTSIDE
    return lines


def _lines(source: str, around: frozenset[str]) -> tuple[list[Line], set[str]]:
    """Lines with the forms as landmarks by number, but for those in ``around``; and the forms that hold an article."""
    lines: list[Line] = []
    forms, holding = 0, set()
    text: list[str] = []
    stack = Elements(_BLOCKS, BODY)
    scope, mark, heading_only = OPEN, "", False
    tags = Tags(source)

    def end_line() -> None:
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if joined:
                hidden = heading_only and not (stack and stack.top[0] in _HEADINGS)
                lines.append(Line(joined, CHROME if hidden else scope, "header" if hidden else mark))

    def state() -> tuple[int, str, bool]:
        return stack.top[1:4] if stack else (OPEN, "", False)

    at = 0
    while True:
        found = tags.next(at)
        if found is None:
            text.append(source[at:])
            break
        start, end, closing, tag, attributes = found
        if start > at:
            text.append(source[at:start])
        at = end
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
            continue
        block = tag in _BLOCKS or tag in _CHROME_TAGS
        if block:
            end_line()
        if closing:
            depth = stack.last(tag)
            if depth >= 0:
                if not block and stack.block_inside(depth):
                    continue  # an inline element doesn't end the blocks inside it
                if not stack.one_scope(depth):
                    end_line()
                stack.cut(depth)
                scope, mark, heading_only = state()
            continue
        if tag in _SKIPPED:  # what is in it is no text of the page, nor does it end a line
            close = tags.end_of(tag, at)
            if close >= 0:
                at = close
            elif tag in _RAW:
                at = len(source)
            continue
        if tag in _VOID:
            continue
        new, landmark = _kind(tag, attributes, stack.in_body)
        if tag == "form":
            forms += 1
            if landmark == "form":
                landmark = f"{_FORM}{forms}"
                if landmark in around:
                    new, landmark = None, ""
        if tag in ("article", "main") and new == BODY and scope == CHROME:
            # an unclosed landmark doesn't reach into the article
            while stack and stack.top[1] == CHROME and stack.top[0] not in ("aside", "article", "main"):
                if stack.top[2].startswith(_FORM):
                    holding.add(stack.top[2])
                stack.pop()
            scope, mark, heading_only = state()
        if tag == "p" or tag in _HEADINGS:
            while stack and (stack.top[0] == "p" or stack.top[0] not in _BLOCKS and stack.last("p") >= 0):
                stack.pop()
            scope, mark, heading_only = state()
        sure = new == CHROME and landmark[:1] not in _DOUBT and mark[:1] in _DOUBT
        if new is not None and (scope != CHROME or sure) and not (scope == BODY and new == BODY):
            end_line()
            scope, mark = new, landmark
        elif landmark == "header" and new is None and scope == BODY:
            heading_only = True
        stack.push(tag, scope, mark, heading_only)
    end_line()
    return lines, holding


def line_keys(lines: list[Line]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, scope, length, number of first line); lines that follow each other in a landmark are one."""
    keys, scopes, sizes, first = [], [], [], []
    for i, x in enumerate(lines):
        landmark = x.role not in (OPEN, BODY)
        name = f"\x00{x.mark.lstrip('?*')}" if landmark else x.text
        if landmark and i and lines[i - 1].role == x.role and lines[i - 1].mark == x.mark:
            sizes[-1] += len(x.text)
            continue
        keys.append(xxhash.xxh64_intdigest(name))
        scopes.append(x.role)
        sizes.append(len(x.text))
        first.append(i)
    return (np.array(keys, dtype=np.uint64), np.array(scopes, dtype=np.int64), np.array(sizes, dtype=np.int64),
            np.array(first, dtype=np.int64))


def common_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which elements of ``a`` are in one longest common subsequence of ``a`` and ``b``.

    Common ends and lines of one side are cut away, then rows of the table are bit
    vectors.  Up to ``LCS_BITS`` the n rows of m bits are kept for the walk back; a larger
    table is halved (Hirschberg), which keeps two rows at a time for twice the work.
    """
    out = np.zeros(len(a), dtype=bool)
    lo, ha, hb = 0, len(a), len(b)
    while lo < ha and lo < hb and a[lo] == b[lo]:
        out[lo] = True
        lo += 1
    while ha > lo and hb > lo and a[ha - 1] == b[hb - 1]:
        ha, hb = ha - 1, hb - 1
        out[ha] = True
    ia = lo + np.flatnonzero(np.isin(a[lo:ha], b[lo:hb]))
    right = b[lo:hb][np.isin(b[lo:hb], a[lo:ha])].tolist()
    left = a[ia].tolist()
    if not left:
        return out
    out[ia[_common(left, right)]] = True
    return out


LCS_BITS = 1 << 28


def _rows(left: list[int], right: list[int]) -> Iterator[int]:
    """The table's rows as bits: bit j of row i is zero where the length grows at column j."""
    places: dict[int, list[int]] = {}
    for j, x in enumerate(right):
        places.setdefault(x, []).append(j)

    def bits(at: list[int]) -> int:
        out = bytearray(len(right) // 8 + 1)
        for j in at:
            out[j >> 3] |= 1 << (j & 7)
        return int.from_bytes(out, "little")

    held = {x: bits(at) for x, at in places.items()} if len(places) * len(right) <= LCS_BITS else None
    full = (1 << len(right)) - 1
    row = full
    for x in left:
        u = row & (held[x] if held is not None else bits(places[x])) if x in places else 0
        row = ((row + u) | (row - u)) & full
        yield row


def _lengths(row: int, columns: int) -> np.ndarray:
    """Length of the common subsequence with the first j columns, j from 0 on, of a row."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(columns // 8 + 1, "little"), np.uint8), bitorder="little")[:columns]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _common(left: list[int], right: list[int]) -> list[int]:
    """Which elements of ``left`` are in one longest common subsequence."""
    if not left or not right:
        return []
    if len(left) * len(right) > LCS_BITS and len(left) > 1:
        half = len(left) // 2
        row = (1 << len(right)) - 1
        for row in _rows(left[:half], right):
            pass
        back = (1 << len(right)) - 1
        for back in _rows(left[half:][::-1], right[::-1]):
            pass
        cut = int(np.argmax(_lengths(row, len(right)) + _lengths(back, len(right))[::-1]))
        return _common(left[:half], right[:cut]) + [half + i for i in _common(left[half:], right[cut:])]
    rows, out = list(_rows(left, right)), []
    j = len(right) - 1
    for i in range(len(left) - 1, -1, -1):
        # walk back to the column where this row's length is reached
        while j >= 0 and rows[i] >> j & 1:
            j -= 1
        if j < 0:
            break
        if i == 0 or rows[i - 1] >> j & 1:
            out.append(i)
            j -= 1
    return out[::-1]


def template_lines(own: tuple, partner: np.ndarray) -> tuple[np.ndarray, bool]:
    """(numbers of the open lines and doubtful landmarks that the partner shares, whether the partner is a copy)."""
    keys, scopes, sizes, first = own
    shared = common_lines(keys, partner)
    text = (scopes == OPEN) | (scopes == BODY)
    asked = (scopes == OPEN) | (scopes >= LIKELY)
    copy = bool(asked.any() and text.any() and sizes[text & shared].sum() >= COPY_SHARE * sizes[text].sum())
    return first[asked & shared], copy


def kept_lines(lines: list[Line], shared: list[int] | None) -> tuple[list[Line], int]:
    """(lines of the text, number of the others) from the shared lines' numbers, None if no partner says anything.

    A doubtful landmark is shared by the number of the first of its lines.
    """
    kept, had, first = [], set(shared or ()), 0
    for i, x in enumerate(lines):
        role = x.role
        if not (i and lines[i - 1].role == role and lines[i - 1].mark == x.mark):
            first = i
        gone = (role == CHROME or role == OPEN and i in had or role in (LIKELY, UNLIKELY) and first in had
                or role == LIKELY and shared is None)
        if not gone:
            kept.append(x)
    return kept, len(lines) - len(kept)


def _host_path(url: str) -> tuple[str, str]:
    m = _URL.match(url)
    return m[1].lower(), m[2]


def shared_by_three(own: tuple, one: np.ndarray, two: np.ndarray) -> np.ndarray | None:
    """Numbers of the open lines and doubtful landmarks that both pages share, None if ``one`` is a copy apart from them."""
    keys, scopes, sizes, first = own
    with_one, with_two = common_lines(keys, one), common_lines(keys, two)
    text = (scopes == OPEN) | (scopes == BODY)
    rest = text & ~(with_one & with_two)
    if not rest.any() or max(sizes[rest & with_one].sum(), sizes[rest & with_two].sum()) >= COPY_SHARE * sizes[rest].sum():
        return None
    return first[((scopes == OPEN) | (scopes >= LIKELY)) & with_one & with_two]


def _ranked(keys: DataFrame) -> DataFrame:
    """(host, path, page, rank, part): a position over all pages in order of host and path.

    It comes from a range-partitioned sort: partition offsets plus the place in the partition.
    """
    order = land(keys.select("host", "path", "page").repartitionByRange("host", "path", "page")
                 .sortWithinPartitions("host", "path", "page").withColumn("at", F.monotonically_increasing_id())
                 .select("*", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("place")),
                 "page-order")
    sizes = order.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row per partition
    before = sizes.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    return order.join(F.broadcast(before), "part").select(
        "host", "path", "page", (F.col("offset") + F.col("place")).alias("rank"), "part")


def _near(path: str, other: str):
    """Length of the common start of two paths."""
    return F.length(F.regexp_extract(F.concat(path, F.lit("\n"), other), r"^([^\n]*)[^\n]*\n\1", 1))


def _nearest(keys: DataFrame) -> DataFrame:
    """(page, partner, turn): each page's neighbours in path order on its host, the nearer one (turn 0) first.

    Neighbours meet by an equi-join on the position.
    """
    return _neighbours(_ranked(keys))


def _neighbours(placed: DataFrame) -> DataFrame:
    after = placed.select(F.col("host").alias("h"), F.col("path").alias("q"), F.col("page").alias("other"),
                          (F.col("rank") - 1).alias("rank"))
    pairs = placed.join(after, "rank").where("host = h").withColumn("near", _near("path", "q"))
    both = pairs.select("page", F.col("other").alias("partner"), "near", F.lit(1).alias("side")).unionByName(
        pairs.select(F.col("other").alias("page"), F.col("page").alias("partner"), "near", F.lit(0).alias("side")))
    return _in_turn(both)


def _in_turn(both: DataFrame) -> DataFrame:
    """(page, partner, turn) of at most two partners a page, the nearer one first."""
    best = F.sort_array(F.collect_list(F.struct((-F.col("near")).alias("far"), "side", "partner")))  # two at most
    return both.groupBy("page").agg(best.alias("p")).select("page", F.posexplode("p").alias("turn", "p")).select(
        "page", "p.partner", "turn")


def _beyond(placed: DataFrame, linked: DataFrame, stuck: DataFrame) -> DataFrame:
    """(page, partner, turn) of ``stuck`` pages: the nearest pages before and after their run of copies.

    ``linked`` has the pages that are a copy of the one before them.  The first page of
    each run is carried on by running values per range partition and over the partitions.
    """
    known = placed.join(linked.select("page", F.lit(True).alias("linked")), "page", "left")
    begins = land(known.select("host", "path", "page", "rank", "part",
                               F.when(F.col("linked").isNull(), F.col("rank")).alias("begin")), "page-runs")
    of_parts = begins.groupBy("part").agg(F.max("begin").alias("last"), F.min("begin").alias("first"))  # one row per partition
    by_part = Window.orderBy("part")
    carried = of_parts.select("part", F.max("last").over(by_part.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
                              F.min("first").over(by_part.rowsBetween(1, Window.unboundedFollowing)).alias("behind"))
    here = Window.partitionBy("part").orderBy("rank")
    runs = begins.join(F.broadcast(carried), "part").select(
        "host", "path", "page",
        F.coalesce(F.max("begin").over(here.rowsBetween(Window.unboundedPreceding, 0)), "before").alias("first"),
        F.coalesce(F.min("begin").over(here.rowsBetween(1, Window.unboundedFollowing)), "behind").alias("next"))
    asked = runs.join(stuck, "page", "left_semi").select("host", "path", "page", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), (F.col("first") - 1).alias("rank")),
        F.struct(F.lit(1).alias("side"), F.col("next").alias("rank")))).alias("t")).select("host", "path", "page", "t.*")
    wanted = asked.select("rank").where("rank IS NOT NULL").distinct()
    targets = land(placed.join(wanted, "rank", "left_semi").select(
        "rank", F.col("host").alias("h"), F.col("path").alias("q"), F.col("page").alias("partner")), "page-targets")
    pairs = asked.join(broadcast_checked(targets), "rank").where("host = h").withColumn("near", _near("path", "q"))
    return _in_turn(pairs.select("page", "partner", "near", "side"))


def _thirds(placed: DataFrame, stuck: DataFrame) -> DataFrame:
    """(page, one, two) of ``stuck`` pages that have two near pages on their host, all three at different paths."""
    asked = placed.join(stuck, "page", "left_semi").select("host", "path", "page", F.posexplode(
        F.array(*[F.col("rank") + k for k in (-1, 1, -2, 2)])).alias("turn", "rank"))
    others = placed.select("rank", F.col("host").alias("h"), F.col("path").alias("q"), F.col("page").alias("other"))
    met = asked.join(others, "rank").where("host = h AND path <> q").groupBy("page", "q").agg(  # four at most
        F.min(F.struct("turn", "other")).alias("x")).groupBy("page").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return met.where(F.size("x") >= 2).select("page", F.col("x")[0]["other"].alias("one"), F.col("x")[1]["other"].alias("two"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_template) of every page row.

    ``pages`` has page_id, url and html.  Blocks are joined by two line feeds in page
    order; character references are decoded.  Null or empty html gives the empty text; a
    null url is a host of its own without a name; repeated rows come out each and are one
    page for the pairing; null ids stay null; other columns are left out.
    ``n_template`` counts the lines that were deleted as template text.
    """
    source = F.coalesce(pages["html"].cast("string"), F.lit(""))
    url = pages["url"].cast("string")
    page = F.xxhash64(pages["page_id"].cast("long"), url, source)
    rows = pages.select(page.alias("page"), pages["page_id"].cast("long").alias("page_id"), url.alias("url"),
                        source.alias("html"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, u, h in zip(*(batch.column(i).to_pylist() for i in range(3))):
                keys, scopes, sizes, first = line_keys(page_lines(h))
                out.append((key, *_host_path(u or ""), keys.tobytes(), scopes.astype(np.int8).tobytes(),
                            sizes.tobytes(), first.tobytes(), bool(((scopes == OPEN) | (scopes >= LIKELY)).any())))
            cols = list(zip(*out)) or [()] * 8
            kinds = [pa.int64(), pa.string(), pa.string(), *[pa.binary()] * 4, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["page", "host", "path", "keys", "scopes", "sizes", "first", "asking"])

    # asking: has open lines or doubtful landmarks, which alone are decided
    keys = land(rows.select("page", "url", "html").mapInArrow(
        keyed, "page long, host string, path string, keys binary, scopes binary, sizes binary, first binary, asking boolean"
    ).dropDuplicates(["page"]).withColumn("same", F.xxhash64("host", "keys", "scopes", "first")), "page-lines")
    # pages of a host with equal lines are one, the first by path
    chosen = land(keys.groupBy("host", "same").agg(F.min(F.struct("path", "page")).alias("x"))
                  .select("host", "same", "x.path", "x.page"), "page-groups")
    placed = land(_ranked(chosen), "page-ranks")
    own = land(keys.where("asking").join(chosen.select("page"), "page", "left_semi"), "page-asking")
    theirs = keys.select(F.col("page").alias("partner"), F.col("keys").alias("other"))

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for p, turn, k, c, z, f, other in zip(*(batch.column(i).to_pylist() for i in range(7))):
                own = (np.frombuffer(k, np.uint64), np.frombuffer(c, np.int8).astype(np.int64),
                       np.frombuffer(z, np.int64), np.frombuffer(f, np.int64))
                gone, copy = template_lines(own, np.frombuffer(other, np.uint64))
                out.append((p, turn, None if copy else gone.tolist()))
            cols = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                                              pa.array(cols[2], pa.list_(pa.int64()))], names=["page", "turn", "gone"])

    def differ_three(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for p, k, c, z, f, one, two in zip(*(batch.column(i).to_pylist() for i in range(7))):
                own = (np.frombuffer(k, np.uint64), np.frombuffer(c, np.int8).astype(np.int64),
                       np.frombuffer(z, np.int64), np.frombuffer(f, np.int64))
                gone = shared_by_three(own, np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64))
                if gone is not None:
                    out.append((p, gone.tolist()))
            cols = list(zip(*out)) or [()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.int64()))],
                                             names=["page", "gone"])

    def compare(pairs: DataFrame, name: str) -> DataFrame:
        """(page, partner, turn, gone), null ``gone`` for a copy."""
        met = land(pairs.join(own.select("page"), "page", "left_semi"), f"{name}-pairs")
        found = (met.join(own, "page").join(theirs, "partner")
                 .select("page", "turn", "keys", "scopes", "sizes", "first", "other")
                 .mapInArrow(differ, "page long, turn int, gone array<long>"))
        return land(found.join(met, ["page", "turn"]), name)

    def settled(compared: DataFrame) -> DataFrame:
        return compared.where("gone IS NOT NULL").groupBy("page").agg(F.min_by("gone", "turn").alias("gone"))

    beside = compare(_neighbours(placed), "page-neighbours")
    stuck = land(beside.groupBy("page").agg(F.count("gone").alias("n")).where("n = 0").select("page"), "page-stuck")
    # a copy in either direction links a page to the one before it
    ranks = placed.select("page", "rank")
    copies = (beside.where("gone IS NULL").select("page", "partner").join(ranks, "page")
              .join(ranks.withColumnsRenamed({"page": "partner", "rank": "other"}), "partner"))
    linked = copies.select(F.when(F.col("rank") > F.col("other"), F.col("page")).otherwise(F.col("partner")).alias("page")).distinct()
    beyond = compare(_beyond(placed, linked, stuck), "page-beyond")
    alone = land(stuck.join(settled(beyond).select("page"), "page", "left_anti"), "page-alone")
    three = (_thirds(placed, alone).join(own, "page")
             .join(keys.select(F.col("page").alias("one"), F.col("keys").alias("key_one")), "one")
             .join(keys.select(F.col("page").alias("two"), F.col("keys").alias("key_two")), "two")
             .select("page", "keys", "scopes", "sizes", "first", "key_one", "key_two")
             .mapInArrow(differ_three, "page long, gone array<long>"))
    of_chosen = land(settled(beside).unionByName(settled(beyond)).unionByName(three), "page-template")
    # to all pages with the same lines, by the chosen page
    groups = chosen.join(of_chosen, "page").select(F.col("host").alias("h"), F.col("same").alias("s"), "gone")
    gone = keys.select("page", "host", "same").join(
        broadcast_checked(land(groups, "group-template")), (F.col("host") == F.col("h")) & (F.col("same") == F.col("s"))
    ).select("page", "gone")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for h, drop in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                left = kept_lines(page_lines(h), drop)
                texts.append("\n\n".join(x.text for x in left[0]))
                counts.append(left[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_template"])

    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
                           T.StructField("n_template", T.LongType())])
    return rows.join(gone, "page", "left").select("page_id", "url", "html", "gone").mapInArrow(finish, schema)
