"""Scanning of tags and open elements of a page in time linear in its length, however malformed.

``Tags`` finds one tag after the other.  A quoted attribute value may hold ``>``; a tag
whose quotes don't close ends at the next ``>``.  What has been looked for in vain is
remembered, so that no stretch is read again for every tag.  ``Elements`` is the stack of
open elements with what has to be known of it kept up to date.
"""

from __future__ import annotations

import re
from bisect import bisect_left

_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_TAG = re.compile(_OPEN.pattern + r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_SPECIAL = re.compile(r"[>\"']")
_USUAL = 512  # characters of a tag that are tried in one go


class Tags:
    """Tags of ``source``: ``next(at)`` gives (start, end, closing, name, attributes); no name for what is no element."""

    def __init__(self, source: str):
        self.source = source
        self.last = source.rfind(">")
        self._specials: list[int] | None = None
        self._last_quote: dict[str, int] = {}
        self._closed: dict[int, int] = {}  # where a tag ends whose value opens at this quote
        self._unclosed: set[str] = set()

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        source = self.source
        while True:
            i = source.find("<", at)
            if i < 0:
                return None
            if i > self.last:  # no tag ends after this; a comment may begin
                i = source.find("<!--", i)
                return None if i < 0 else (i, len(source), "", "", "")
            if source.startswith("<!--", i):
                close = source.find("-->", i + 4)
                return i, len(source) if close < 0 else close + 3, "", "", ""
            if source[i + 1] in "!?":
                return i, source.find(">", i + 2) + 1, "", "", ""
            m = _TAG.match(source, i, i + _USUAL)
            if m is not None:
                return i, m.end(), m[1], m[2], m[3]
            m = _OPEN.match(source, i)
            if m is None:
                at = i + 1
                continue
            end = self._end(m.end())
            end = source.find(">", m.end()) if end < 0 else end
            return i, end + 1, m[1], m[2], source[m.end():end]

    def _end(self, at: int) -> int:
        """The first ``>`` from ``at`` on that is in no quotes, -1 if the quotes don't close."""
        if self._specials is None:
            self._specials = [m.start() for m in _SPECIAL.finditer(self.source)]
            self._last_quote = {q: self.source.rfind(q) for q in "\"'"}
        passed, found = [], -1
        while True:
            k = bisect_left(self._specials, at)
            if k == len(self._specials):
                break
            k = self._specials[k]
            quote = self.source[k]
            if quote == ">":
                found = k
                break
            if k in self._closed:
                found = self._closed[k]
                break
            passed.append(k)
            if k >= self._last_quote[quote]:
                break
            at = self.source.find(quote, k + 1) + 1
        for k in passed:
            self._closed[k] = found
        return found

    def end_of(self, name: str, at: int) -> int:
        """Where the next closing tag of ``name`` ends, -1 if there is none from ``at`` on."""
        if name in self._unclosed:
            return -1
        close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(self.source, at)
        if close is None:
            self._unclosed.add(name)
            return -1
        end = self.source.find(">", close.end()) if close.end() <= self.last else -1
        return len(self.source) if end < 0 else end + 1


class Elements:
    """Open elements (name, scope, landmark, heading only), with the questions that a page asks at every tag."""

    def __init__(self, blocks: set[str], body: int):
        self._blocks, self._body = blocks, body
        self.items: list[tuple[str, int, str, bool, int]] = []  # last: first of the top elements of this scope in a row
        self._where: dict[str, list[int]] = {}
        self._block_at: list[int] = []
        self._bodies = 0

    def __bool__(self) -> bool:
        return bool(self.items)

    @property
    def top(self) -> tuple[str, int, str, bool, int]:
        return self.items[-1]

    def push(self, name: str, scope: int, mark: str, heading_only: bool) -> None:
        at = len(self.items)
        since = self.items[-1][4] if at and self.items[-1][1] == scope else at
        self.items.append((name, scope, mark, heading_only, since))
        self._where.setdefault(name, []).append(at)
        if name in self._blocks:
            self._block_at.append(at)
        self._bodies += scope == self._body

    def pop(self) -> None:
        name, scope, *_ = self.items.pop()
        self._where[name].pop()
        if name in self._blocks:
            self._block_at.pop()
        self._bodies -= scope == self._body

    def cut(self, depth: int) -> None:
        while len(self.items) > depth:
            self.pop()

    def last(self, name: str) -> int:
        """Depth of the innermost open element of this name, -1 if there is none."""
        found = self._where.get(name)
        return found[-1] if found else -1

    def block_inside(self, depth: int) -> bool:
        """Whether a block is open inside the element at ``depth``."""
        return bool(self._block_at) and self._block_at[-1] > depth

    def one_scope(self, depth: int) -> bool:
        """Whether all elements from ``depth`` on have the scope of the top one."""
        return self.items[-1][4] <= depth

    @property
    def in_body(self) -> bool:
        return self._bodies > 0
