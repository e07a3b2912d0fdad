"""Pages as trees of nodes in arrays: a forgiving HTML reader that keeps what main-text extraction needs."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import numpy as np

# Fixed values of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
SILENT = frozenset("script style noscript template iframe object embed canvas svg audio video head title textarea select button datalist".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
#: Raw elements that take the rest of the page if they have no end; after any other one without an end the page goes on.
ENDLESS = frozenset("script style textarea title".split())
RAW_END = {name: re.compile(f"</{name}", re.IGNORECASE | re.ASCII) for name in RAW}
#: What can stand in a head; any other element, and text, ends an open head.
HEAD = frozenset("html head base basefont bgsound link meta title style script noscript template noframes".split())
CLOSES = {  # an opening tag ends the nearest of these, unless one of the fences lies between
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody"), ("table",)),
    "tfoot": (("thead", "tbody"), ("table",)),
    "option": (("option",), ("select",)),
}
FENCES = frozenset("article aside blockquote body button details div fieldset footer form header html main nav object section table td th ul ol dl li".split())

# Tags and attribute words that speak for or against main text.
CONTENT_TAGS = frozenset("article main".split())
NOISE_TAGS = frozenset("nav footer aside form menu dialog header".split())
CONTENT_WORDS = frozenset("article main content post entry story body text articlebody maincontent blogpost".split())
NOISE_WORDS = frozenset(
    "nav navigation navbar menu menubar topbar breadcrumb breadcrumbs header masthead banner footer foot copyright sidebar aside rail widget related recommended "
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe "
    "signup login search form share sharing social comment comments disqus reply replies respond pagination pager toolbar skip tags contentinfo complementary".split()
)
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
SPACE = re.compile(r"\s+")
END = re.compile(r"[\"'>]")


_met: dict[str, tuple[int, int]] = {}


def attribute_words(said: str) -> tuple[int, int]:
    """How many words of class, id, role and the like speak for and against main text; remembered, as they recur."""
    if said in _met:
        return _met[said]
    good = bad = 0
    for name, value in ATTRIBUTE.findall(said):
        if name.lower() in ("class", "id", "role", "itemprop", "aria-label", "name"):
            words = {w.lower() for w in PIECES.findall(unescape(value))}
            good, bad = good + len(words & CONTENT_WORDS), bad + len(words & NOISE_WORDS)
    if len(_met) > 20_000:
        _met.clear()
    _met[said] = (good, bad)
    return good, bad


TEXT = "#text"


@dataclass
class Page:
    """Nodes in document order: elements and runs of text; ``end`` is the first node behind a node's subtree."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    depths: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    words: list[tuple[int, int]] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)  # of runs of text, "" of elements
    blocks: list[int] = field(default_factory=list)


class _Reader:
    def __init__(self, html: str):
        self.html, self.page, self.block = html, Page(), 0
        self.stack: list[int] = []
        self.open: Counter[str] = Counter()
        self.last = {q: html.rfind(q) for q in "\"'"}
        self.endless: set[str] = set()
        self.more: dict[int, list[str]] = {}  # what follows a run of text in the same block, by its node
        self._start("#page", "")

    def _add(self, tag: str, words: tuple[int, int], text: str) -> int:
        page, n = self.page, len(self.page.tags)
        page.tags.append(tag)
        page.parents.append(self.stack[-1] if self.stack else -1)
        page.depths.append(len(self.stack))
        page.ends.append(n + 1)
        page.words.append(words)
        page.texts.append(text)
        page.blocks.append(self.block)
        return n

    def _start(self, tag: str, said: str) -> None:
        if tag in BLOCK:
            self.block += 1
        n = self._add(tag, attribute_words(said) if said else (0, 0), "")
        self.stack.append(n)
        self.open[tag] += 1

    def _pop(self) -> str:
        n = self.stack.pop()
        tag = self.page.tags[n]
        self.page.ends[n] = len(self.page.tags)
        self.open[tag] -= 1
        if tag in BLOCK:
            self.block += 1
        return tag

    def _close(self, tags: tuple[str, ...], fences: frozenset[str] | tuple[str, ...]) -> None:
        """End the nearest open element of ``tags`` unless a fence is nearer."""
        if not any(self.open[t] for t in tags):
            return
        for n in reversed(self.stack):
            if self.page.tags[n] in tags:
                while self.stack and self.stack[-1] != n:
                    self._pop()
                self._pop()
                return
            if self.page.tags[n] in fences:
                return

    def _tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag, quotes respected if they are closed."""
        while found := END.search(self.html, at):
            if found[0] == ">":
                return found.start()
            if found.start() >= self.last[found[0]]:
                stop = self.html.find(">", found.end())
                return stop if stop >= 0 else len(self.html)
            at = self.html.index(found[0], found.end()) + 1
        return len(self.html)

    def read(self) -> Page:
        html, at = self.html, 0
        while at < len(html):
            mark = html.find("<", at)
            if mark < 0:
                mark = len(html)
            nxt = html[mark + 1 : mark + 2]
            if mark < len(html) and not (nxt.isalpha() and nxt.isascii()) and nxt not in "/!?":
                after = html.find("<", mark + 1)
                mark = after if after >= 0 else len(html)
                self._text(html[at:mark])
                at = mark
                continue
            if mark > at:
                self._text(html[at:mark])
            if mark == len(html):
                break
            if html.startswith("<!--", mark):
                stop = html.find("-->", mark + 2)
                at = stop + 3 if stop >= 0 else len(html)
            elif nxt in ("!", "?", ""):
                stop = html.find(">", mark)
                at = stop + 1 if stop >= 0 else len(html)
            else:
                stop = self._tag_end(mark + 1)
                inner = html[mark + 1 : stop]
                at = stop + 1
                closing = inner.startswith("/")
                name = re.match(r"/?([^\s/>]*)", inner)[1].lower()
                if closing:
                    self._end(name)
                    continue
                if name in RAW:
                    if name in self.endless:
                        continue
                    found = RAW_END[name].search(html, at)
                    stop = found.start() if found else -1
                    if stop < 0 and name not in ENDLESS:
                        self.endless.add(name)  # no later one has an end either
                        continue
                    after = html.find(">", stop) if stop >= 0 else -1
                    at = after + 1 if after >= 0 else len(html)
                    continue
                self._open_tag(name, inner)
        while self.stack:
            self._pop()
        for i, parts in self.more.items():
            self.page.texts[i] += "".join(parts)
        return self.page

    def _end_head(self) -> None:
        """End an open head and what stands open in it."""
        if self.open["head"]:
            self._close(("head",), frozenset())

    def _open_tag(self, name: str, inner: str) -> None:
        if name not in HEAD:
            self._end_head()
        if name in CLOSES:
            self._close(*CLOSES[name])
        if name in BLOCK and name not in ("body", "html"):
            self._close(("p",), FENCES)
        if name == "br":
            self._text(" ")
        elif name in VOID:
            self.block += name in BLOCK
        elif not (name in ("html", "body") and self.open[name]):
            self._start(name, inner[len(name) :].rstrip("/"))
            if inner.endswith("/") and name in ("svg", "math"):
                self._pop()

    def _end(self, name: str) -> None:
        if self.open[name]:
            fences = frozenset() if name in FENCES else frozenset(("td", "th", "table", "article", "body"))
            self._close((name,), fences)

    def _text(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        if self.open["head"] and not text.isspace():
            self._end_head()
        top = self.stack[-1]
        if len(self.page.tags) > top + 1 and self.page.tags[-1] == TEXT and self.page.parents[-1] == top and self.page.blocks[-1] == self.block:
            self.more.setdefault(len(self.page.texts) - 1, []).append(text)
        else:
            self._add(TEXT, (0, 0), text)


def read(html: str | None) -> Page:
    return _Reader(html or "").read()


def silent(page: Page) -> np.ndarray:
    """Nodes in subtrees that never show text."""
    out = np.zeros(len(page.tags), bool)
    for i, tag in enumerate(page.tags):
        if tag in SILENT:
            out[i : page.ends[i]] = True
    return out


def joined(page: Page, kept: np.ndarray) -> str:
    """The kept runs of text, white space as one blank, blocks apart by an empty line."""
    out: dict[int, list[str]] = {}
    for i in np.flatnonzero(kept).tolist():
        if page.tags[i] == TEXT:
            out.setdefault(page.blocks[i], []).append(page.texts[i])
    said = (SPACE.sub(" ", "".join(parts)).strip() for parts in out.values())
    return "\n\n".join(s for s in said if s)
