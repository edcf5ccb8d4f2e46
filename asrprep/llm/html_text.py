"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines: a block element begins a line, inline elements do not. Each line gets
a weight: its text length, or nothing where markup says it is no content (menus, headers, footers,
side bars, notices, adverts, forms, comments; lines that are mostly links). A noise word in passing (``has-sidebar``,
``related-work``) only lowers the weight, and on pages without an ``article`` or ``main`` element so do names that also name layouts or
subjects (``sidebar``, ``related``), which inside such an element are no content if it holds any other text; so does a place outside of the element. Weights are summed over sliding windows of ``WINDOW`` lines. Text starts where that sum surges, ends where it
dives to nothing or where the kind of line (plain, outside the article, loosely named) changes.

A run of windows is text if it reaches ``SURGE`` characters; runs of lowered weight must also reach half of the
densest plain window. Shorter runs are text too if they lie in the same container as a dense one (so after an
advert the closing sentence stays) or in the page's article, which is one container: there all plain lines
are text. If no run is text, the heaviest is.

Time is linear in the page, also for unclosed tags and quotes.

Defined cases: null html counts as empty and gives an empty text; pages without text give an empty
text; unclosed and misplaced tags are closed by what encloses them; repeated rows are extracted
alike; pages of any length are read whole, each by one task; an empty table gives an empty table; other columns are carried through unless their names clash with ``text`` and ``n_chars``.
"""

from __future__ import annotations

import bisect
import collections
import functools
import html
import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 86
MAX_LINK_SHARE = 0.5

# Element names and words of class, id and role attributes.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
             "small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math")
DROPPED = set("head nav footer aside form button select object dialog menu canvas audio video".split())
NOISE = set("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu nav navbar "
            "navigation breadcrumb breadcrumbs footer comment comments disqus reply replies respond cookie cookies consent gdpr "
            "notice notices notification alert popup modal overlay newsletter subscribe subscription signup share sharing social "
            "related recommended recommendations widget login search copyright skip pagination pager tags toolbar contentinfo "
            "complementary dialog".split())
# names that leave little doubt; the other words of NOISE also name layouts and subjects, so density can override them
FIRM = set("ad ads advert adverts advertisement advertising adsense sponsor sponsored navigation breadcrumb breadcrumbs footer comment "
           "comments disqus reply replies respond cookie cookies consent gdpr newsletter subscribe subscription signup copyright "
           "pagination pager contentinfo complementary dialog login header masthead topbar".split())
HEAD_NOISE = {"header", "masthead", "topbar", "side", "banner"}
STATE = set("has have with without no not is show hide enable enabled disable disabled tag category type format status".split())
CONTENT = set("entry post article story content body text".split())
GENERIC = set("wrapper wrap container inner outer list area section box block item items link links bar panel posts articles button "
              "buttons icon icons text content body group unit slot row col column title form info top bottom left right main this "
              "holder area zone frame thread x px".split())
WEIGHTS = (1.0, 0.5, 0.25, 0.0)  # no name, a name in passing, a loose name, a firm name
IN_ARTICLE = 4  # a loose name inside the article: firm if the article holds other text, else loose
OUTSIDE = 0.125  # outside the article
# elements that group or hold lines of the container they lie in
PASSING = INLINE | set("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th blockquote figure figcaption pre "
                       "center picture".split())
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_NAME_END, _QUOTE_OR_END = re.compile(r"[\s/>]"), re.compile(r"[>\"']")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PART = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


@functools.lru_cache(1 << 14)
def _named(token: str, inside: bool) -> int:
    """0 to 3, the index in WEIGHTS: how much a class, id or role says that an element is no content.

    The whole token or its last part (before words for boxes) counts; a noise word elsewhere (has-sidebar,
    related-work) only lowers the weight.
    """
    parts = _PART.findall(_CAMEL.sub(r"\1 \2", token).lower())
    words = NOISE if inside else NOISE | HEAD_NOISE
    if not words.intersection(parts):
        return 0
    if STATE.intersection(parts[:-1]):
        return 1
    head = list(parts)
    while len(head) > 1 and head[-1] in GENERIC:
        head.pop()
    if head[-1] in words:
        if head[-1] in HEAD_NOISE and CONTENT.intersection(head):
            return 1
        return 3 if FIRM.intersection(head) else 2
    return 2 if parts[0] in FIRM else 1


def _noise(name: str, attrs: str, inside: bool, first: bool) -> int:
    if name in DROPPED or (name == "header" and not inside):
        return 3
    if not attrs or name in ("main", "body", "html") or (name == "article" and first):
        return 0  # a page's or its article's own classes name its features, not its content
    level = 0
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return 3
        if key == "style":
            if "display:none" in value.replace(" ", "").lower():
                return 3
        elif key in ("class", "id", "role"):
            level = max([level, *[_named(t, inside) for t in value.split()]])
    return level


class Line(NamedTuple):
    text: str
    linked: int  # characters in links
    name: int  # index in WEIGHTS
    inside: bool  # in the article
    homes: tuple[int, int]  # its container; the container around that if it is a div used as a paragraph


class _Tags:
    """The tags of a page in order, found in time linear in the page whatever its quotes and brackets: what a failed look
    ahead has seen is remembered."""

    def __init__(self, page: str):
        self.page, self.size = page, len(page)
        self.seen = {kind: (0, -1) for kind in (_NAME_END, _QUOTE_OR_END, ">")}  # searched from, found at
        self.dead: set[int] = set()  # places of quotes that, opened there, leave the tag without an end
        self.unclosed = {'"': self.size, "'": self.size}  # from here on no quote of the kind is closed

    def _find(self, kind, at: int) -> int:
        """``kind`` at or after ``at``, else the page's size; for places that mostly ascend."""
        since, found = self.seen[kind]
        if not since <= at <= found:
            if kind == ">":
                found = self.page.find(kind, at)
            else:
                m = kind.search(self.page, at)
                found = m.start() if m else -1
            found = self.size if found < 0 else found
            self.seen[kind] = at, found
        return found

    def _end(self, at: int) -> int:
        """Behind the first ``>`` outside of quotes, or -1."""
        page, opened, p = self.page, [], self._find(_QUOTE_OR_END, at)
        while p < self.size:
            if page[p] == ">":
                return p + 1
            opened.append(p)
            close = -1 if p in self.dead or p >= self.unclosed[page[p]] else page.find(page[p], p + 1)
            if close < 0:
                if p not in self.dead:
                    self.unclosed[page[p]] = min(p, self.unclosed[page[p]])
                break
            m = _QUOTE_OR_END.search(page, close + 1)
            p = m.start() if m else self.size
        self.dead.update(opened)
        return -1

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(begin, end, whether an end tag, name, attributes) from ``at`` on; no name for comments and declarations."""
        page = self.page
        while (s := page.find("<", at)) >= 0:
            at = s + 1
            if page.startswith("<!--", s):
                end = page.find("-->", s + 4)
                return s, end + 3 if end >= 0 else self.size, False, "", ""
            if page[at:at + 1] in ("!", "?"):
                end = self._find(">", at + 1)
                if end < self.size:
                    return s, end + 1, False, "", ""
                continue
            closing = page.startswith("/", at)
            first = page[at + closing:at + closing + 1]
            if not (first.isascii() and first.isalpha()):
                continue
            stop = self._find(_NAME_END, at + closing)
            if stop == self.size:
                continue
            end = self._end(stop)
            if end >= 0:
                return s, end, closing, page[at + closing:stop].lower(), page[stop:end - 1]
            if not closing and stop - at < 10 and page[at:stop].lower() in RAW and (end := self._find(">", stop)) < self.size:
                return s, end + 1, False, page[at:stop].lower(), ""  # an odd number of quotes
        return None


class _Closings:
    """How many more closing than opening tags of a name follow a place of the page; found in one pass."""

    def __init__(self, page: str):
        self.page, self.of = page, None

    def after(self, name: str, at: int) -> int:
        if self.of is None:
            tags: dict = {}
            for m in re.finditer(r"<(/?)([a-zA-Z][^\s/>]*+)", self.page):
                tags.setdefault(m.group(2).lower(), []).append((m.start(), 1 if m.group(1) else -1))
            self.of = {n: ([i for i, _ in x], list(itertools.accumulate((v for _, v in reversed(x)), initial=0))[::-1])
                       for n, x in tags.items()}
        starts, more = self.of.get(name, ([], [0]))
        return more[bisect.bisect_left(starts, at)]


def lines_of(page: str) -> tuple[list[Line], bool]:
    """The lines, and whether there is an article."""
    lines: list[Line] = []
    buffer: list[str] = []
    stack: list[tuple[str, int, int]] = []  # name, index in WEIGHTS, container
    around = [0]  # the container around each
    named = [0, 0, 0, 0, 0]  # open elements of each index in WEIGHTS, and loose ones inside the article
    blocks: list[str] = []  # the open ones that are no inline elements
    opened, noisy = collections.Counter(), collections.Counter()  # open elements by name; those with an index over 1
    linked = inside = 0
    in_link, marked, first = 0, False, True  # first: no article that is content so far

    def end_line():
        nonlocal linked
        if buffer:
            text = _SPACE.sub(" ", "".join(buffer)).strip()
            if text:
                home, at_block = (stack[-1][2] if stack else 0), blocks[-1] if blocks else ""
                lines.append(Line(text, linked, next((k for k in (3, IN_ARTICLE, 2, 1) if named[k]), 0), inside > 0,
                                  (home, around[home] if at_block == "div" else home)))
            buffer.clear()
        linked = 0

    def pop():
        nonlocal inside, in_link
        name, bad, _ = stack.pop()
        named[bad] -= 1
        opened[name] -= 1
        noisy[name] -= bad > 1
        if name not in INLINE:
            blocks.pop()
        inside -= name in ("article", "main")
        in_link -= name == "a"

    def text(raw: str):
        nonlocal linked
        if raw:
            t = html.unescape(raw) if "&" in raw else raw
            buffer.append(t)
            if in_link:
                linked += len(t.strip())

    at, endless, closings, tags = 0, set(), _Closings(page), _Tags(page)
    last_article = page.lower().rfind("<article")
    while m := tags.next(at):
        begin, end, closing, name, attrs = m
        text(page[at:begin])
        at = end
        if not name:
            continue
        if name in _RAW_END:
            if not closing and not (name in ("svg", "math") and attrs.endswith("/")):
                end = None if name in endless else _RAW_END[name].search(page, at)
                close = page.find(">", end.end()) if end else -1
                if close >= 0:
                    at = close + 1
                elif name in ("script", "style"):
                    at = len(page)
                else:  # never closed: only the tag goes
                    endless.add(name)
            continue
        block = name not in INLINE
        if block:
            end_line()
        elif name == "br":
            buffer.append(" ")
        if closing:  # it closes what the element encloses
            if opened[name] > 0:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in VOID:
            continue
        if block:
            while stack and stack[-1][0] in INLINE:  # unclosed inline elements end with their block
                pop()
            if stack and stack[-1][0] == "p":
                pop()
            if name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
                pop()
            if name in ("article", "main") and first and any(named[2:]):
                # an unclosed menu or advert doesn't hold the article, nor does a form around the page
                if all(n == "form" or closings.after(n, at) < opened[n] for n, k in noisy.items() if k > 0):
                    while stack and any(named[2:]) and stack[-1][0] not in ("article", "main", "body"):
                        pop()
            elif name == "body":
                while stack:
                    pop()
        if attrs.endswith("/") and name in ("p", "div", "span", "a"):
            continue
        bad = _noise(name, attrs, inside > 0, first)
        if bad == 2 and inside and (opened["article"] > 0 or at > last_article):
            bad = IN_ARTICLE
        if name in ("article", "main") and not bad and not any(named[2:]):
            marked, first = True, first and name == "main"
        home = stack[-1][2] if stack else 0
        if name not in PASSING:
            around.append(home)
            home = len(around) - 1
        stack.append((name, bad, home))
        named[bad] += 1
        opened[name] += 1
        noisy[name] += bad > 1
        if name not in INLINE:
            blocks.append(name)
        inside += name in ("article", "main")
        in_link += name == "a"
    text(page[at:])
    end_line()
    return lines, marked


def main_text(page: str | None) -> str:
    lines, marked = lines_of(page or "")
    other = any(x.inside and x.name < 2 for x in lines)
    lines = [x._replace(name=3 if other else 2) if x.name == IN_ARTICLE else x for x in lines]
    kind = [2 if x.name == 2 else int(marked and not x.inside) for x in lines]
    weight = [0 if not x.inside and x.linked > MAX_LINK_SHARE * len(x.text)
              else WEIGHTS[x.name] * len(x.text) * (OUTSIDE if marked and not x.inside else 1) for x in lines]
    sums = [sum(w for w, q in zip(weight[i:i + WINDOW], kind[i:i + WINDOW]) if q == k) for i, k in enumerate(kind)]
    runs, start = [], None
    for i in range(len(lines) + 1):  # surge to dive
        if start is not None and (i == len(lines) or not sums[i] or kind[i] != kind[start]):
            runs.append((kind[start], max(sums[start:i]), [j for j in range(start, i) if weight[j]]))
            start = None
        if start is None and i < len(lines) and sums[i]:
            start = i
    top = max((peak for k, peak, _ in runs if k == 0), default=0)
    dense = [peak >= (max(SURGE, top / 2) if k else SURGE) for k, peak, _ in runs]
    homes = {(k, h) for (k, _, run), d in zip(runs, dense) if d for j in run for h in lines[j].homes}
    kept = [run for (k, _, run), d in zip(runs, dense)
            if d or (marked and k == 0) or any((k, h) in homes for j in run for h in lines[j].homes)]
    if not any(kept):
        last = [run for k, _, run in runs if k < 2] or [run for _, _, run in runs if any(lines[j].inside for j in run)]
        kept = [max(last, key=lambda run: sum(weight[j] for j in run), default=[])]
    return "\n".join(lines[j].text for run in kept for j in run)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars`` (code points)."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([main_text(p) for p in s], dtype=object)

    rest = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    return pages.select(*rest, run(F.col(html_col)).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
