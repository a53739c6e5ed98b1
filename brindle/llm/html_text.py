"""Main text of web pages from parser events, text-to-tag ratios and clustering.

The standard library's parser streams events; block elements cut the page into lines. Every
line has a ratio of text characters to tags; text of links, menus, forms, notices and the like
counts for nothing. The ratios are smoothed by a Gaussian over neighbouring lines and split
into two clusters; the lines of the upper one are content. The region is the element that
holds nearly all of that content (or the article around it), and all of its lines are kept but
those of excluded elements, so that short paragraphs beside long ones stay.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.batches import each_batch, record_batch, strings

# Element names by role, and words of class and id attributes that mark what is not article text.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
EXCLUDED = frozenset("aside button datalist dialog fieldset footer form head header iframe menu nav noscript object "
                     "script select style svg template textarea title".split())
MARKS = frozenset("ad ads adbox advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment "
                  "commentlist comments consent cookie cookies copyright disclaimer discussion disqus footer gdpr "
                  "hidden login masthead menu menubar modal nav navbar navigation newsletter notice notices notification "
                  "pager pagination paywall popup promo promoted promotion recommended related replies reply respond "
                  "share sharing sidebar signup skip skyscraper social sponsor sponsored subscribe subscription "
                  "toolbar topbar widget widgets".split())
PAGE_MARKS = frozenset("header head".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
REGIONS = frozenset("article main".split())
REGION_MARKS = frozenset("article articlebody content entry main post story".split())
_CLOSES_P = frozenset("address article aside blockquote details dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 "
                      "h6 header hr li main menu nav ol p pre section table td th tr ul".split())
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
#: Deviation of the Gaussian in lines, and the share of content that a region must hold.
SIGMA, SHARE = 1.0, 0.9


class _Lines(HTMLParser):
    """Cuts a page into lines: (text, characters that count, tags, excluded, innermost element).

    Elements are numbered as they open and know the one around them, so nesting of any depth costs no more than
    the page's length.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool, bool]] = []  # name, element number, excluded, in a region
        self.elements: list[tuple[str, bool, int]] = [("", False, 0)]  # name, may be a region, element around
        self.open: Counter[str] = Counter()
        self.lines: list[tuple[str, int, int, bool, int]] = []
        self.text: list[str] = []
        self.counted = self.tags = self.links = 0

    def _inner(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def _excluded(self) -> bool:
        return bool(self.stack) and self.stack[-1][2]

    def cut(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append((text, self.counted, self.tags, self._excluded(), self._inner()))
            self.tags = 0
        self.text, self.counted = [], 0

    def _close(self, at: int) -> None:
        for name, *_ in self.stack[at:]:
            self.links -= name == "a"
            self.open[name] -= 1
        del self.stack[at:]

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append(" ")
            self.tags += 1
            return
        if tag not in INLINE:
            self.cut()
        self.tags += 1
        if tag in VOID:
            return
        if tag in _CLOSES_P and (self.open["p"] or tag == "li" and self.open["li"]):
            for at in range(len(self.stack) - 1, -1, -1):
                name = self.stack[at][0]
                if name == "p" or name == tag == "li":
                    self._close(at)
                    break
                if name not in INLINE:
                    break
        given = dict(attrs) if attrs else {}
        words = set(_WORDS.findall(f"{given.get('class') or ''} {given.get('id') or ''} "
                                   f"{given.get('itemprop') or ''}".lower())) if given else ()
        within = bool(self.stack) and self.stack[-1][3]
        region = tag in REGIONS or given.get("role") == "main" or bool(words and words & REGION_MARKS)
        out = self._excluded() or self._left_out(tag, given, words, within)
        self.elements.append((tag, region and not out, self._inner()))
        self.open[tag] += 1
        self.stack.append((tag, len(self.elements) - 1, out, within or region and not out))
        self.links += tag == "a"

    @staticmethod
    def _left_out(tag, given, words, within) -> bool:
        if tag in EXCLUDED and not (tag == "header" and within) or tag in ("body", "html"):
            return tag in EXCLUDED
        if tag in REGIONS and not (words and words & MARKS):
            return False
        return bool(given) and (
            bool(words & MARKS) or bool(words & PAGE_MARKS) and not within and tag not in INLINE
            or given.get("role") in ROLES or "hidden" in given or given.get("aria-hidden") == "true"
            or "display:none" in (given.get("style") or "").replace(" ", "").lower())

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self._excluded():  # elsewhere the slash does not close an element
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            return
        for at in range(len(self.stack) - 1 if self.open[tag] else -1, -1, -1):
            if self.stack[at][0] == tag:
                if tag not in INLINE or any(e[2] for e in self.stack[at:]) != self._excluded_at(at - 1):
                    self.cut()
                self._close(at)
                return
            if tag in INLINE and self.stack[at][0] not in INLINE:
                return  # an inline end tag does not close a block

    def _excluded_at(self, at: int) -> bool:
        return at >= 0 and self.stack[at][2]

    def handle_data(self, data):
        if self.text and self.stack and self.stack[-1][2] and not self._held:
            self.cut()
        self._held = self._excluded()
        self.text.append(data)
        if not (self._held or self.links):
            self.counted += len(data.strip())

    _held = False


def _threshold(values: list[float]) -> float:
    """The border between two clusters of numbers; everything is content if they are alike."""
    low, high = min(values), max(values)
    if high - low < 1e-9:
        return low
    while True:
        border = (low + high) / 2
        below = [v for v in values if v < border]
        above = [v for v in values if v >= border]
        new = sum(below) / len(below), sum(above) / len(above)
        if abs(new[0] - low) + abs(new[1] - high) < 1e-9:
            return border
        low, high = new


def extract(html: str) -> str:
    """The main text: its blocks in page order, white space as single spaces."""
    page = _Lines()
    page.feed(html)
    page.close()
    page.cut()
    lines = page.lines
    if not lines:
        return ""
    ratios = [0.0 if out else math.log1p(counted / max(1, tags)) for _, counted, tags, out, _ in lines]
    reach = int(3 * SIGMA)
    weights = [math.exp(-0.5 * (k / SIGMA) ** 2) for k in range(-reach, reach + 1)]
    smooth = []
    for i in range(len(ratios)):
        near = range(max(0, i - reach), min(len(ratios), i + reach + 1))
        total = sum(weights[k - i + reach] for k in near)
        smooth.append(sum(ratios[k] * weights[k - i + reach] for k in near) / total)
    border = _threshold(smooth)
    elements = page.elements
    held, content = [0] * len(elements), 0
    for (_, counted, _, out, inner), value in zip(lines, smooth):
        if value >= border and not out:
            content += counted
            held[inner] += counted
    if not content:
        return ""
    end = list(range(1, len(elements) + 1))  # one beyond the last element inside
    for element in range(len(elements) - 1, 0, -1):
        around = elements[element][2]
        held[around] += held[element]
        end[around] = max(end[around], end[element])
    # Outer elements have smaller numbers; 0 is the whole page.
    region = max((e for e in range(1, len(elements)) if held[e] >= SHARE * content), default=0)
    marked, element = [], region
    while element:
        if elements[element][1]:
            marked.append(element)
        element = elements[element][2]
    if marked:
        region = next((e for e in marked if elements[e][0] == "article"), marked[0])
    return " ".join(text for text, _, _, out, inner in lines if not out and region <= inner < end[region])


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """page_id, the columns of ``keep``, text and n_chars (code points) of every page.

    A null or empty page, and a page without article text, gives an empty text. Repeated rows
    give repeated results; null ids stay null; pages are taken whole, nested to any depth; an empty table gives no
    rows; other columns are ignored.
    """
    chosen = pages.select(F.col(id_col).alias("page_id"), *keep, F.col(html_col).alias("_html"))
    ddl = ", ".join(f"`{n}` {t}" for n, t in chosen.dtypes[:-1]) + ", text string, n_chars long"

    def work(batch):
        texts = [extract(h) for h in strings(batch, "_html")]
        own = [batch.column(i) for i in range(batch.num_columns - 1)]
        schema = pa.schema([*(batch.schema.field(i) for i in range(batch.num_columns - 1)),
                            ("text", pa.string()), ("n_chars", pa.int64())])
        return record_batch(schema, *own, texts, [len(t) for t in texts])

    return each_batch(chosen, ddl, work)
