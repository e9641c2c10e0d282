"""Main text of web pages: parser events, text-to-tag ratios, smoothing and clustering."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Elements whose text is never shown as prose.
SILENT = {"script", "style", "noscript", "template", "svg", "math", "head", "title", "object", "iframe", "canvas", "select", "option", "textarea", "button", "input", "form", "label", "dialog"}
#: Elements that hold site furniture.
FURNITURE = {"nav", "footer", "aside", "menu"}
#: Elements that begin and end a line.
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Words of class, id and role values that mark furniture.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|banner|foot|footer|sidebar|side|aside|widget|related|recommended|promo|promoted|sponsor(?:ed)?|ads?|advert(?:s|isement|ising)?|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|comments?|commentlist|respond|replies|reply|disqus|pagination|pager|toolbar|skip|copyright|legal|tags|contentinfo|complementary|dialog|form)(?:$|[\s_-])",
    re.I,
)
HEADING = re.compile(r"(?:^|(?<=[\s_-]))(?:header|masthead|banner)(?=$|[\s_-])", re.I)
REPLIES = re.compile(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies)|related|promo|ads?|teaser)(?:$|[\s_-])", re.I)
MAIN = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that may hold a whole text.
CONTAINERS = {"html", "body", "div", "section", "center", "table", "tbody", "tr", "td", "details", "blockquote", *MAIN}
#: An open p ends when one of these begins.
ENDS_P = BLOCKS - {"br"}
#: A line within article or main counts as so many times as dense.
PRIOR = 4.0
#: Shares of the dense text that make a container the one of the text: any element, and those that pages name.
HOLDS, NAMED = 0.9, 0.5


class _Lines(HTMLParser):
    """Turns parser events into lines and a tree of the elements that hold them.

    Work is in proportion to the page: open tags are counted, so an end tag that
    nothing opened costs nothing. Unfinished and unknown markup is skipped to its next ``>``, or to
    the end of the page where there is none; an unclosed comment runs to the end.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = []  # tag, node, silent
        self.open: Counter = Counter()
        self.parent, self.container, self.whole, self.furniture, self.marked, self.main = [0], [True], [True], [False], [False], [-1]
        self.lines: list[tuple[str, int, int, bool]] = []  # text, tags, node, whether it's of links alone
        self.heading: list[bool] = []
        self.text: list[str] = []
        self.tags = self.link = self.chars = 0

    def _skip(self, i: int) -> int:
        return self.rawdata.find(">", i) + 1 or len(self.rawdata)

    def parse_html_declaration(self, i: int) -> int:
        return self._skip(i)  # also <![ ... ]> of any kind

    def parse_comment(self, i: int, report: bool = True) -> int:
        end = self.rawdata.find("-->", i + 2)
        return end + 3 if end >= 0 else len(self.rawdata)

    def parse_pi(self, i: int) -> int:
        return self._skip(i)

    def parse_starttag(self, i: int) -> int:
        k = super().parse_starttag(i)
        return k if k >= 0 else self._skip(i)

    def parse_endtag(self, i: int) -> int:
        k = super().parse_endtag(i)
        return k if k >= 0 else self._skip(i)

    def top(self) -> tuple[str, int, bool]:
        return self.stack[-1] if self.stack else ("", 0, False)

    def flush(self) -> None:
        t = " ".join("".join(self.text).split())
        if t:
            self.heading.append(any(self.open[h] for h in HEADINGS))
            self.lines.append((t, self.tags, self.top()[1], self.link >= 0.75 * self.chars and not self.heading[-1]))
        self.text, self.tags, self.link, self.chars = [], 0, 0, 0

    def pop(self) -> None:
        tag, node, _ = self.stack.pop()
        if node != self.top()[1] and self.text:  # what follows lies in another element
            self.stack.append((tag, node, False))
            self.flush()
            self.stack.pop()
        self.open[tag] -= 1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
            if tag in ENDS_P and self.open["p"]:
                self.close_p()
        self.tags += 1
        if tag in VOID:
            return
        if tag in ("li", "td", "th", "tr", "dt", "dd", "option") and self.top()[0] == tag:
            self.pop()
        _, above, silent = self.top()
        a = dict(attrs)
        words = " ".join(v for k in ("class", "id", "role", "aria-label") if (v := a.get(k)))
        hidden = "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in (a.get("style") or "").replace(" ", "").lower()
        within = self.main[above] >= 0 or tag in MAIN
        # A page may head its article in a header element within it; outside it's the site's.
        if within:
            words = HEADING.sub(" ", words)
        furniture = tag in FURNITURE or (tag == "header" and not within) or (tag in MAIN and bool(REPLIES.search(words)))
        marked = tag not in ("html", "body", *MAIN) and bool(MARKS.search(words))
        node = above
        if tag in BLOCKS or furniture or marked:
            if tag not in BLOCKS:
                self.flush()
            node = len(self.parent)
            self.parent.append(above)
            self.container.append(tag in CONTAINERS)
            self.whole.append(tag in ("html", "body"))
            self.furniture.append(self.furniture[above] or furniture)
            self.marked.append(marked)
            self.main.append(self.main[above] if self.main[above] >= 0 else node if tag in MAIN else -1)
        self.stack.append((tag, node, silent or hidden or tag in SILENT))
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        if self.open[tag]:
            while self.top()[0] != tag:
                self.pop()
            self.pop()

    def close_p(self) -> None:
        """End an open paragraph, with inline elements left open in it."""
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == "p":
                while len(self.stack) > k:
                    self.pop()
                return
            if self.stack[k][0] in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        if self.top()[2]:
            return
        self.text.append(data)
        n = sum(map(len, data.split()))
        self.chars += n
        if self.open["a"]:
            self.link += n


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    r = int(np.ceil(2 * sigma))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), k, "same")[: len(ratios)] if len(ratios) >= len(k) else np.array([k[max(0, r - i) : r + len(ratios) - i].sum() for i in range(len(ratios))])
    full = np.convolve(ratios, k)[r : r + len(ratios)]
    return full / weight


def threshold(values: np.ndarray) -> float:
    """The cut between two clusters of values, by two means in one dimension."""
    low, high = values.min(), values.max()
    if high <= low:
        return low
    for _ in range(30):
        cut = (low + high) / 2
        a, b = values[values < cut], values[values >= cut]
        new = (a.mean() if len(a) else low, b.mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def sums_below(parent: np.ndarray, node: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """What the lines of each element and of all within it weigh together."""
    out = np.bincount(node, weight, len(parent)).tolist()
    for k in range(len(parent) - 1, 0, -1):  # an element comes after the one that holds it
        out[parent[k]] += out[k]
    return np.array(out)


def content_lines(p: _Lines, sigma: float = 1.0) -> np.ndarray:
    """Places of the lines that make up the text.

    1. Furniture goes: elements for it, and those whose class says so, unless such an
       element holds most of the page's prose and nothing named article or main is outside it.
    2. Each line has a text-to-tag ratio: none for furniture and lists of links, several times as much where the
       page says article or main. The ratios are smoothed and parted in two clusters; the lines of the upper one are the dense text.
    3. The dense text marks the region: the articles that hold it, if they hold half of it; else the
       innermost element with nine tenths of it; where that is the whole page, from the first dense line (and
       headings right before) to the last.
    4. Within the region short lines between stay, as they are headings and short paragraphs; links only between prose.
    """
    size = np.array([len(t) for t, *_ in p.lines])
    tags, node, link = (np.array([x[k] for x in p.lines]) for k in (1, 2, 3))
    parent, main = np.array(p.parent), np.array(p.main)
    prose = size * ~(np.array(p.furniture)[node] | link)
    mass = sums_below(parent, node, prose)
    named = sums_below(parent, node, prose * (main[node] >= 0))
    furniture = list(p.furniture)
    for k in range(1, len(furniture)):
        most = mass[k] * 2 > mass[0] and named[k] == named[0]
        furniture[k] = furniture[k] or furniture[parent[k]] or (p.marked[k] and not most)
    usable = ~np.array(furniture)[node]
    within = main[node] >= 0
    ratio = np.where(usable & ~link, size / np.maximum(1, tags) * np.where(within, PRIOR, 1.0), 0.0)
    if not ratio.any():
        return np.flatnonzero(usable & within & ~link)
    flat = smooth(ratio, sigma)
    dense = (ratio > 0) & (flat >= threshold(flat))
    if not dense.any():
        dense = ratio == ratio.max()
    weight = size * dense
    by_main = np.bincount(main[node] + 1, weight, len(parent) + 1)
    if by_main[1:].sum() >= NAMED * weight.sum():
        region = (by_main[main[node] + 1] > 0) & within
    else:
        held, at = sums_below(parent, node, weight), 0
        for k in range(1, len(parent)):  # the way down: no two siblings hold so much
            if parent[k] == at and p.container[k] and held[k] >= HOLDS * held[0]:
                at = k
        below = np.zeros(len(parent), bool)
        below[at] = True
        for k in range(at + 1, len(parent)):
            below[k] = below[parent[k]]
        region = below[node]
        if p.whole[at]:
            on = np.flatnonzero(dense & region)
            first = on[0]
            while first and p.heading[first - 1] and usable[first - 1]:
                first -= 1
            region = region & (np.arange(len(size)) >= first) & (np.arange(len(size)) <= on[-1])
    some = np.flatnonzero(usable & region)
    single = np.r_[True, ~link[some][:-1]] & np.r_[~link[some][1:], True] & (flat[some] >= threshold(flat))
    return some[~link[some] | single]


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """The text of a page's content regions: blocks in page order, joined by one space."""
    p = _Lines()
    p.feed(html or "")
    p.close()
    p.flush()
    return " ".join(p.lines[k][0] for k in content_lines(p, sigma)) if p.lines else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null html is empty and gives an empty text; markup that can't be read is skipped and
    what follows it is read, in time in proportion to the page; repeated rows stay; an empty table gives an empty one. Nothing is
    shuffled: each page is read in the task that scans it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
