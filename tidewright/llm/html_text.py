"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams events; text gathers into lines, one per block
element. Each line has its text-to-tag ratio (characters outside links over tags seen).
Lines in parts that a page marks as no article (menus, forms, adverts, comments, ...) have
ratio 0. The ratios are smoothed by a Gaussian, and a threshold that splits them into
two clusters picks the lines of running text, with those at least half as long as its
median that are no links. The region of content is the articles that hold
running text, if they have half of it or more, or else the innermost container of all of it;
all its lines that aren't marked belong to the text, so a short paragraph between long ones
stays. Marks are whole tokens of class, id and role; headings bear none, and words that also
name parts of a text (discussion, search, related, ...) count outside articles only.

White space inside a line is one space, lines are joined by one \\n, character references
are decoded. A null or empty page has an empty text; repeated rows are handled alike; an
empty table gives no rows. Broken markup never fails: unclosed elements end with the page.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewright.llm.common import per_batch

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split())
CONTAINERS = frozenset("html body article aside div dialog footer form header main nav section table td".split())
NEVER = frozenset("head title script style noscript template nav header footer aside form button select option textarea input label menu dialog iframe object svg canvas audio video map search datalist".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: Whole tokens of class, id or role (a number or a common ending may follow) of parts that are no article.
MARKED = re.compile(
    r"(?:ad|ads|adv|advert|adverts|advertisement|advertisements|advertising|adsense|banner|sponsor|sponsored|promo|promotion|comment|comments|disqus|respond|replies|sidebar|aside|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|"
    r"masthead|topbar|footer|bottombar|cookie|cookies|consent|gdpr|notification|notifications|popup|newsletter|subscribe|subscription|signup|login|"
    r"share|sharing|social|toolbar|pagination|pager|copyright|complementary|contentinfo)"
    r"(?:[_-]?(?:\d+|box|bar|banner|notice|list|links?|buttons?|area|block|section|container|wrapper|menu|form|widget|slot|unit|top|bottom|left|right))*", re.I)
#: Tokens that mark a part outside articles only: within one they name parts of the text.
MARKED_OUTSIDE = re.compile(
    r"(?:(?:site|page|main|global|top)[_-])?(?:header|foot|nav|navigation|menu|search)|side|reader|reader-comments|discussion|responses|reply|related|related-(?:posts|articles|links|stories)|recommended|recommendations|"
    r"search-(?:box|form|bar)|tags?|tag-list|widgets?|widget-area|modal|overlay|alert|form|notice|notices", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Open elements that a start tag ends, and those beyond which it doesn't look.
IMPLIED_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}
SIGMA, REACH = 1.0, 3
KERNEL = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)


class Lines(HTMLParser):
    """Lines of a page: text outside marked parts, tags, link characters, marked (nothing else), the path of containers."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int]] = []  # tag, marked from here down, container
        self.lines: list[tuple[str, int, int, bool, tuple[int, ...]]] = []
        self.parts: list[str] = []
        self.tags = self.link_chars = self.links = self.containers = 0
        self.dropped = False  # the line had text in a marked part
        self.articles: set[int] = set()

    def updatepos(self, i: int, j: int) -> int:  # nobody asks for line numbers
        return j

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split()) if self.parts else ""
        if text or self.dropped:
            path = tuple(c for _, _, c in self.open if c)
            self.lines.append((text, self.tags, self.link_chars, not text, path))
        self.parts, self.tags, self.link_chars, self.dropped = [], 0, 0, False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            if tag == "hr":
                self._end_line()
            elif tag == "br":
                self.parts.append(" ")
            self.tags += 1
            return
        if tag in BLOCKS:
            self._end_line()
            self._close_implied(tag)
        self.tags += 1
        self.links += tag == "a"
        marked = bool(self.open) and self.open[-1][1]  # an article inside a list of comments stays marked
        if not marked and tag not in ("html", "body", "article", "main"):
            marked = tag in NEVER and not (tag == "header" and self.in_article()) or any(k in ("hidden",) or k == "aria-hidden" and v == "true" for k, v in attrs)
            if not marked and tag not in HEADINGS:
                tokens = [t for k, v in attrs if v and k in ("class", "id", "role") for t in v.split()]
                marked = any(MARKED.fullmatch(t) for t in tokens) or any(MARKED_OUTSIDE.fullmatch(t) for t in tokens) and not self.in_article()
        container = 0
        if tag in CONTAINERS:
            self.containers += 1
            container = self.containers
            if tag in ("article", "main") and not marked:
                self.articles.add(container)
        self.open.append((tag, marked, container))

    def in_article(self) -> bool:
        return any(c in self.articles for _, _, c in self.open)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _pop_to(self, at: int) -> None:
        self._end_line()
        self.links -= sum(t == "a" for t, _, _ in self.open[at:])
        del self.open[at:]

    def _close_implied(self, tag: str) -> None:
        """A block start ends an open p; li, dt, dd, tr, td, th and option end their kind."""
        ends, stops = IMPLIED_ENDS.get(tag, ((), ()))
        if not ends and tag not in CLOSES_P:
            return
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name == "p" and tag in CLOSES_P or name in ends:
                self._pop_to(at)
                return
            if name in CONTAINERS or name in stops:
                return

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in VOID:
            return
        block = tag in BLOCKS
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name == tag:
                if block:
                    self._pop_to(at)
                else:
                    self.links -= sum(t == "a" for t, _, _ in self.open[at:])
                    del self.open[at:]
                return
            if not block and name in BLOCKS:  # an inline end tag doesn't end blocks
                return

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][1]:
            self.dropped |= self.open[-1][0] not in ("script", "style") and not data.isspace()
            return
        self.parts.append(data)
        if self.links:
            self.link_chars += len(data)

    def finished(self) -> list[tuple[str, int, int, bool, tuple[int, ...]]]:
        self.close()
        self._end_line()
        return self.lines


def smoothed(ratios: np.ndarray) -> np.ndarray:
    return np.convolve(ratios, KERNEL)[REACH:-REACH] / np.convolve(np.ones(len(ratios)), KERNEL)[REACH:-REACH]


def split_point(values: np.ndarray) -> float:
    """Threshold between two clusters of numbers: midway between their means, iterated."""
    cut = float(values.mean())
    for _ in range(50):
        low, high = values[values <= cut], values[values > cut]
        if not len(low) or not len(high):
            break
        new = (float(low.mean()) + float(high.mean())) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def main_text(html: str | None) -> str:
    """The text of the article of one page."""
    if not html:
        return ""
    parser = Lines()
    if html.rfind("<!--") > html.rfind("-->"):
        html += "-->"  # a comment that never ends lasts to the end of the page
    parser.feed(html)
    lines = parser.finished()
    usable = [i for i, line in enumerate(lines) if not line[3]]
    if not usable:
        return ""
    ratios = np.array([0.0 if marked else max(0, len(text) - links) / max(1, tags) for text, tags, links, marked, _ in lines])
    soft = smoothed(ratios)
    cut = split_point(soft)
    content = [i for i in usable if soft[i] > cut] or usable
    if len(content) < len(usable) and not any(soft[i] <= cut and ratios[i] == 0 for i in range(len(lines))) and soft.max() < 2 * max(soft.min(), 1e-9):
        content = usable  # one cluster only
    # A paragraph beside other tags may fall below the cut: lines like the cluster's by their own text are of it too.
    usual = float(np.median([len(lines[i][0]) for i in content]))
    content = [i for i in usable if soft[i] > cut or 2 * len(lines[i][0]) >= usual and 2 * lines[i][2] <= len(lines[i][0])] if len(content) < len(usable) else content
    # Articles that hold running text, where the page has them; else the innermost container of all of it.
    named = {c for i in content for c in lines[i][4] if c in parser.articles}
    outer = {next(c for c in lines[i][4] if c in named) for i in content if named.intersection(lines[i][4])}
    inside = sum(len(lines[i][0]) for i in content if outer.intersection(lines[i][4]))
    if 2 * inside >= sum(len(lines[i][0]) for i in content):
        held = outer
    else:
        held = set(lines[content[0]][4]).intersection(*[lines[i][4] for i in content])
        held = {max(held)} if held else set()
    if held:
        content = [i for i in usable if held.intersection(lines[i][4])]
    elif parser.containers:
        content = usable
    return "\n".join(lines[i][0] for i in content)


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    keys = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h.as_py()) for h in batch.column("html")]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(per_batch(work), f"page_id {keys[0]}, url {keys[1]}, text string, n_chars long")
