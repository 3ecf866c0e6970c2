"""Main text of web pages from the events of the standard library's streaming parser.

The parser's events give lines: runs of text between block elements, each with its tag count,
its place among the page's containers, and whether it stands in a part that is no article text
by its element, role, class or id (menu, header, footer, sidebar, notice, advert, form, reader
comments). A class or id only makes an element suspect, and only if it is made of such names and of
words that templates put beside them ("site-header", not "notice-period"): a suspect element that
holds most of the page's text, or all there is, is read as any other. Of the lines left, the ratio of text to tags is smoothed with a Gaussian; lines at
or above the deviation of the smoothed ratios form the content clusters. They select the region:
the articles that hold them, unless the text outside outweighs these, else the smallest set of
containers that holds them all; its lines, short ones included, are the page's text. A headline
beside an article element, not in it, is not taken: it can't be told from the site's own. One Arrow
batch of pages is in memory; no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# HTML's element and role names, and words that page templates give as class or id.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead title tr ul".split())
REGION = frozenset("article body center div main section table tbody td tr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
OUT = frozenset(
    "aside audio button canvas dialog footer form head iframe input menu nav noscript object optgroup option script "
    "search select style svg template textarea title video".split())
OUT_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
OUT_WORDS = frozenset(
    "ad ads adsense advert advertisement adverts alert announcement banner breadcrumb breadcrumbs consent cookie cookies "
    "copyright disclaimer footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "overlay pager pagination popup promo promoted promotion search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe toolbar topbar widget widgets".split())
READERS = frozenset("comment comments discussion disqus recommended related replies reply respond".split())
# Words that stand beside those in names of the same parts.
BESIDE = frozenset(
    "a aria area article articles bar block bottom box btn button buttons center col column container fixed form global group "
    "head holder icon icons in inner item items js label large layout left link links list lists m main menus mobile new news "
    "of outer page panel posts primary region right root row secondary section site small sticky stories sub text the thread "
    "title to top up us wrap wrapper x".split())
NAMES = OUT_WORDS | READERS | BESIDE
#: A suspect element of at least so many code points and such a share of the page's text is the text;
#: where nothing else is, one of at least ALONE code points.
DENSE, SHARE, ALONE = 500, 2 / 3, 200
CLOSED_BY = {  # an open element that the start of another one ends
    "p": BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody"]), "th": frozenset(["td", "th", "tr", "tbody"]),
    "option": frozenset(["option", "optgroup"]),
}
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Lines(HTMLParser):
    """Collects ``lines``: (text, tags, path of region ids, article id, suspect), suspect being 0 or
    the outermost suspect element's id, negative for readers' comments."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple, int, int]] = []
        #: (tag, id, out, readers, path, article, suspect); out: 0 in, 1 by words, 2 for good or by readers' words
        self.open: list[tuple[str, int, int, bool, tuple, int, int]] = [("", 0, 0, False, (0,), 0, 0)]
        self.text: list[tuple[int, str]] = []
        self.tags = self.n = 0

    def flush(self) -> None:
        if self.text:
            _, _, _, _, path, article, _ = self.open[-1]
            for suspect in dict.fromkeys(k for k, _ in self.text):
                text = " ".join("".join(x for k, x in self.text if k == suspect).split())
                if text:
                    self.lines.append((text, self.tags, path, article, suspect))
            self.text = []
        self.tags = 0

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.handle_data(" ")
        if tag in BLOCK:
            self.flush()
            for k in range(len(self.open) - 1, 0, -1):
                if tag in CLOSED_BY.get(self.open[k][0], ()):
                    del self.open[k:]
                    break
                if self.open[k][0] in BLOCK and self.open[k][0] not in ("dl", "h1", "h2", "h3", "h4", "h5", "h6"):
                    break
        else:
            self.tags += 1
        if tag in VOID:
            return
        self.n += 1
        _, _, out, readers, path, article, suspect = self.open[-1]
        mine = self.judge(tag, attrs) if out < 2 or readers else (2, readers)
        hard = mine[0] == 2 and not mine[1] or out == 2 and not readers
        if tag in ("article", "main") and out == 1 and not readers and not mine[0]:
            out = 0  # a wrapper named for what stands beside its article
        out, readers = max(out, mine[0]), readers or mine[1]
        if tag in HEADING and out == 1 and article and not readers and not mine[0]:
            out = 0  # the headline in an article's own header
        if tag in REGION:
            path = (*path, self.n)
        if tag == "article" or tag == "main":
            article = self.n
        if hard:
            out, readers = 2, False  # for good, whatever is around it
        elif not out:
            suspect = 0
        elif not suspect or readers and suspect > 0:
            suspect = -self.n if readers else self.n
        self.open.append((tag, self.n, out, readers, path, article, suspect))

    def judge(self, tag, attrs) -> tuple[int, bool]:
        """Whether the element itself leaves the article's text, and as readers' comments."""
        if tag in OUT:
            return 2, False
        out, readers = int(tag == "header"), False
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return 2, False
            if not value:
                continue
            if name == "role" and value.lower() in OUT_ROLES or name == "style" and _HIDDEN.search(value):
                return 2, False
            if name in ("class", "id") and tag not in ("html", "body", "main"):
                for one in value.split():
                    words = set(_SPLIT.split(_CAMEL.sub("-", one).lower())) - {""}
                    if not words <= NAMES:
                        continue  # a name with words of its own says something else
                    if words & READERS:
                        readers = True
                    if words & OUT_WORDS and tag != "article" and tag not in HEADING:
                        out = 1
        if readers:
            return 2, True
        return out, readers

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # HTML has no self-closing elements besides the void ones

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        else:
            self.tags += 1
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                break
            if tag not in BLOCK and self.open[k][0] in BLOCK or tag == "p" and self.open[k][0] in REGION:
                break  # a stray end tag closes nothing outside its block

    def handle_data(self, data):
        _, _, out, readers, _, _, suspect = self.open[-1]
        if out < 2 or readers:
            self.text.append((suspect, data))


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel)[reach:-reach]
    return np.convolve(ratios, kernel)[reach:-reach] / weights


def content(lines: list[tuple[str, int, tuple, int]], sigma: float = 1.5) -> list[str]:
    """The lines of the region that the clusters of high text-to-tag ratio select."""
    if not lines:
        return []
    size = np.array([len(x[0]) for x in lines], float)
    own = size / np.maximum([x[1] for x in lines], 1)
    ratio = smoothed(own, sigma)
    least = min(ratio.std(), ratio.max())
    chosen = ratio >= least
    core = chosen & (own >= least)  # not by its neighbours' ratio alone
    if not core.any():
        core = chosen
    articles = {x[3] for x, c in zip(lines, chosen, strict=True) if c and x[3]}
    inside = np.array([x[3] in articles for x in lines])
    if articles and size[core & inside].sum() >= size[core & ~inside].sum():
        return [x[0] for x, i in zip(lines, inside, strict=True) if i]
    # the text outside outweighs the articles: several beside it are teasers, one is a part
    within = np.array([x[3] > 0 for x in lines])
    every = {x[3] for x in lines if x[3]}
    if len({next(p for p in x[2] if p in every) for x in lines if x[3]}) > 1:
        lines, core = [x for x, w in zip(lines, within, strict=True) if not w], core[~within]
    return [x[0] for x, r in zip(lines, _region(lines, core), strict=True) if r]


def _region(lines: list[tuple[str, int, tuple, int]], core: np.ndarray) -> np.ndarray:
    """Which lines stand in the smallest container, of more than one line, that holds all ``core``
    lines. If that is the whole page, its parts before the first and after the last with such
    lines go, but for those of plain text without tags."""
    at = np.flatnonzero(core)
    paths = [x[2] for x in lines]
    first = paths[at[0]]
    depth = len(first)
    while any(paths[i][:depth] != first[:depth] for i in at) or depth > 1 and sum(p[:depth] == first[:depth] for p in paths) < 2:
        depth -= 1
    held = np.array([p[:depth] == first[:depth] for p in paths])
    if not held.all():
        return held
    part = [p[: depth + 1] if len(p) > depth else None for p in paths]  # None: in the container itself
    full = {part[i] for i in at} - {None}
    ends = [i for i in range(len(lines)) if core[i] or part[i] in full]
    tagged = {q for q, x in zip(part, lines, strict=True) if x[1] > 1} - {None}
    return np.array([ends[0] <= i <= ends[-1] or part[i] not in tagged for i in range(len(lines))])


def unsuspected(lines: list[tuple[str, int, tuple, int, int]]) -> list[tuple[str, int, tuple, int]]:
    """The lines outside suspect elements, with those of one that holds most of the text, or all."""
    size: dict[int, int] = {}
    for x in lines:
        size[x[4]] = size.get(x[4], 0) + len(x[0])
    most = max((k for k in size if k > 0), key=size.get, default=0)
    if most and not (size[most] >= DENSE and size[most] >= SHARE * sum(n for k, n in size.items() if k >= 0)):
        most = 0
    if not most and not size.get(0):
        most = max((k for k in size if size[k] >= ALONE), key=lambda k: (k > 0, size[k]), default=0)
    return [x[:4] for x in lines if x[4] in (0, most)]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    return "\n".join(content(unsuspected(parser.lines)))


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html`` in place of that column, named ``text`` (a column
    of that name gives way). Null and empty pages have empty texts."""
    kept = [c for c in pages.columns if c.lower() not in (html.lower(), text.lower())]
    frame = pages.select(*(f"`{c}`" for c in kept), f"`{html}`")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1]), f"`{text}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array((main_text(x.as_py()) for x in b.column(len(kept))), pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], texts], names=[*kept, text])

    return frame.mapInArrow(run, schema)
