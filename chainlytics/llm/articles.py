"""Main text of web pages: parser events to lines, text-to-tag ratios, Gaussian smoothing, threshold clusters, regions.

A page is read once, as events of the standard library's streaming parser. Block elements cut it into lines; each line has its
text, the number of its tags, the characters of it that are links, and the container it stands in. Lines within elements
that can't be the article (menus, headers, footers, sidebars, notices, adverts, forms, reader comments, by element, role or
words of class and id) are set aside, but keep their place with a ratio of zero.

A line's ratio is its characters outside links over its tags. The ratios are smoothed with a Gaussian kernel, so a short
paragraph between long ones counts as they do and a long one among menus as those. Lines above the deviation of the smoothed ratios
form the content cluster. The regions they mark are then taken whole:

* articles (elements, roles, or properties that say so), if a good part of the cluster is theirs, else the main element;
* else the deepest container that holds most of the cluster: of its lines those in the cluster, between two of them, or
  beside one in the same element, and a heading just before.

So a line of the region is not lost for being short; runs of lines that are links only are menus."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from chainlytics.llm.tables import table

#: Elements that begin and end a line.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
#: Elements whose text is never shown as text, and elements that are never the article.
SILENT = frozenset("script style noscript template head title svg math canvas iframe object audio video map datalist".split())
ASIDE = frozenset("nav header footer aside form menu dialog search button select textarea input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What ends when one of these begins.
ENDS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr",), "option": ("option",)}
#: Roles, and words of class and id, of what is not the article.
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promotion banner banners "
    "sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices disclaimer copyright popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social comment comments commentlist disqus respond reply replies related recommended recommendations "
    "pagination pager widget widgets skip".split()
)
#: Words that say a class is about the layout around an element.
LAYOUT = frozenset("has no with without is not".split())

WORD = re.compile(r"[a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
UNFINISHED = re.compile(r"<[!?/a-zA-Z]")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Width of the smoothing in lines, and how many deviations a smoothed ratio must reach.
SIGMA, CUT = 1.0, 1.0

#: Share of the cluster that an article must have against its main element, that a container must hold, and that a further
#: article must have of the longest one.
ARTICLE_SHARE, HOLDS, FURTHER = 0.5, 0.8, 0.2

#: Lines of links only that follow each other and make a menu.
MENU = 3


class Lines(HTMLParser):
    """The lines of a page and the containers they stand in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.linked: list[int] = []
        self.aside: list[bool] = []
        self.heading: list[bool] = []
        self.home: list[int] = []
        self.parents, self.kinds = [-1], [""]  # containers; 0 is the page
        self.stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]  # element, container, aside, silent
        self.open: Counter = Counter()
        self._parts: list[str] = []
        self._tags = self._links = 0

    def flush(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                _, container, aside, _ = self.stack[-1]
                heading = any(self.open[h] for h in HEADINGS)
                self.aside.append(aside and not (heading and self._titles(container)))
                self.texts.append(text)
                self.tags.append(self._tags)
                self.linked.append(min(self._links, len(text)))
                self.heading.append(heading)
                self.home.append(container)
                self._tags = 0
            self._parts, self._links = [], 0

    def _titles(self, container: int) -> bool:
        """True in the header of an article, which holds its heading."""
        above = []
        while container > 0 and self.kinds[container] not in ("article", "main"):
            above.append(self.kinds[container])
            container = self.parents[container]
        return container > 0 and above.count("header") == 1 and "aside" not in above

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self._parts.append(" ")
            return
        if tag in ("td", "th"):
            self._parts.append(" ")
        block = tag in BLOCKS
        if block:
            self.flush()
            self._end_implied(tag)
        self._tags += 1
        if tag in VOID:
            return
        _, container, aside, silent = self.stack[-1]
        kind = judged(tag, attrs) if attrs or tag in ASIDE else tag
        silent = silent or tag in SILENT
        if block:
            self.parents.append(container)
            self.kinds.append(kind)
            container = len(self.parents) - 1
        elif kind != "aside" and kind != "header" and tag != "a" and tag not in SILENT:
            return  # an inline element
        self.stack.append((tag, container, aside or kind in ("aside", "header"), silent))
        self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def _end_implied(self, tag: str) -> None:
        if self.open["p"]:
            self._close("p")
        for other in ENDS.get(tag, ()):
            # Within its own list or table only.
            if self.open[other] and self.stack[-1][0] not in ("ul", "ol", "dl", "table", "menu"):
                self._close(other, ("ul", "ol", "dl", "table", "menu"))

    def _close(self, tag: str, within: tuple[str, ...] = ()) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] == tag:
                for name, *_ in self.stack[k:]:
                    self.open[name] -= 1
                del self.stack[k:]
                return
            if self.stack[k][0] in within:
                return

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        self._tags += 1
        if self.open[tag]:
            self._close(tag)

    def handle_data(self, data):
        if not self.stack[-1][3]:
            self._parts.append(data)
            if self.open["a"]:
                self._links += len(data.strip())

    def close(self):
        if UNFINISHED.match(self.rawdata):  # markup that the page breaks off in
            self.rawdata = ""
        super().close()
        self.flush()


def _says(value: str) -> bool:
    """True if a class or id names something that is not the article."""
    words = WORD.findall(CAMEL.sub("-", value).lower())
    return bool(words) and words[0] not in LAYOUT and not WORDS.isdisjoint(words)


def judged(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """``aside`` or ``header`` if an element can't be the article, ``article`` or ``main`` if it says it is, else its name."""
    if tag in ("html", "body", "main"):
        return tag
    of = {name: value or "" for name, value in attrs}
    role = of.get("role", "").lower()
    if tag == "header":
        return "header"
    if tag in ASIDE or role in ROLES or "hidden" in of or of.get("aria-hidden", "").lower() == "true" or HIDDEN.search(of.get("style", "")):
        return "aside"
    names = [*of.get("class", "").split(), *of.get("id", "").split()]
    said = [name for name in names if _says(name)]
    if said and tag not in HEADINGS:
        heads = all("header" in WORD.findall(CAMEL.sub("-", name).lower()) for name in said)
        return "header" if heads else "aside"
    if tag == "article" or role == "article" or of.get("itemprop", "").lower() == "articlebody":
        return "article"
    return "main" if role == "main" else tag


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Ratios under a Gaussian kernel of two deviations to both sides; beyond the ends there is nothing."""
    reach = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel / kernel.sum())[reach : reach + len(ratios)]


def clustered(page: Lines) -> np.ndarray:
    """True for the lines of the content cluster: those whose smoothed ratio reaches the deviation of all."""
    sizes = np.array([len(t) for t in page.texts], dtype=np.float64)
    aside = np.array(page.aside)
    ratios = np.where(aside, 0.0, (sizes - np.array(page.linked)) / np.maximum(1, np.array(page.tags)))
    smooth = smoothed(ratios)
    return (smooth >= CUT * smooth.std()) & ~aside


def _within(page: Lines, containers: set[int]) -> np.ndarray:
    """True for the lines in one of the containers, at any depth."""
    inside = [False] * len(page.parents)
    for c in range(1, len(inside)):
        inside[c] = c in containers or inside[page.parents[c]]
    return np.array([inside[c] or c in containers for c in page.home])


def _outermost(page: Lines, kind: str) -> list[int]:
    under = [False] * len(page.parents)
    found = []
    for c in range(1, len(under)):
        above = under[page.parents[c]]
        under[c] = above or page.kinds[c] == kind
        if page.kinds[c] == kind and not above:
            found.append(c)
    return found


def region(page: Lines) -> np.ndarray:
    """True for the lines of the article."""
    n = len(page.texts)
    if not n:
        return np.zeros(0, dtype=bool)
    core = clustered(page)
    aside = np.array(page.aside)
    size = np.array([len(t) for t in page.texts], dtype=np.int64)
    if not core.any():
        core = ~aside
    weight = [0] * len(page.parents)
    for line in np.flatnonzero(core).tolist():
        weight[page.home[line]] += int(size[line])
    for c in range(len(weight) - 1, 0, -1):
        weight[page.parents[c]] += weight[c]
    links = np.array(page.linked) >= 0.9 * size

    articles = {c: weight[c] for c in _outermost(page, "article") if weight[c]}
    mains = {c: weight[c] for c in _outermost(page, "main") if weight[c]}
    longest = max(articles.values(), default=0)
    chosen = {c for c, w in articles.items() if w >= FURTHER * longest}
    if mains and sum(articles[c] for c in chosen) < ARTICLE_SHARE * max(mains.values()):
        chosen = {max(mains, key=mains.get)}
    if chosen:
        kept = _within(page, chosen) & ~aside
    else:
        best = 0
        for c in range(1, len(weight)):  # parents come before their children
            if page.parents[c] == best and weight[c] >= HOLDS * weight[0]:
                best = c
        if best:
            core &= _within(page, {best})
        own = {page.home[line] for line in np.flatnonzero(core).tolist()}
        beside = {page.parents[c] for c in own if page.kinds[c] not in ("html", "body")} - {0}
        beside = {c for c in beside if page.kinds[c] not in ("html", "body")}
        near = np.array([page.parents[c] in beside for c in page.home])
        at = np.flatnonzero(core)
        between = np.zeros(n, dtype=bool)
        if len(at):
            between[at[0] : at[-1]] = True
            if best:
                between &= _within(page, {best})
        kept = (core | ((near | between) & ~links)) & ~aside
        for line in range(n - 2, -1, -1):  # a heading leads to what follows it
            if page.heading[line] and kept[line + 1] and not aside[line]:
                kept[line] = True
    menu = kept & links
    edge = np.flatnonzero(np.diff(np.concatenate(([0], menu.view(np.int8), [0]))))
    for first, last in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if last - first >= MENU:
            kept[first:last] = False
    return kept


def main_text(html: str | None) -> str:
    page = Lines()
    page.feed(html or "")
    page.close()
    return "\n".join(page.texts[line] for line in np.flatnonzero(region(page)).tolist())


def _extract(batches: Iterator[pa.RecordBatch], html: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column(html).to_pylist()]
        others = [name for name in batch.schema.names if name != html]
        columns = [batch.column(name) for name in others]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*others, "text", "n_chars"])


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with the main ``text`` of each page, its blocks joined by line feeds, and ``n_chars``.

    White space within a block, line breaks and cells of a table row become one blank. Null and empty pages, and pages without an
    article, have an empty text. Pages of any length are read whole, broken markup as it comes: elements left open end with the
    page, a paragraph at the next block. Rows are taken one by one, so repeated rows and keys stay; an empty table gives no rows.
    Columns called text or n_chars are replaced, all others pass.
    """
    kept = pages.select(*[c for c in pages.columns if c.lower() not in ("text", "n_chars") or c == html])
    kinds = [f for f in kept.schema.fields if f.name != html]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), "text string", "n_chars bigint"])
    return kept.mapInArrow(lambda it: _extract(it, html), schema)


def op12_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return extracted(table(spark, folder, "pages").select("page_id", "url", "html"))


#: For pages that are built like those of the tables: one article element of headings and paragraphs.
ORACLE = r"""
    WITH inner_ AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS a FROM pages),
    blocks AS (SELECT page_id, url, regexp_split_to_array(a, '</?(?:p|h1)>') AS b FROM inner_),
    plain AS (
        SELECT page_id, url, [trim(regexp_replace(regexp_replace(
            replace(replace(regexp_replace(replace(replace(
                regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'),
            '&lt;', '<'), '&gt;', '>'), '&quot;?', '"', 'g'), '&#x27;', ''''), '&amp;', '&'), '&amp$', '&'), '\s+', ' ', 'g')) FOR x IN b] AS b
        FROM blocks),
    joined AS (SELECT page_id, url, coalesce(array_to_string([x FOR x IN b IF x <> ''], chr(10)), '') AS text FROM plain)
    SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM joined"""
