"""Main text of HTML pages by composite text density.

A page is parsed into a tree. Elements that are no article text by their tag, role or name (menus, forms, comments,
scripts) are left out first. Of every other element the density is its characters a tag, adjusted by its links:

    C / T * log(C / L * T / M) to the base log(C / (C - L) * L + B * C + e)

with C characters, T tags, L characters and M tags of links, and B the link share of the body. An element's sum
adds the densities of its children and that of its own text. The element with the greatest sum is the
core; the least density on the path from it to the body is the threshold; every element on the way
down from the body that reaches it adds the element of greatest sum below it. The article is the least element around
all of these, widened to the ``article`` or ``main`` that holds it, so short paragraphs beside long ones stay.
What stays out within it are blocks of links (three links and four fifths of the characters at least) below
the threshold.

Pages are independent, so the work is one pass without a shuffle; a task holds one page's tree at a time.

Defined cases: a null or empty page, or one without article text, gives an empty text; text without markup is the
article; unclosed elements end as HTML says for blocks, list items and table cells, end tags without a start are
passed over; white space is what Python's ``str.split`` takes for it (no-break spaces included); repeated rows
give repeated results; nesting of any depth is worked off without recursion; only id, address and page are read,
so further columns are not carried on, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import in_batches, release_memory, slices

# What HTML says of its elements, and how pages name what is no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav noscript ol "
    "optgroup option p plaintext pre search section summary table tbody td template tfoot th thead title tr ul xmp".split()
)
#: Start tags that end an open element, and the elements beyond which none is ended.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr", "tbody"), "tbody": ("tr", "thead", "tbody"), "tfoot": ("tr", "tbody")}
FENCES = frozenset("html body table ul ol dl menu select template object button caption".split())
NO_PARAGRAPH = frozenset("caption dd dt head html body legend option optgroup td th tr tbody thead tfoot title".split())
SILENT = frozenset("applet audio canvas datalist embed frameset head iframe map noembed noframes noscript object script style svg template textarea title video".split())
OUTSIDE = frozenset("aside button dialog fieldset footer form input label menu nav option search select".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar tablist".split())
NAMES = frozenset(
    "ad ads adsense adslot advert adverts advertisement advertising advertisment banner banners breadcrumb breadcrumbs comment comments commentlist commentform respond disqus "
    "cookie cookies consent gdpr notice notices notification notifications alert footer foot header masthead topbar menu menus nav navbar navigation navi newsletter subscribe subscription "
    "popup modal overlay paywall promo promos promotion promoted related recommended recommendations share sharing social sidebar sidebars sidenav aside signup login skip skiplink sponsor sponsored sponsors "
    "toolbar pagination pager paging widget widgets tagcloud trending dfp".split()
)
#: A word before a name that says the element is about it, not it.
ABOUT = frozenset("has with no without is hide".split())
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
LINKS, LINK_SHARE = 3, 0.8


def named(attributes: dict[str, str | None]) -> bool:
    """Whether an element's class or id names something that is no article."""
    for name in (f"{attributes.get('class') or ''} {attributes.get('id') or ''}").split():
        words = [w.lower() for w in WORDS.findall(name)]
        if any(w in NAMES and not (i and words[i - 1] in ABOUT) for i, w in enumerate(words)):
            return True
    return False


def hidden(attributes: dict[str, str | None]) -> bool:
    """Whether an element's attributes keep it from being shown."""
    style = (attributes.get("style") or "").replace(" ", "").lower()
    return "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style


class Page(HTMLParser):
    """The tree of a page in flat lists; elements come after their parents."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.out, self.by_name = ["body"], [-1], [False], [False]
        #: Text in page order: (element, text, whether in a link); None is a break between blocks.
        self.pieces: list[tuple[int, str | None, bool]] = []
        self.open, self.counts = [0], Counter()
        self.silent, self.link = 0, 0

    def _pop(self, to: int) -> None:
        """Close the open elements from place ``to`` on."""
        for node in self.open[to:]:
            tag = self.tags[node]
            self.counts[tag] -= 1
            self.silent -= tag in SILENT
            if node == self.link:
                self.link = 0
            if tag in BLOCK:
                self.pieces.append((node, None, False))
        del self.open[to:]

    def _end(self, tags: tuple[str, ...]) -> None:
        """Close what these tags opened, up to the nearest fence."""
        if not any(self.counts[t] for t in tags):
            return
        last = 0
        for place in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[place]]
            if tag in tags:
                last = place
            elif tag in FENCES:
                break
        if last:
            self._pop(last)

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            if self.silent and self.counts["head"]:
                self._end(("head",))
            return
        if self.counts["head"] and tag in BLOCK and tag not in ("title", "template", "noscript"):
            self._end(("head",))
        if tag in ENDS:
            self._end(ENDS[tag])
        if tag in BLOCK and tag not in NO_PARAGRAPH and self.counts["p"]:
            self._end(("p",))
        if tag == "a" and self.link:
            self.link = 0
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self.open[-1])
        top = tag == "header" and not (self.counts["article"] or self.counts["main"])
        if attrs:
            attributes = dict(attrs)
            self.by_name.append(named(attributes) and tag not in ("main", "a", *HEADINGS))
            self.out.append(top or tag in OUTSIDE or hidden(attributes) or (attributes.get("role") or "").lower() in ROLES)
        else:
            self.by_name.append(False)
            self.out.append(top or tag in OUTSIDE)
        if tag in BLOCK or tag == "br":
            self.pieces.append((node, None, False))
        if tag not in VOID:
            self.open.append(node)
            self.counts[tag] += 1
            self.silent += tag in SILENT
            if tag == "a" and any(name == "href" for name, _ in attrs):
                self.link = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash says nothing in HTML

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = 0
        if not self.counts[tag] or tag in ("html", "body"):
            return
        for place in range(len(self.open) - 1, 0, -1):
            found = self.tags[self.open[place]]
            if found == tag:
                return self._pop(place)
            if (found in BLOCK and tag not in BLOCK) or (found in ("td", "th", "caption") and tag not in ("table", "tr", "tbody", "thead", "tfoot")):
                return  # a phrase does not end the block around it, nor a block the cell

    def handle_data(self, data):
        if not self.silent:
            self.pieces.append((self.open[-1], data, bool(self.link)))

    def _past(self, i, mark):
        """Behind the next mark, or at the page's end: what is never closed runs to there, as HTML says."""
        at = self.rawdata.find(mark, i)
        return at + len(mark) if at >= 0 else len(self.rawdata)

    def parse_comment(self, i, report=True):
        return self._past(i + 2, "-->")

    def parse_bogus_comment(self, i, report=True):
        return self._past(i, ">")

    parse_html_declaration = parse_pi = parse_marked_section = parse_bogus_comment

    def parse_starttag(self, i):
        end = super().parse_starttag(i)
        return end if end >= 0 else len(self.rawdata)

    def parse_endtag(self, i):
        end = super().parse_endtag(i)
        return end if end >= 0 else len(self.rawdata)

    def updatepos(self, i, j):
        return j  # lines and columns are not asked for


def parsed(html: str) -> Page:
    """The tree of a page."""
    page = Page()
    page.feed(html)
    page.close()
    return page


def joined(pieces: list[str | None]) -> str:
    """Pieces of text, broken at None, with white space joined."""
    return " ".join("".join(" " if p is None else p for p in pieces).split())


def left_out(page: Page) -> list[bool]:
    """For every element whether it is no article text by its tag, role or name, or lies in one that is not.

    A name does not count for what holds the page's first heading or its main part.
    """
    n = len(page.tags)
    holds = [tag in ("h1", "main") for tag in page.tags]
    for node in range(n - 1, 0, -1):
        holds[page.parents[node]] |= holds[node]
    out = [False] * n
    for node in range(1, n):
        parent = page.parents[node]
        out[node] = out[parent] or page.out[node] or (page.by_name[node] and not holds[node])
    return out


class Densities:
    """Characters, tags and links below every element, its density and the sum of its children's."""

    def __init__(self, page: Page, out: list[bool]):
        n = len(page.tags)
        parents = page.parents
        self.chars, self.link_chars, own = [0] * n, [0] * n, [0] * n
        self.n_tags, self.links = [0] * n, [0] * n
        for node, text, linked in page.pieces:
            if text is not None and not out[node]:
                size = len("".join(text.split()))
                own[node] += size
                self.chars[node] += size
                self.link_chars[node] += size * linked
        for node in range(n - 1, 0, -1):
            if not out[node]:
                parent = parents[node]
                self.chars[parent] += self.chars[node]
                self.link_chars[parent] += self.link_chars[node]
                self.n_tags[parent] += self.n_tags[node] + 1
                self.links[parent] += self.links[node] + (page.tags[node] == "a")
        share = self.link_chars[0] / max(1, self.chars[0])
        self.density = [self._density(node, share) for node in range(n)]
        self.sums = [float(size) for size in own]
        for node in range(n - 1, 0, -1):
            if not out[node]:
                self.sums[parents[node]] += self.density[node]

    def _density(self, node: int, share: float) -> float:
        chars, tags, linked, links = self.chars[node], max(1, self.n_tags[node]), self.link_chars[node], max(1, self.links[node])
        if not chars:
            return 0.0
        base = math.log(chars / max(1, chars - linked) * linked + share * chars + math.e)
        return max(0.0, chars / tags * math.log(max(1.0, chars / max(1, linked) * tags / links) + (tags == 1)) / base)


def article(page: Page, out: list[bool], measure: Densities) -> tuple[int, float]:
    """The article's element, and the threshold."""
    n, parents, sums, density = len(page.tags), page.parents, measure.sums, measure.density
    best = list(range(n))  # the element of greatest sum in each subtree, the first of equals
    for node in range(n - 1, 0, -1):
        if not out[node] and sums[best[node]] >= sums[best[parents[node]]] and (sums[best[node]], -best[node]) > (sums[best[parents[node]]], -best[parents[node]]):
            best[parents[node]] = best[node]
    core, node, threshold = best[0], best[0], density[best[0]]
    while node > 0:
        node = parents[node]
        threshold = min(threshold, density[node])
    reached, marked = [False] * n, [False] * n
    for node in range(n):
        reached[node] = not out[node] and measure.chars[node] > 0 and density[node] >= threshold and (node == 0 or reached[parents[node]])
        if reached[node]:
            marked[best[node]] = True
    marked[core] = True
    # The least element around all marked ones: the deepest whose subtree holds all of them.
    below = [int(m) for m in marked]
    for node in range(n - 1, 0, -1):
        below[parents[node]] += below[node]
    root = max(node for node in range(n) if below[node] == below[0])
    node = root
    while node > 0:
        if page.tags[node] in ("article", "main"):
            root = node
            break
        node = parents[node]
    return root, threshold


def main_text(html: str | None) -> str:
    """The main text of a page."""
    page = parsed(html or "")
    out = left_out(page)
    measure = Densities(page, out)
    if not measure.chars[0]:
        return ""
    root, threshold = article(page, out, measure)
    keep = [False] * len(page.tags)
    keep[root] = True
    for node in range(root + 1, len(keep)):
        chars, linked = measure.chars[node], measure.link_chars[node]
        menu = page.tags[node] in BLOCK and measure.links[node] >= LINKS and linked >= LINK_SHARE * chars and measure.density[node] < threshold
        keep[node] = keep[page.parents[node]] and not out[node] and not menu
    return joined([text for node, text, _ in page.pieces if text is None or keep[node]])


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    narrow = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))

    def run(batches):
        for part in slices(batches, "html"):
            texts = [main_text(html) for html in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
        release_memory()

    return in_batches(narrow).mapInArrow(run, "page_id long, url string, text string, n_chars long")


#: The given pages in SQL: they keep their article in one ``article`` element of headings and paragraphs.
ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS body FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(body, '<(/?(p|h[1-6]|div|li|ul|br)\b)[^>]*>', ' ', 'g'), '<[^>]*>', '', 'g') AS body FROM a),
c AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&(quot|#34|#x22);?', '"', 'g'), '&(#39|#x27);', '''', 'g') AS body FROM b),
d AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(regexp_replace(body, '&nbsp;?', ' ', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, length(text) AS n_chars FROM d
"""
