"""Main text of web pages by composite text density.

Per page (a small helper inside ``mapInArrow``; Spark deals out the pages):

1. A tolerant scan builds the DOM in page order: implied ends of paragraphs,
   list items and cells, raw script and style, broken attributes and entities.
2. Every node gets its characters, tags, link characters and link tags, and
   from them the link-adjusted characters per tag (Sun, Song, Liao: "DOM Based
   Content Extraction via Text Density", SIGIR 2011).
3. Menus, headers, footers, sidebars, notices, adverts, forms and comments,
   told by tag, role, or a whole class token or id, don't count as content; a
   token like ``nav-menu`` counts if each of its words does. No mark holds for
   articles, main elements and headings, for what holds the page's articles or
   its main element, a marked class or id around an h1, an article's header
   with a heading, or for more than half of the text outside links; if nothing
   else is left, classes and ids aren't heeded. Of the other nodes the one with the largest sum of its children's densities is the content;
   the smallest density on its path to the body is the threshold that side
   branches of that path must reach to be content too; text that stands directly
   in a node of that path is. A surrounding article or main element is taken
   whole, whatever the densities.
4. Character references are decoded, white space in a block becomes one space,
   blocks are trimmed and joined by a line feed in page order.

Defined results: null or empty html, and pages without content, give an empty
text; ids and urls may be null and rows repeated; an empty table gives an empty
result; other columns are ignored. Nothing is cut by length or depth.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>",
    re.S,
)
UNENDED = re.compile(r"<!--.*", re.S)  # behind the last ">" only a comment can begin
ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
WORDS = re.compile(r"[a-z0-9]+")

# Element names of the HTML standard by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - frozenset("body caption dd dt html li tbody td tfoot th thead tr".split()) | frozenset(("li", "dd", "dt"))
SIBLINGS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
}
NEVER = frozenset(
    "script style head title meta noscript template svg math iframe object embed canvas audio video map select button input textarea"
    " option datalist noembed noframes xmp".split()
)
ASIDE = frozenset("nav header footer aside form menu dialog search".split())  # unless they hold the content
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner comment comments reply replies respond"
    " disqus discussion sidebar side aside nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead footer"
    " foot cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social"
    " related recommended widget toolbar form search hidden".split()
)
CONTAINERS = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
BY_TAG, BY_NAME = 1, 2


def hinted(names: str) -> bool:
    """Whether a class token or id says as a whole that it isn't content: it is a hint, or made of nothing but hints."""
    return any((words := WORDS.findall(x)) and HINTS.issuperset(words) for x in names.split())


class Page:
    """Nodes in page order, so that a parent always comes before its children."""

    def __init__(self, source: str):
        self.tag, self.parent, self.skip = ["#root"], [0], [False]
        self.items: list[tuple[int, str] | None] = []  # (node, text), or None where a block begins or ends
        self.main: list[bool] = [False]
        self.direct: set[int] = set()  # nodes whose own text is content, but not all below them
        self.mark = [0]  # BY_TAG or BY_NAME: not content, unless it holds the content
        self.open = Counter()  # of each name, how many elements are open
        open_ = [0]
        at, end = 0, len(source)
        last = source.rfind(">")  # no tag begins behind it, so none is looked for to the end again and again
        endless: set[str] = set()  # raw elements known to have no end tag any more
        while at < end:
            m = TOKEN.search(source, at) if at <= last else UNENDED.search(source, at)
            if m is None:
                self.text(open_[-1], source[at:])
                break
            if m.start() > at:
                self.text(open_[-1], source[at : m.start()])
            at = m.end()
            tag = m["tag"] or m["tag2"] if m.re is TOKEN else None
            if tag is None:
                continue
            tag = tag.lower()
            if m["end"] or m["end2"]:
                self.close(open_, tag)
                continue
            attrs = m["attrs"] or m["attrs2"] or ""
            self.begin(open_, tag, attrs)
            if tag in RAW and not attrs.rstrip().endswith("/"):
                close = None if tag in endless else re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                if close is None:
                    endless.add(tag)
                if tag == "textarea" and close is None:
                    continue
                at = close.end() if close else end
                self.shut(open_, len(open_) - 1)

    def shut(self, open_: list[int], k: int) -> None:
        for x in open_[k:]:
            self.open[self.tag[x]] -= 1
        del open_[k:]

    def text(self, node: int, raw: str) -> None:
        if raw and not raw.isspace():
            self.items.append((node, html.unescape(raw)))
        elif raw:
            self.items.append((node, " "))

    def begin(self, open_: list[int], tag: str, attrs: str) -> None:
        if tag == "br":
            self.items.append((open_[-1], "\n"))
        if tag in ENDS_P:
            self.close(open_, "p", frozenset(("table", "td", "th", "button", "caption")))
        if tag in SIBLINGS and any(self.open[x] for x in SIBLINGS[tag][0]):
            same, bounds = SIBLINGS[tag]
            for k in range(len(open_) - 1, 0, -1):
                name = self.tag[open_[k]]
                if name in bounds:
                    break
                if name in same:
                    self.shut(open_, k)
                    self.items.append(None)
                    if tag != "tr":
                        break
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(open_[-1])
        own = {k.lower(): (a or b or c).lower() for k, a, b, c in ATTR.findall(attrs)} if attrs.strip() else {}
        skip = tag in NEVER
        if own and not skip:
            skip = own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "")
        main, mark = tag in CONTAINERS or own.get("role") == "main", BY_TAG if tag in ASIDE else 0
        nested = tag == "article" and self.open["article"] > 0  # a comment may be an article in the article
        if own and not mark and tag not in ("html", "body") and tag not in HEADINGS and (nested or not main):
            if own.get("role") in ROLES:
                mark = BY_TAG
            elif hinted(f"{own.get('class', '')} {own.get('id', '')}"):
                mark = BY_NAME
        self.mark.append(0 if main and not nested else mark)
        self.main.append(main)
        self.skip.append(skip or self.skip[open_[-1]])
        if tag in BLOCK:
            self.items.append(None)
        if tag not in VOID and not (attrs.endswith("/") and tag not in BLOCK and tag not in ("a", "b", "i", "span")):
            open_.append(node)
            self.open[tag] += 1

    def close(self, open_: list[int], tag: str, bounds: frozenset = frozenset()) -> None:
        if not self.open[tag]:
            return
        inline = tag not in BLOCK
        for k in range(len(open_) - 1, 0, -1):
            name = self.tag[open_[k]]
            if name == tag:
                if any(self.tag[x] in BLOCK for x in open_[k:]):
                    self.items.append(None)
                self.shut(open_, k)
                return
            if name in bounds or (inline and name in BLOCK):
                return

    def heed(self) -> None:
        """Skip the marked nodes, but for those that hold the content."""
        n = len(self.tag)
        marked, linked, article = [False] * n, [False] * n, [False] * n
        for i in range(1, n):
            p = self.parent[i]
            marked[i] = marked[p] or self.mark[i] > 0
            linked[i] = linked[p] or self.tag[i] == "a"
            article[i] = article[p] or self.main[p]
        plain, mains, heads, tops = [0] * n, [0] * n, [0] * n, [0] * n
        for x in self.items:
            if x is not None and not self.skip[x[0]] and not linked[x[0]]:
                plain[x[0]] += len("".join(x[1].split()))
        free = any(plain[i] and not marked[i] for i in range(n))
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            if not self.skip[i]:
                mains[i] += self.main[i] and plain[i] > 0
                heads[i] += self.tag[i] in HEADINGS
                tops[i] += self.tag[i] == "h1"
            for k in (plain, mains, heads, tops):
                k[p] += k[i]
        titled = any(self.tag[i] == "h1" and not marked[i] and not self.skip[i] for i in range(n))
        outside = any(self.main[i] and plain[i] and not marked[i] and not self.skip[i] for i in range(n))  # an article apart from all marks

        def holds(i: int) -> bool:
            if self.tag[i] in ("nav", "menu"):
                return False
            if not outside and (mains[i] or 2 * plain[i] > plain[0] and not titled and (tops[i] or not free)):
                return True
            return tops[i] > 0 if self.mark[i] == BY_NAME else self.tag[i] == "header" and article[i] and heads[i] > 0

        hard = list(self.skip)
        for names in (True, False):
            self.skip = list(hard)
            for i in range(1, n):
                mark = self.mark[i] == BY_TAG or (names and self.mark[i] == BY_NAME)
                self.skip[i] = hard[i] or self.skip[self.parent[i]] or (mark and not holds(i))
            if free or any(x is not None and not self.skip[x[0]] and not x[1].isspace() for x in self.items):
                break

    def content(self) -> list[bool]:
        """Which nodes belong to the content."""
        n = len(self.tag)
        if any(self.mark):
            self.heed()
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        own, linked = [0] * n, [False] * n
        for x in self.items:
            if x is not None and self.tag[x[0]] not in RAW:
                own[x[0]] += len("".join(x[1].split()))
        for i in range(1, n):
            linked[i] = linked[self.parent[i]] or self.tag[i] == "a"
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            chars[i] += own[i]
            if linked[i]:
                link_chars[i] += own[i]
            chars[p] += chars[i]
            link_chars[p] += link_chars[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i] + (self.tag[i] == "a")
        chars[0] += own[0]
        body = next((i for i in range(n) if self.tag[i] == "body"), 0)
        share = link_chars[body] / max(1, chars[body])

        def density(i: int) -> float:
            c, t, lc, lt = chars[i], max(1, tags[i]), link_chars[i], max(1, link_tags[i])
            if not c:
                return 0.0
            base = math.log(math.log(c / max(1, c - lc) * lc + share * c + math.e))
            adjusted = math.log(c / max(1, lc) * t / lt)
            return c / t * (adjusted / base if base > 0.1 else max(0.0, adjusted) * 10)

        dens = [0.0 if self.skip[i] else density(i) for i in range(n)]
        sums = [0.0] * n
        for i in range(1, n):
            sums[self.parent[i]] += dens[i]
        live = [i for i in range(n) if not self.skip[i] and (chars[i] or i == 0)]
        best = max(live, key=lambda i: (sums[i], -i))
        path = [best]
        while path[-1]:
            path.append(self.parent[path[-1]])
        low = min((dens[i] for i in path if i >= body and dens[i] > 0), default=0.0)
        chosen = {best}
        around = next((i for i in reversed(path) if self.main[i]), None)
        if around is not None:
            chosen = {around}
        else:
            on = set(path)
            self.direct = {i for i in path if i >= body and not self.skip[i] and not linked[i]}
            chosen |= {i for i in live if i not in on and self.parent[i] in on and i > body and dens[i] >= low}
            if not any(sums[i] for i in live):  # text without elements
                chosen |= on
        inside = [False] * n
        for i in range(n):
            inside[i] = (i in chosen or (i > 0 and inside[self.parent[i]])) and not self.skip[i]
        return inside

    def main_text(self) -> str:
        inside, blocks, now = self.content(), [], []
        for x in [*self.items, None]:
            if x is None:
                if block := " ".join("".join(now).split()):
                    blocks.append(block)
                now = []
            elif inside[x[0]] or x[0] in self.direct:
                now.append(x[1])
        return "\n".join(blocks)


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("text"))
    schema = rows.schema

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            texts = pa.array([main_text(x) for x in b.column(2).to_pylist()], b.schema.field(2).type)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), texts], schema=b.schema)

    return rows.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))
