"""Main text of web pages by composite text density.

A page becomes a tree of its block elements; what lies inline in a block is its own text.
Characters, tags, link characters and link tags are summed up for every node. A node's composite
density is characters for each tag, times a logarithm that shrinks it by the share of links, to
a base that grows with the links of the node and of the whole page. Its density sum is
that of its children, its own text counting as one. The node with the largest density sum is the
heart of the article, and the smallest density on its way from the body is the threshold that
other parts have to reach.

Before that, elements that are no article go: menus, headers, footers, asides, forms, scripts,
styles and the like by tag or role, adverts, notices, sidebars and reader comments by the words of
their classes and ids. Where a page marks an article or a main part, the heart is looked for in
there and the whole part is taken; elsewhere it is the heart, its heading, and the dense parts
beside its way from the body.

The tree is made as browsers do: void elements, raw text, implied ends of paragraphs, list items
and cells, quoted attributes; from 512 levels on nothing gets deeper. Every page takes time in
proportion to its length, whole texts are read, no row moves to another task.

Defined cases: null or empty html, and pages without text, give the empty text. A page whose
whole text lies in forms or in elements dropped by name is read again with forms, and then
without names. An attribute whose quote never ends stops at the next >, a tag without one takes
the rest of the page. Line breaks inside a block are white space; table cells and list items
are blocks. Repeated rows stay. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightmere.llm.common import chunks


def _set(text: str) -> frozenset[str]:
    return frozenset(text.split())


VOID = _set("area base br col embed hr img input link meta param source track wbr")
# Their content is no markup, up to the end tag.
RAW = _set("script style title textarea iframe noembed noframes xmp")
BLOCKS = _set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p "
    "pre search section summary table tbody td tfoot th thead tr ul"
)
# Blocks that do not end an open paragraph.
INSIDE = _set("body caption dd dt html legend li optgroup option tbody td tfoot th thead tr")
HEADINGS = _set("h1 h2 h3 h4 h5 h6")
# Which open elements a start tag ends, and where the search for them stops.
ENDS = {
    "li": (_set("li"), _set("ul ol menu dir")),
    "dd": (_set("dd dt"), _set("dl")),
    "dt": (_set("dd dt"), _set("dl")),
    "option": (_set("option"), _set("select datalist")),
    "optgroup": (_set("option optgroup"), _set("select")),
    "tr": (_set("tr td th caption"), _set("table")),
    "td": (_set("td th"), _set("tr table")),
    "th": (_set("td th"), _set("tr table")),
    "tbody": (_set("tbody thead tfoot tr td th caption"), _set("table")),
    "thead": (_set("tbody thead tfoot tr td th caption"), _set("table")),
    "tfoot": (_set("tbody thead tfoot tr td th caption"), _set("table")),
    "a": (_set("a"), BLOCKS),
    "button": (_set("button"), BLOCKS),
}
# A paragraph outside of these is not ended by what is inside.
SCOPE = _set("button caption html object table td th")
DEEPEST = 512
# An article with so many characters outside of its inner articles is more than their frame.
FRAME = 100

DROPPED = _set(
    "aside audio button canvas datalist dialog embed footer form head iframe input map menu nav noembed noframes "
    "noscript object option script search select style svg template textarea title video"
)
ROLES = _set(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar"
)
# Words of classes and ids that name no article.
NAMES = _set(
    "ad adbox ads adsbygoogle adsense adslot adunit adv advert advertisement advertisements advertising "
    "adverts alert alerts aside banner breadcrumb breadcrumbs comment commentlist comments consent cookie "
    "cookies copyright disclaimer disqus footer form gdpr login masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices overlay pager pagination popup popups promo promos promotion "
    "recommendations recommended related replies reply respond search share sharing sidebar sidebars signin "
    "signup sitemap skip social sponsor sponsored sponsors submenu subscribe subscription toolbar topbar "
    "widgets"
)
# Beside one of these such a word tells of the page and not of the element.
ABOUT = _set("has no with without")
# A header with one of these belongs to the article.
HEADED = _set("article chapter content entry heading post section story title")
PARTS = _set("article main")
# An article is dropped by a name only where the whole name is one of these.
ARTICLE_NAMES = _set("ad advert comment comments promo related reply sidebar sponsored teaser")

TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""")
LOOSE = re.compile(r"</?([a-zA-Z][^\s/>]*)([^>]*+)>")
OTHER = re.compile(r"<!--(?:-?>|.*?--!?>)|<!\[CDATA\[.*?\]\]>|<[!?/][^>]*+>", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
TELLING = re.compile(r"class|id|role|hidden|style|itemprop", re.I)


class Page:
    """The blocks of a page with their text, without what is no article."""

    def __init__(self, html: str, strict: bool = True, named: bool = True):
        self.tags, self.parents, self.part = ["body"], [-1], [False]
        # One entry for each stretch of inline content: its block, text, link characters, tags, links.
        self.runs: list[tuple[int, str, int, int, int]] = []
        self.strict, self.named = strict, named
        self._read(html)

    def _read(self, html: str) -> None:
        # Open elements: name, block it lies in or is, whether its content is dropped, and why.
        stack: list[tuple[str, int, str]] = [("html", 0, "")]
        opened: dict[str, int] = defaultdict(int)
        text: list[str] = []
        linked: list[str] = []
        count, links, link = 0, 0, 0  # link: the depth at which a link is open
        at, size = 0, len(html)

        def flush() -> None:
            nonlocal count, links
            if text:
                line = " ".join("".join(text).split())
                if line:
                    held = len(" ".join("".join(linked).split()))
                    self.runs.append((stack[-1][1], line, min(held, len(line)), count, links))
            text.clear()
            linked.clear()
            count = links = 0

        def close(depth: int) -> None:
            """End the elements from ``depth`` on."""
            nonlocal link
            while len(stack) > depth:
                if stack[-1][0] in BLOCKS:
                    flush()
                opened[stack.pop()[0]] -= 1
            if link > len(stack):
                link = 0

        def within(names: frozenset[str], stop: frozenset[str]) -> int:
            """The depth of the outermost open element of ``names`` inside the nearest of ``stop``."""
            found = 0
            if any(opened[n] > 0 for n in names):
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in names:
                        found = depth
                    elif stack[depth][0] in stop:
                        break
            return found

        while at < size:
            begin = html.find("<", at)
            if begin != at:
                piece = html[at : begin if begin >= 0 else size]
                if not stack[-1][2]:
                    piece = unescape(piece) if "&" in piece else piece
                    text.append(piece)
                    if link:
                        linked.append(piece)
                if begin < 0:
                    break
            following = html[begin + 1 : begin + 2]
            if following and following in "!?" or following == "/" and not html[begin + 2 : begin + 3].isalpha():
                found = OTHER.match(html, begin)
                if found is None:
                    break
                if found[0].startswith("<![CDATA[") and not stack[-1][2]:
                    text.append(found[0][9:-3])
                at = found.end()
                continue
            if not (following == "/" or following.isascii() and following.isalpha()):
                if not stack[-1][2]:
                    text.append("<")
                at = begin + 1
                continue
            found = TAG.match(html, begin) or LOOSE.match(html, begin)
            if found is None:
                break
            at = found.end()
            tag = found[1].lower()
            if following == "/":
                if tag == "a":
                    link = 0
                if tag in HEADINGS:
                    depth = within(HEADINGS, SCOPE)
                elif opened[tag] <= 0 or tag in ("html", "body"):
                    continue
                elif tag in BLOCKS:
                    depth = within(_only(tag), SCOPE - {tag} if tag not in ("table", "body") else frozenset())
                    if depth:  # the innermost one
                        depth = max(d for d in range(depth, len(stack)) if stack[d][0] == tag)
                else:
                    depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == tag or stack[d][0] in BLOCKS), 0)
                    if stack[depth][0] != tag:
                        continue
                if depth:
                    close(depth)
                continue
            if tag in ("html", "body"):
                continue
            if tag in ENDS:
                depth = within(*ENDS[tag])
                if depth:
                    close(depth)
                if tag == "a":
                    link = 0
            elif tag in BLOCKS and tag not in INSIDE:
                depth = within(_only("p"), SCOPE)
                if depth:
                    close(depth)
                if tag in HEADINGS and stack[-1][0] in HEADINGS:
                    close(len(stack) - 1)
            if tag in BLOCKS:
                flush()
            if tag == "br" and not stack[-1][2]:
                text.append(" ")
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                if end is None:
                    break
                at = end.start()
                closing = html.find(">", at)
                if closing < 0:
                    break
                at = closing + 1
                continue
            off, part = self._off(tag, found[2], stack[-1][2])
            count += not off and tag not in BLOCKS
            if tag in VOID:
                continue
            block = stack[-1][1]
            if tag in BLOCKS and not off:
                self.tags.append(tag)
                self.parents.append(block)
                self.part.append(part)
                block = len(self.tags) - 1
            if len(stack) < DEEPEST:
                stack.append((tag, block, off))
                opened[tag] += 1
                if tag == "a" and not off and "href" in found[2]:
                    link, links = len(stack), links + 1
        close(1)
        flush()

    def _off(self, tag: str, attributes: str, outer: str) -> tuple[str, bool]:
        """Why the content of an element is dropped (its tag, its name or its frame's), and whether
        it is the article or main part of the page."""
        part, names = tag in PARTS, ""
        if attributes and TELLING.search(attributes):
            given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
            role = given.get("role", "").lower()
            if "hidden" in given or UNSEEN.search(given.get("style", "")) or role in ROLES:
                return "tag", False
            part = part or role in ("main", "article") or "articleBody" in given.get("itemprop", "")
            names = f"{given.get('class', '')} {given.get('id', '')}"
        if outer == "tag" or tag in DROPPED and (tag != "form" or self.strict):
            return "tag", False
        if self.named and names and self._no_article(tag, names):
            return "name", False
        if tag == "header" and self.named and not any(self.part) and not HEADED & _words(names):
            return "name", False
        return ("", True) if part else (outer, False)

    @staticmethod
    def _no_article(tag: str, names: str) -> bool:
        if tag in PARTS:
            return any(n.lower() in ARTICLE_NAMES for n in names.split())
        for name in names.split():
            words = _words(name)
            if words & NAMES and not words & ABOUT or "header" in words and not words & HEADED:
                return True
        return False

    def text(self) -> str:
        """The lines of the main text, by ``select``."""
        if not self.runs:
            return ""
        chosen = self.select()
        return "\n".join(line for block, line, *_ in self.runs if block in chosen)

    def select(self) -> set[int]:
        """The blocks of the main text."""
        n = len(self.tags)
        own = [[0, 0, 0, 0] for _ in range(n)]  # characters, link characters, tags, links
        for block, line, held, tags, links in self.runs:
            for i, x in enumerate((len(line), held, tags, links)):
                own[block][i] += x
        all_ = [list(x) for x in own]
        for i in range(n - 1, 0, -1):
            up = all_[self.parents[i]]
            for j in range(4):
                up[j] += all_[i][j]
            up[2] += 1
        ratio = all_[0][1] / max(1, all_[0][0])

        def density(chars: int, held: int, tags: int, links: int) -> float:
            if not chars:
                return 0.0
            base = math.log(chars / max(1, chars - held) * held + ratio * chars + math.e)
            inner = chars / max(1, held) * max(1, tags) / max(1, links)
            return chars / max(1, tags) * math.log(max(inner, 1.0)) / max(math.log(base), 1e-9) if base > 1 + 1e-9 else chars / max(1, tags)

        dense = [density(*x) for x in all_]
        sums = [density(*x) if x[0] else 0.0 for x in own]
        for i in range(1, n):
            sums[self.parents[i]] += dense[i]

        # Blocks are numbered as they begin, so a subtree is a range.
        ends = list(range(1, n + 1))
        for i in range(n - 1, 0, -1):
            ends[self.parents[i]] = max(ends[self.parents[i]], ends[i])
        articles = [i for i in range(1, n) if self.part[i] and all_[i][0]]
        articles = [i for i in articles if self.tags[i] == "article"] or articles
        places = _covered([(i, ends[i]) for i in articles] or [(0, n)])
        heart = max(places, key=lambda i: (sums[i], -i))
        way = [heart]
        while way[-1]:
            way.append(self.parents[way[-1]])
        on_way = set(way)
        if articles:
            top = next(i for i in articles if i in on_way)
            chosen = set(range(top, ends[top]))
            # An article in an article is a comment on it, unless the outer one is but its frame.
            nested = set(_covered([(i, ends[i]) for i in articles if top < i < ends[top]]))
            if sum(own[i][0] for i in chosen - nested) >= FRAME:
                chosen -= nested
        else:
            least = min(dense[i] for i in way[:-1] or way)
            heads = self._headings(all_)
            beside = [
                i
                for i in range(1, n)
                if i not in on_way and self.parents[i] in on_way
                and (dense[i] >= least and 2 * all_[i][1] < all_[i][0] or i < heart and i in heads)
            ]
            chosen = set(_covered([(i, ends[i]) for i in [heart, *beside]]))
        return chosen - set(_covered([(i, ends[i]) for i in chosen if self._links(i, all_)]))

    def _headings(self, all_: list) -> set[int]:
        """The blocks whose whole text is one heading of the first order, and no link."""
        found = set()
        for i, tag in enumerate(self.tags):
            if tag == "h1" and all_[i][0] > 2 * all_[i][1]:
                up = i
                while up and all_[up][0] == all_[i][0]:
                    found.add(up)
                    up = self.parents[up]
        return found

    def _links(self, block: int, all_: list) -> bool:
        """Whether a list or division holds three links and hardly anything else."""
        chars, held, _, links = all_[block]
        return links >= 3 and held >= 0.9 * chars and self.tags[block] in ("ul", "ol", "dl", "div", "section", "table")


def _covered(ranges: list[tuple[int, int]]) -> list[int]:
    """The numbers in any of the ranges, ascending."""
    found, at = [], 0
    for begin, end in sorted(ranges):
        found.extend(range(max(at, begin), end))
        at = max(at, end)
    return found


def _words(name: str) -> set[str]:
    return {w.lower() for w in WORD.findall(name)}


def _only(tag: str) -> frozenset[str]:
    return frozenset((tag,))


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    return Page(html).text() or Page(html, strict=False).text() or Page(html, strict=False, named=False).text()


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page's main text, from its ``html``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(read, "page_id bigint, url string, text string, n_chars bigint")
