"""Main text of web pages by composite text density.

Every element gets the number of characters and tags below it and the part of both inside links. Its density is
characters per tag, lowered by links with a logarithm whose base grows with the page's own share of link text. The
element whose children have the largest sum of densities holds the text; it is widened to its ancestors as long as they
are at least as dense as the body is. Text may stand in several elements: the smallest density on the path from that
element to the body is the threshold, and other elements of the body that reach it give their text as well, and so do
headings and paragraphs beside the path.

Marked articles are believed where they hold a fair part of the text: the densest one counts, with siblings that are about as
large. Small articles inside an article are reader comments or teasers. Names of elements say what is no text only where they
are plain (comments, adverts, notices); others (menu, share, related) are evidence that must be borne out by links, and
lower the density of what stands outside articles.

Pages are read one by one, in a single pass over their markup; nothing grows with the table.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from hourgrid.llm.common import arrow_rows

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?P<name>class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
#: Elements without text of the article that may stand inside a line.
SILENT = frozenset(
    "audio button canvas datalist iframe input legend map noscript object option progress script select style svg "
    "template textarea video".split()
)
#: All elements that hold no text of the article.
FURNITURE = SILENT | frozenset("aside dialog fieldset footer form head label menu nav title".split())
RAW = frozenset("iframe noscript script style textarea title xmp".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_PLAIN_NAMES = (
    "ads?|advert\\w*|banner|breadcrumbs?|\\w*comments?|cookies?|disclaimer|disqus|footer|newsletter|notices?|popup|promo|"
    "replies|sidebar|sponsor\\w*|subscribe|(?:reader|user|visitor)s?[_-]?(?:letters|opinions?|posts|responses|reviews)"
)
NAMED = re.compile(rf"(?:^|[\s_-])(?:{_PLAIN_NAMES})(?:$|[\s_-])", re.I)
_VAGUE_NAMES = "consent|legal|menu|modal|nav|navbar|navigation|promotion|related|share|sharing|social|teasers?"
VAGUE = re.compile(rf"(?:^|[\s_-])(?:{_VAGUE_NAMES})(?:$|[\s_-])", re.I)
#: Link share from which a vaguely named element is no text, and characters below which it is none outside articles.
LINK_SHARE, SHORT = 0.25, 140
#: Words of notices; a short block beside the text that has one is no text.
NOTICE = re.compile(r"©|\(c\) ?[12][0-9]{3}|copyright|all rights reserved|privacy policy|terms of (?:use|service)|cookies", re.I)
TOP_NAMED = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?:$|[\s_-])", re.I)
#: A start tag ends an open element of these kinds, up to the nearest of the limits.
ENDS = {
    "li": (frozenset(["li"]), frozenset("ol ul".split())),
    "dt": (frozenset("dd dt".split()), frozenset(["dl"])),
    "dd": (frozenset("dd dt".split()), frozenset(["dl"])),
    "tr": (frozenset("td th tr".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("table tr".split())),
    "th": (frozenset("td th".split()), frozenset("table tr".split())),
}
ARTICLE = frozenset("article main".split())
TEXTUAL = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul".split())
#: Part of the text that a marked article holds at least, and size of a sibling in articles.
FAIR_PART, SIBLING_PART = 0.25, 0.5


class Page:
    """Elements in page order: parent, tag, and counts below each; text blocks with the element they stand in."""

    def __init__(self, source: str):
        self.tags, self.parents = ["#page"], [-1]
        self.chars, self.links, self.linked = [0], [0], [0]
        self.blocks: list[tuple[int, str]] = []
        self.stack, self.block_stack = [0], [0]
        self.open: Counter[str] = Counter()
        self.skipped: list[str] = []
        self.held: list[str] = []
        self.links_open = 0
        self.vague: set[int] = set()
        self._read(source)

    def _flush(self) -> None:
        text = " ".join("".join(self.held).split())
        self.held = []
        if text:
            self.blocks.append((self.block_stack[-1], text))

    def _text(self, piece: str) -> None:
        if not piece or self.skipped:
            return
        piece = html.unescape(piece)
        self.held.append(piece)
        size = sum(map(len, piece.split()))
        top = self.stack[-1]
        self.chars[top] += size
        if self.links_open:
            self.linked[top] += size

    def _close_to(self, place: int) -> None:
        """Close every open element from `place` of the stack on."""
        for i in reversed(self.stack[place:]):
            tag = self.tags[i]
            self.open[tag] -= 1
            self.links_open -= tag == "a"
            if i == self.block_stack[-1]:
                self.block_stack.pop()
        del self.stack[place:]

    def _open_place(self, wanted, limits) -> int | None:
        if not any(self.open[tag] for tag in wanted):
            return None
        for place in range(len(self.stack) - 1, 0, -1):
            tag = self.tags[self.stack[place]]
            if tag in wanted:
                return place
            if tag in limits:
                return None
        return None

    def _furniture(self, tag: str, rest: str) -> bool:
        if tag in FURNITURE:
            return True
        inside = any(self.open[a] for a in ARTICLE)
        if tag == "header" and not inside:
            return True
        if tag in ("html", "body") or tag in ARTICLE or not rest:
            return False
        for found in ATTRIBUTE.finditer(rest):
            name, value = found["name"].lower(), found[2] or found[3] or found[4] or ""
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                return True
            if name == "role" and value.lower() in ROLES:
                return True
            if name in ("class", "id") and (NAMED.search(value) or not inside and TOP_NAMED.search(value)):
                return True
        return False

    @staticmethod
    def _vague(tag: str, rest: str) -> bool:
        if tag in ("html", "body") or tag in ARTICLE or not rest:
            return False
        found = ((f["name"].lower(), f[2] or f[3] or f[4] or "") for f in ATTRIBUTE.finditer(rest))
        return any(name in ("class", "id") and VAGUE.search(value) for name, value in found)

    def _start(self, tag: str, rest: str) -> None:
        closed = rest.endswith("/") or tag in VOID
        if self.skipped:
            if not closed:
                self.skipped.append(tag)
            return
        if tag not in INLINE and tag not in SILENT:
            self._flush()
            place = self._open_place(("p",), ())
            if place and tag not in VOID:
                self._close_to(place)
            if tag in ENDS and (place := self._open_place(*ENDS[tag])):
                self._close_to(place)
        elif tag == "br":
            self.held.append(" ")
        if self._furniture(tag, rest):
            if not closed:
                self.skipped.append(tag)
            return
        if self._vague(tag, rest):
            self.vague.add(len(self.tags))
        self.tags.append(tag)
        self.parents.append(self.stack[-1])
        for counts in (self.chars, self.linked):
            counts.append(0)
        self.links.append(int(tag == "a" or self.links_open > 0))
        if not closed:
            self.stack.append(len(self.tags) - 1)
            self.open[tag] += 1
            self.links_open += tag == "a"
            if tag not in INLINE:
                self.block_stack.append(len(self.tags) - 1)

    def _end(self, tag: str) -> None:
        if self.skipped:
            if tag in self.skipped:
                while self.skipped.pop() != tag:
                    pass
            elif tag not in INLINE and self.open[tag] > 0:
                # The end of an element around the skipped one ends that as well.
                self.skipped = []
                self._end(tag)
            return
        if tag in INLINE:
            place = self._open_place((tag,), ())
            if place and self.stack[place] > self.block_stack[-1]:
                del self.stack[place]
                self.open[tag] -= 1
                self.links_open -= tag == "a"
            return
        self._flush()
        if place := self._open_place((tag,), ()):
            self._close_to(place)

    def _read(self, source: str) -> None:
        at = 0
        while found := MARKUP.search(source, at):
            self._text(source[at : found.start()])
            at = found.end()
            if not found["tag"]:
                continue
            tag = found["tag"].lower()
            if found["end"]:
                self._end(tag)
                continue
            self._start(tag, found["rest"].strip())
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
                at = close.start() if close else len(source)
        self._text(source[at:])
        self._flush()

    def text(self) -> str:
        chosen, dropped = self._main()
        below = self._subtree(chosen, dropped)
        return "\n".join(text for i, text in self.blocks if i in below)

    def _subtree(self, tops: set[int], without: set[int]) -> set[int]:
        inside = set(tops)
        for i in range(min(tops) + 1, len(self.tags)):
            if self.parents[i] in inside and i not in without:
                inside.add(i)
        return inside - without

    def _articles(self) -> list[int]:
        """The nearest article (or main without articles in the page) at or above each element, else 0."""
        kinds = ("article",) if "article" in self.tags else ("main",)
        near = [0] * len(self.tags)
        for i in range(1, len(self.tags)):
            near[i] = i if self.tags[i] in kinds else near[self.parents[i]]
        return near

    def _main(self) -> tuple[set[int], set[int]]:
        """The elements whose text is the page's, and elements below them that are none."""
        n = len(self.tags)
        chars, linked, links, marks = self.chars[:], self.linked[:], self.links[:], [0] * n
        article, dropped = self._articles(), set()
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            if i in self.vague and (
                linked[i] > LINK_SHARE * chars[i] or not article[i] and chars[i] < SHORT
            ):
                dropped.add(i)
                chars[i] = linked[i] = 0
            chars[p] += chars[i]
            linked[p] += linked[i]
            links[p] += links[i]
            marks[p] += marks[i] + 1
        body = self.tags.index("body") if "body" in self.tags else 0
        share = linked[body] / max(chars[body], 1)

        def density(i: int) -> float:
            if not chars[i]:
                return 0.0
            plain, many = max(chars[i] - linked[i], 1), max(marks[i], 1)
            base = math.log(chars[i] / plain * linked[i] + share * chars[i] + math.e)
            ratio = chars[i] / max(linked[i], 1) * many / max(links[i], 1)
            # Without links the base is e: the logarithm below stays defined for all link shares.
            dense = chars[i] / many * max(math.log(max(ratio, 1.0)), 1e-9) / max(math.log(max(base, 1 + 1e-9)), 1.0)
            return dense / 4 if i in self.vague and not article[i] else dense

        dense = [density(i) for i in range(n)]
        sums = [0.0] * n
        for i in range(1, n):
            if self.tags[i] not in INLINE:
                sums[self.parents[i]] += dense[i]
        best = max((i for i in range(n) if self.tags[i] not in INLINE), key=lambda i: (sums[i], dense[i], -i))
        if not sums[best] and best:
            best = body
        marked = self._marked(article, chars, sums, dense, dropped)
        if marked and (article[best] or max(chars[i] for i in marked) >= FAIR_PART * chars[best]):
            return marked, dropped

        path = [best]
        while path[-1] not in (0, body):
            path.append(self.parents[path[-1]])
        root, least = path[-1], min(dense[i] for i in path)
        if best == root:
            return {best}, dropped
        # From the top: the ancestors of each element below the body that are no thinner than it.
        wide = list(range(n))
        for i in range(1, n):
            p = self.parents[i]
            if p > 0 and p != body and dense[p] >= dense[body]:
                wide[i] = wide[p]
        # From the bottom: the element of the largest sum in each.
        top = list(range(n))
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            if self.tags[i] not in INLINE:
                top[p] = max(top[p], top[i], key=lambda j: (sums[j], dense[j], -j))
        chosen, reached = {wide[best]}, {root}
        for i in range(root + 1, n):
            if self.parents[i] in reached and self.tags[i] not in INLINE and chars[i] and dense[i] >= least:
                reached.add(i)
                chosen.add(wide[top[i]])
        # Nothing left out: text between the elements belongs to them.
        if all(i in chosen for i in range(root + 1, n) if self.parents[i] == root and chars[i]):
            chosen = {root}
        # Headings, paragraphs and the like beside the path.
        steps = {*path, *(self.parents[i] for i in chosen)} - {best}
        for i in range(1, n):
            if self.tags[i] in TEXTUAL and self.parents[i] in steps and chars[i] and linked[i] <= chars[i] / 2:
                chosen.add(i)
        words: dict[int, list[str]] = {}
        for i, text in self.blocks:
            while i and i != root:
                if i in chosen and i != wide[best]:
                    words.setdefault(i, []).append(text)
                i = self.parents[i]
        dropped |= {
            i for i, texts in words.items() if chars[i] < chars[best] and chars[i] < 1000 and NOTICE.search(" ".join(texts))
        }
        return chosen, dropped

    def _marked(self, article: list[int], chars: list[int], sums: list[float], dense: list[float], dropped: set[int]) -> set[int]:
        """The densest article with its siblings of about its size; small articles inside articles are dropped."""
        outer = set()
        for i in range(1, len(self.tags)):
            if article[i] != i or not chars[i]:
                continue
            around = article[self.parents[i]]
            if around and chars[i] < SIBLING_PART * chars[around]:
                dropped.add(i)
            elif not around:
                outer.add(i)
        if not outer:
            return outer
        best = max(outer, key=lambda i: (max(sums[i], dense[i]), chars[i], -i))
        return {
            i for i in outer
            if i == best or self.parents[i] == self.parents[best] and chars[i] >= SIBLING_PART * chars[best]
        }


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points); one row per page.

    Blocks are joined by a line break; white space inside a block is one space. Null and empty html, and pages without
    text, give an empty text. Null page_id and url stay null; repeated rows stay repeated; other columns are ignored. An
    empty table gives no rows.
    """
    fields = [pages.schema["page_id"], pages.schema["url"]]
    schema = pa.schema(
        [(f.name, to_arrow_type(f.dataType)) for f in fields] + [("text", pa.string()), ("n_chars", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for page, url, source in zip(*batch.columns, strict=True):
                    text = main_text(source.as_py())
                    yield page.as_py(), url.as_py(), text, len(text)

        yield from arrow_rows(rows(), schema)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return pages.select("page_id", "url", "html").mapInArrow(run, f"{kinds}, text string, n_chars bigint")
