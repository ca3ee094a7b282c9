"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors,
discounted by link density. The best container is kept with those of its
siblings that score well, and its text is returned block by block.

Runs in Arrow batches: one linear scan of the markup builds a light tree, so
memory is bounded by one page and the work needs no shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names by their role in a page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object canvas audio video select noembed noframes xmp".split())
DROPPED = frozenset("nav header footer aside form head menu button dialog fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd div section article figcaption".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table menu body html article section div".split())
BOILERPLATE = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies"
    " footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo"
    " recommended related search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
#: Parts of a class name that tell how an element is laid out, not what it is.
LAYOUT = frozenset("has with is no page layout wrap wrapper container content main body post article entry".split())
BOILERPLATE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
KEPT = frozenset("html body article main".split())
#: Elements whose end tags end what is open inside them.
OUTER = BLOCKS | {"button"}

MARKUP = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/<>"']*)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/<>"']*)([^<>]*+)>|<[!?][^<>]*+>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$|["'])""", re.I)
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class _Node:
    __slots__ = ("tag", "parent", "main", "score", "chars", "linked", "end")

    def __init__(self, tag: str, parent: int, main: bool):
        self.tag, self.parent, self.main = tag, parent, main
        self.score = 0.0
        self.chars = self.linked = 0
        self.end = -1


def _named(value: str) -> tuple[bool, bool]:
    """Whether a class or id names boilerplate, and whether reader comments."""
    boilerplate = comments = False
    for name in value.split():
        parts = set(WORDS.findall(CAMEL.sub(" ", name).lower()))
        comments |= not COMMENTS.isdisjoint(parts) and LAYOUT.isdisjoint(parts - {"post", "article", "entry"})
        boilerplate |= not BOILERPLATE.isdisjoint(parts) and LAYOUT.isdisjoint(parts)
    return boilerplate, comments


class _Tags:
    """Where each element of a page ends, found in one scan when it is first asked for.

    An element without an end tag ends where its parent does, or where a start tag closes it.
    """

    def __init__(self, html: str):
        self.ends: dict[int, int] = {}  # from behind a start tag to behind its end tag, or to what else ends it
        self.unclosed: set[int] = set()
        self.paragraphs: list[int] = []
        self.mains: list[int] = []
        self.bodies: list[int] = []
        stack: list[tuple[str, int]] = []
        outer: list[int] = []  # where blocks stand on the stack
        opened: Counter[str] = Counter()  # open elements by name, and inline ones since the last block began
        inline: list[Counter[str]] = [Counter()]

        def close(depth: int, end: int) -> None:
            for name, begun in reversed(stack[depth:]):
                self.ends[begun] = end
                self.unclosed.add(begun)
                opened[name] -= 1
                if name in OUTER:
                    inline.pop()
                    outer.pop()
                else:
                    inline[-1][name] -= 1
            del stack[depth:]

        at, size = 0, len(html)
        while at < size and (found := MARKUP.search(html, at)):
            at = found.end()
            closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                if (opened if tag in OUTER else inline[-1])[tag] > 0:
                    depth = len(stack) - 1
                    while stack[depth][0] != tag:
                        depth -= 1
                    begun = stack[depth][1]
                    close(depth, found.start())
                    self.ends[begun] = at
                    self.unclosed.discard(begun)
                elif tag == "body":
                    self.bodies.append(found.start())
                continue
            if tag in RAW:
                if not (attributes.endswith("/") and tag in ("svg", "math")):
                    at = _raw_end(html, at, tag)
                continue
            if stack and stack[-1][0] == "head" and (tag == "body" or tag in BLOCKS):
                close(len(stack) - 1, found.start())
            if tag in VOID or tag in ("html", "body") or attributes.endswith("/"):
                continue
            while tag in BLOCKS and outer and (stack[outer[-1]][0] == "p" or stack[outer[-1]][0] in CLOSES.get(tag, ())):
                close(outer[-1], found.start())  # what a start tag closes by itself
            if tag == "p":
                self.paragraphs.append(found.start())
            elif tag in ("article", "main"):
                self.mains.append(found.start())
            opened[tag] += 1
            if tag in OUTER:
                outer.append(len(stack))
                inline.append(Counter())
            else:
                inline[-1][tag] += 1
            stack.append((tag, at))

    def main_begins(self, at: int, end: int) -> int | None:
        """Where the first article or main element begins between two places, or the first paragraph if most of the page's lie there."""
        k = bisect_left(self.mains, at)
        if k < len(self.mains) and self.mains[k] < end:
            return self.mains[k]
        first = bisect_left(self.paragraphs, at)
        inside = bisect_left(self.paragraphs, end) - first
        return self.paragraphs[first] if inside >= 3 and 2 * inside > len(self.paragraphs) else None

    def holds_main(self, at: int) -> bool:
        """Whether an article or main element, or most paragraphs of the page, lie in the element that begins before `at`."""
        return self.main_begins(at, self.ends.get(at, at)) is not None

    def skip(self, at: int, tag: str, size: int) -> int:
        """Behind the end of the element that begins before `at`.

        One without an end tag ends with its parent, the body or the page, or, if its name alone drops it, where the
        main content begins in it; a mere container without a parent ends at once. A head, nav or header ends where an article or main element
        begins at the latest.
        """
        end = self.ends.get(at)
        unclosed = end is None or at in self.unclosed
        if end is None:
            end = size if tag not in ("div", "p", "section", "span", "ul", "li") else at
        body = bisect_left(self.bodies, at)
        if body < len(self.bodies):
            end = min(end, self.bodies[body])
        if unclosed and tag in DROPPED:
            begun = self.main_begins(at, end)
            return end if begun is None else begun
        main = bisect_left(self.mains, at)
        if tag in ("head", "nav", "header") and main < len(self.mains):
            end = min(end, self.mains[main])
        return end


@lru_cache(maxsize=len(RAW))
def _raw_pattern(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}[^<>]*+>", re.I)


def _raw_end(html: str, at: int, tag: str) -> int:
    ended = _raw_pattern(tag).search(html, at)
    return ended.end() if ended else len(html)


def _boilerplate(tag: str, attributes: str, holds_main: Callable[[], bool]) -> tuple[bool, bool]:
    """Whether an element is left out, and whether it is marked as the main content.

    Forms, and elements whose name or role speaks of boilerplate, stay if they hold the main content.
    """
    if tag in DROPPED:
        return tag not in ("form", "dialog", "fieldset") or not holds_main(), False
    if not attributes or attributes.isspace():
        return False, tag in ("article", "main")
    main = tag in ("article", "main")
    suspect = False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            if tag not in KEPT:
                return True, False
        elif name == "role" and value.lower() in BOILERPLATE_ROLES and tag not in KEPT:
            suspect = True
        elif name == "role" and value.lower() == "main" or name == "itemprop" and value.lower() == "articlebody":
            main = True
        elif name in ("class", "id") and tag not in KEPT:
            boilerplate, comments = _named(value)
            if comments:
                return True, False
            suspect |= boilerplate
    if suspect and not holds_main():
        return True, False
    return False, main


def extract(html: str | None) -> str:
    """The main text of one page; empty for null, empty or textless pages."""
    if not html:
        return ""
    nodes = [_Node("html", -1, False)]
    blocks: list[tuple[int, str, int]] = []  # node, text, linked characters
    stack: list[tuple[str, int]] = [("html", 0)]  # every open element; its block node, or -1 - node for an inline one
    pieces: list[str] = []
    linked = links = 0
    at, size, current = 0, len(html), 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append((current, text, linked))
            pieces.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal current, links
        for name, node in reversed(stack[depth:]):
            opened[name] -= 1
            if node >= 0:
                flush()
                nodes[node].end = len(blocks)
                current = nodes[node].parent
                inline.pop()
            else:
                inline[-1][name] -= 1
                links -= name == "a"
        del stack[depth:]

    def holds_main() -> bool:
        nonlocal tags
        tags = tags or _Tags(html)
        return tags.holds_main(at)

    tags: _Tags | None = None
    opened: Counter[str] = Counter()  # open elements by name, and inline ones since the last block began
    inline: list[Counter[str]] = [Counter()]
    search = MARKUP.search
    while at < size:
        found = search(html, at)
        stop = found.start() if found else size
        if stop > at:
            text = html[at:stop]
            if "&" in text:
                text = unescape(text)
            pieces.append(text)
            if links:
                linked += len(text.strip())
        if not found:
            break
        at = found.end()
        closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if (opened if tag in BLOCKS else inline[-1])[tag] > 0:  # an inline end tag does not close blocks
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                pop_to(depth)
            continue
        if tag in RAW:
            if attributes.endswith("/") and tag in ("svg", "math"):
                continue
            at = _raw_end(html, at, tag)
            pieces.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                pieces.append(" ")
            continue
        if tag in ("html", "body"):
            continue
        is_block = tag in BLOCKS
        if is_block and (opened["p"] > 0 or any(opened[c] > 0 for c in CLOSES.get(tag, ()))):
            for depth in range(len(stack) - 1, 0, -1):  # what a start tag closes by itself
                name, node = stack[depth]
                if name == "p" or name in CLOSES.get(tag, ()):
                    pop_to(depth)
                    break
                if node >= 0 and name in SCOPES:
                    break
        dropped, main = _boilerplate(tag, attributes, holds_main)
        if dropped and not attributes.endswith("/"):
            tags = tags or _Tags(html)
            at = tags.skip(at, tag, size)
            flush() if is_block else pieces.append(" ")
            continue
        if attributes.endswith("/") and not is_block:
            continue
        if is_block:
            flush()
            nodes.append(_Node(tag, current, main))
            current = len(nodes) - 1
            stack.append((tag, current))
            opened[tag] += 1
            inline.append(Counter())
            nodes[current].chars = -len(blocks) - 1  # where its blocks begin, until they are counted
        else:
            links += tag == "a"
            stack.append((tag, -1))
            opened[tag] += 1
            inline[-1][tag] += 1
    pop_to(1)
    flush()
    nodes[0].end = len(blocks)
    nodes[0].chars = -1
    return " ".join(_choose(nodes, blocks)) if blocks else ""


def _choose(nodes: list[_Node], blocks: list[tuple[int, str, int]]) -> list[str]:
    """The texts of the best container and of the siblings kept with it, in page order."""
    starts = [-node.chars - 1 for node in nodes]
    for node in nodes:
        node.chars = 0
        if node.end < 0:
            node.end = len(blocks)
    for at, text, linked in blocks:
        nodes[at].chars += len(text)
        nodes[at].linked += linked
    for node in reversed(nodes):  # a parent comes before its children
        if node.parent >= 0:
            nodes[node.parent].chars += node.chars
            nodes[node.parent].linked += node.linked
    for at, text, linked in blocks:
        if nodes[at].tag not in PARAGRAPHS and at:
            continue
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - min(1.0, linked / len(text)))
        up = at if nodes[at].tag in ("div", "section", "article", "html", "td") else nodes[at].parent
        level = 1
        while up >= 0 and level <= 4:
            nodes[up].score += points / level
            up, level = nodes[up].parent, level * 2 if level == 1 else level + 2
    density = [node.linked / node.chars if node.chars else 0.0 for node in nodes]
    value = [(node.score + 25 * node.main * (node.chars > 0)) * (1 - min(1.0, d)) for node, d in zip(nodes, density, strict=True)]
    best = max(range(len(nodes)), key=lambda i: (value[i], -i))
    up = best
    while up >= 0:  # an article is kept whole
        if nodes[up].main:
            best = up
        up = nodes[up].parent
    kept = {best}
    if nodes[best].parent >= 0:
        for i, node in enumerate(nodes):
            if node.parent == nodes[best].parent and i != best and node.chars:
                strong = value[i] >= max(10.0, 0.2 * value[best]) and density[i] < 0.5
                paragraph = node.tag == "p" and (node.chars > 80 and density[i] < 0.25 or node.chars <= 80 and not node.linked and not nodes[best].main)
                if strong or paragraph or node.tag in HEADINGS and not nodes[best].main:
                    kept.add(i)
    spans = sorted((starts[i], nodes[i].end) for i in kept)
    inside = [False] * len(blocks)
    for start, end in spans:
        inside[start:end] = [True] * (end - start)
    if nodes[best].parent >= 0 and not nodes[best].main:  # text that stands loose beside the container
        for k, (at, text, linked) in enumerate(blocks):
            if at == nodes[best].parent and not linked and len(text) > 80:
                inside[k] = True
    return [text for (_, text, _), keep in zip(blocks, inside, strict=True) if keep]


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(html) for html in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages`.

    Null or empty html gives an empty text and 0; a null id or url stays
    null; repeated rows are each extracted; of equally good containers the
    first is taken; pages of any length are read whole, in time in proportion
    to it; other columns are not read. An empty table gives no rows.
    """
    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInArrow(_extract_batches, schema)
