"""Main text of a web page by composite text density.

Every element of the parsed page gets the characters of its text per tag, adjusted for text and tags of links. The
element whose children have the largest sum of densities marks the content. The sparsest element on the path from
there to the body sets the threshold: beside that path, blocks below it are left out, and in the others the content is
looked for in the same way, so that a text in several siblings is taken whole. An article element is never cut.
Elements that are no article text by their nature (menus, forms, scripts, adverts, comments of readers) carry no
characters, only tags. A word in a compound class or id is weaker evidence of that than a tag: it does not hold for an
element with the bulk of the page's text.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from eventloom.llm.common import arrow_schema, map_in_arrow, schema_of, slices

# Fixed values of the HTML language and of common page templates.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
NO_TEXT = frozenset(
    "nav footer aside form script style noscript iframe template button select option input textarea svg canvas "
    "object embed audio video head title menu dialog datalist map noembed noframes xmp".split()
)
PARAGRAPH_ENDERS = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
# What begins and ends a block; all other elements, unknown ones too, stand within a line.
BLOCKS = PARAGRAPH_ENDERS | frozenset(
    "html head body br li dt dd tr td th thead tbody tfoot caption colgroup center dir frameset hgroup legend listing "
    "noscript optgroup option plaintext search summary template title iframe script style select textarea button".split()
)
SAME_LEVEL = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CONTAINERS = frozenset("div section ul ol dl table center address details fieldset menu".split())
NO_TEXT_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer masthead topbar toolbar notice notices cookie cookies consent gdpr popup modal overlay "
    "newsletter subscribe signup login share sharing social related recommended comment comments disqus respond "
    "widget pagination pager".split()
)
READER_NAMES = frozenset("comment comments disqus respond".split())
# An element with a word of such a name in its class or id holds the text itself from this share of the page's; one that
# is called so as a whole is out at any share, unless there is no other text or it holds the article element.
WORD_IN_NAME = 0.5
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())

_OPEN = re.compile(r"(/?)([A-Za-z][^\s/>]*)")
# Quotes count after an equals sign only; elsewhere in a tag they are characters like any other.
_STOP = re.compile(r">|=\s*+([\"'])")
_ATTRIBUTE = re.compile(r"([A-Za-z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_NAME = re.compile(r"[a-z]+|[0-9]+")
# Names that say what a page has or lacks, and not what the element is.
_STATE = re.compile(r"(?:.*[-_])?(?:has|have|no|not|with|without)[-_].*|.*[-_](?:enabled|disabled)")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("best", "chars", "children", "density", "link_chars", "link_tags", "muted", "named", "parent", "sum", "tag", "tags")

    def __init__(self, tag: str, parent: Node | None, muted: bool) -> None:
        self.tag, self.parent, self.muted = tag, parent, muted
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0
        self.best = self
        # 1 for a name that says it is no article text, less for a word in a compound, 0 without such a name.
        self.named = 0.0


class _Tags:
    """Tags of a source, one after the other, in time that follows its length."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.unclosed: set[str] = set()

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start and end, slash, name and rest of the next tag; comments and declarations have no name."""
        source = self.source
        while True:
            start = source.find("<", at)
            if start < 0:
                return None
            if source.startswith("<!--", start):
                close = source.find("-->", start + 4)
                return start, close + 3 if close >= 0 else len(source), "", "", ""
            if source.startswith(("<!", "<?"), start):
                close = source.find(">", start)
                return start, close + 1 if close >= 0 else len(source), "", "", ""
            name = _OPEN.match(source, start + 1)
            if name:
                end = self._end(name.end())
                return start, min(end + 1, len(source)), name[1], name[2].lower(), source[name.end() : end]
            at = start + 1

    def _end(self, at: int) -> int:
        """Place of the sign that ends a tag, or the end of the source."""
        while True:
            stop = _STOP.search(self.source, at)
            if not stop:
                return len(self.source)
            quote, at = stop[1], stop.end()
            if not quote:
                return stop.start()
            # A quote without its fellow is a character; there is none further on either.
            close = -1 if quote in self.unclosed else self.source.find(quote, at)
            if close < 0:
                self.unclosed.add(quote)
            else:
                at = close + 1


def _is_muted(tag: str, rest: str, parent: Node) -> bool:
    if tag in NO_TEXT:
        return True
    if tag == "header" and parent.tag not in ("article", "main", "section"):
        return True
    if not rest or rest.isspace() or tag in ("body", "html", "main", "article"):
        return False
    for name, *values in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value.strip() in NO_TEXT_ROLES:
            return True
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _named(tag: str, rest: str, parent: Node) -> float:
    """``Node.named`` by class and id: a whole name is better evidence than a word inside a compound.

    A name that begins with readers' comments (comments-area) is as good as a whole one.
    """
    if not rest or rest.isspace() or tag in ("body", "html", "main", "article"):
        return 0.0
    names = [v for name, *values in _ATTRIBUTE.findall(rest) if name.lower() in ("class", "id") for v in "".join(values).lower().split()]
    words = [_NAME.findall(v) for v in names if not _STATE.fullmatch(v)]
    if not NO_TEXT_NAMES.isdisjoint(names) or any(w and w[0] in READER_NAMES for w in words):
        limit = 1.0
    elif any(not NO_TEXT_NAMES.isdisjoint(w) for w in words):
        limit = WORD_IN_NAME
    else:
        return 0.0
    # Highlighted code names its parts so: a comment there is code.
    up = parent if tag not in BLOCKS else None
    while up is not None:
        if up.tag in ("pre", "code"):
            return 0.0
        up = up.parent
    return limit


def parse(source: str) -> Node:
    """Tree of elements and texts under a root; end tags left out are supplied, stray ones ignored."""
    root = here = Node("", None, False)
    tags = _Tags(source)
    at, raw = 0, ""
    while True:
        if raw:
            close = re.compile(rf"</{raw}(?=[\s/>]|\Z)", re.I).search(source, at)
            end = close.start() if close else len(source)
            here.children.append(source[at:end])
            at, raw = end, ""
        found = tags.next(at)
        if not found:
            here.children.append(html.unescape(source[at:]))
            return root
        start, end, slash, tag, rest = found
        if start > at:
            here.children.append(html.unescape(source[at:start]))
        at = end
        if not tag:
            continue
        if slash:
            up = here
            while up.parent is not None and up.tag != tag:
                # A block's end does not reach through another block for an inline tag.
                if tag not in BLOCKS and up.tag in BLOCKS:
                    up = root
                    break
                up = up.parent
            if up.parent is not None:
                here = up.parent
            continue
        if tag in PARAGRAPH_ENDERS:
            up = here
            while up.parent is not None and (up.tag not in BLOCKS):
                up = up.parent
            if up.tag == "p":
                here = up.parent
        elif tag in SAME_LEVEL:
            up = here
            while up.parent is not None and up.tag not in SAME_LEVEL[tag] and up.tag not in SCOPES[tag]:
                up = up.parent
            while up.parent is not None and up.tag in SAME_LEVEL[tag]:
                up = up.parent
                here = up
        node = Node(tag, here, here.muted or _is_muted(tag, rest, here))
        node.named = 0.0 if node.muted else _named(tag, rest, here)
        here.children.append(node)
        if tag in VOID or rest.endswith("/") and tag not in RAW and tag in BLOCKS and tag not in PARAGRAPH_ENDERS:
            continue
        here = node
        if tag in RAW:
            raw = tag


def _elements(root: Node) -> list[Node]:
    """All elements, parents before children."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return order


def _silence(order: list[Node]) -> None:
    """Mute elements by their names, but for those that hold the bulk of the text; parents come before children."""
    if not any(node.named for node in order):
        return
    held: dict[int, int] = {}
    for node in reversed(order):
        own = 0 if node.muted else sum(len(_SPACE.sub("", c)) for c in node.children if isinstance(c, str))
        held[id(node)] = own + sum(held[id(c)] for c in node.children if not isinstance(c, str))
    every = held[id(order[0])]
    bearing = {id(up) for node in order if node.tag in ("article", "main") and not node.muted for up in _path(node, order[0])}
    for node in order:
        up = node.parent
        own = held[id(node)]
        whole = node.named == 1.0 and own < every and id(node) not in bearing
        if up is not None and up.muted or whole or node.named and own <= WORD_IN_NAME * every:
            node.muted = True


def measure(root: Node) -> list[Node]:
    """Counts, densities and density sums of all elements; parents before children in the returned list."""
    order = _elements(root)
    _silence(order)
    for node in reversed(order):
        own = 0 if node.muted else sum(len(_SPACE.sub("", c)) for c in node.children if isinstance(c, str))
        node.chars += own
        if node.tag == "a":
            node.link_chars = node.chars
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags + (node.tag == "a")
    for node in order:
        node.density = _density(node, root)
    for node in order:
        node.sum = sum(c.density for c in node.children if not isinstance(c, str))
    return order


def _density(node: Node, root: Node) -> float:
    """Characters per tag, scaled down the more of them are links: the base of the logarithm grows with the share of links."""
    if not node.chars:
        return 0.0
    tags, links, link_tags = max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
    plain = max(node.chars - node.link_chars, 1)
    base = math.log(node.chars / plain * node.link_chars + root.link_chars / max(root.chars, 1) * node.chars + math.e)
    ratio = node.chars / links * tags / link_tags
    return node.chars / tags * max(math.log(max(ratio, 1.0)) / math.log(max(base, 1.0 + 1e-9)) if base > 1 else math.log(max(ratio, 1.0)), 0.0)


def select(root: Node) -> Node:
    """The body, after all blocks that are not content were muted."""
    order = measure(root)
    body = next((n for n in order if n.tag == "body"), root)
    # The largest density sum of a subtree, of equal ones the first.
    for node in reversed(order):
        own = [c for c in node.children if not isinstance(c, str) and not c.muted]
        node.best = max([node, *(c.best for c in own)], key=lambda n: -1.0 if n.muted or n.tag not in BLOCKS else n.sum)
    if not body.best.sum:
        return body
    threshold = min(n.density for n in _path(body.best, body))
    stack = [(body, False)]
    while stack:
        top, whole = stack.pop()
        path = _path(top.best, top)
        keep = set(map(id, path))
        for node in reversed(path):
            if node.tag == "article":
                break
            whole = whole or node.tag == "main" or node is top.best
            dropped, at, after = set(), 0, 0
            for run in _runs(node):
                at, after = after, after + len(run)
                block = run[0] if len(run) == 1 and not isinstance(run[0], str) and run[0].tag in BLOCKS else None
                if block is None:
                    if not whole and keep.isdisjoint(map(id, run)) and _density(_joined(run), root) < threshold:
                        dropped.update(range(at, at + len(run)))
                elif id(block) in keep or block.muted or block.tag in HEADINGS or block.tag == "article":
                    continue
                elif block.density < threshold and (2 * block.link_chars > block.chars and block.tag in CONTAINERS or not whole):
                    block.muted = True
                else:
                    stack.append((block, whole))
            if dropped:
                node.children = [c for i, c in enumerate(node.children) if i not in dropped]
    return body


def _path(node: Node, top: Node) -> list[Node]:
    path = [node]
    while path[-1] is not top:
        path.append(path[-1].parent)
    return path


def _runs(node: Node) -> list[list[Node | str]]:
    """Children of ``node``: blocks by themselves, texts and inline elements between them together."""
    runs: list[list[Node | str]] = []
    open_run = False
    for child in node.children:
        loose = isinstance(child, str) or child.tag not in BLOCKS
        if loose and open_run:
            runs[-1].append(child)
        else:
            runs.append([child])
        open_run = loose
    return runs


def _joined(run: list[Node | str]) -> Node:
    """Counts of a run of texts and inline elements, as if an element held them."""
    made = Node("", None, False)
    for child in run:
        if isinstance(child, str):
            made.chars += len(_SPACE.sub("", child))
        else:
            made.chars += child.chars
            made.tags += child.tags + 1
            made.link_chars += child.link_chars
            made.link_tags += child.link_tags + (child.tag == "a")
    return made


def text_of(top: Node) -> str:
    """Texts of the subtree in page order; blocks are trimmed, their inner white space and the gaps between are one space."""
    pieces: list[str] = []
    stack: list[Node | str] = [top]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            pieces.append(item)
        elif not item.muted:
            split = item.tag in BLOCKS
            if split:
                pieces.append(" ")
                stack.append(" ")
            stack.extend(reversed(item.children))
    return _SPACE.sub(" ", "".join(pieces)).strip()


def extract(source: str | None) -> str:
    return text_of(select(parse(source))) if source else ""


PAGES = schema_of("page_id bigint, url string, text string, n_chars bigint")


def extract_pages(pages: DataFrame) -> DataFrame:
    """Main text of every page of ``pages`` (page_id, url, html).

    Null and empty pages have an empty text; so have pages with nothing but menus and the like. Repeated rows give a row
    each, other columns are left out. One pass, no shuffle; a page is parsed whole.
    """
    arrow = arrow_schema(PAGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices(batch.column(2)):
                part = batch.slice(start, end - start)
                texts = [extract(s) for s in part.column(2).to_pylist()]
                cols = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) if isinstance(c, list) else c.cast(f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return map_in_arrow(pages.select("page_id", "url", "html"), run, PAGES)
