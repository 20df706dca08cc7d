"""A small tolerant HTML reader: elements and text of a page in order, as flat lists."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

#: Element names of HTML by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select option".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search "
    "section summary table tbody td tfoot th thead tr ul caption".split()
)
#: An element of the key is closed by the start of any of the values.
CLOSED_BY = {
    "p": BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}

# Quotes hold a value only behind an equals sign; elsewhere they are letters.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@dataclass
class Page:
    """Nodes in page order; node 0 is the page. Texts carry the node they stand in."""

    tag: list[str] = field(default_factory=lambda: ["#page"])
    parent: list[int] = field(default_factory=lambda: [-1])
    attributes: list[str] = field(default_factory=lambda: [""])
    texts: list[tuple[int, str]] = field(default_factory=list)  # (node, decoded text); "" breaks a block


class _Open:
    """The open elements, with the depths at which each name stands, so that nothing is searched for."""

    def __init__(self, page: Page):
        self.page = page
        self.nodes = [0]
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.bounds: list[int] = []  # blocks but paragraphs

    def push(self, node: int) -> None:
        name, depth = self.page.tag[node], len(self.nodes)
        self.nodes.append(node)
        self.depths.setdefault(name, []).append(depth)
        if name in BLOCK:
            self.blocks.append(depth)
            if name != "p":
                self.bounds.append(depth)

    def last(self, *names: str) -> int:
        """Depth of the innermost open element of these names, 0 if there is none."""
        return max((self.depths[name][-1] for name in names if self.depths.get(name)), default=0)

    def cut(self, depth: int) -> None:
        """Close the element at this depth and all inside it."""
        broken = False
        for node in self.nodes[depth:]:
            name = self.page.tag[node]
            self.depths[name].pop()
            if name in BLOCK and not broken:
                self.page.texts.append((self.page.parent[node], ""))
                broken = True
        del self.nodes[depth:]
        for depths in (self.blocks, self.bounds):
            while depths and depths[-1] >= depth:
                depths.pop()

    def close(self, name: str) -> None:
        """An end tag. One that matches nothing is left out; an inline one doesn't close blocks."""
        depth = self.last(name)
        inline = name not in BLOCK and name != "a"
        if depth and not (inline and self.blocks and self.blocks[-1] > depth):
            self.cut(depth)

    def close_implied(self, name: str) -> None:
        """What the start of a block closes by itself."""
        if name not in BLOCK:
            return
        depth = self.last(*[tag for tag, by in CLOSED_BY.items() if name in by])
        bound = self.last(*SCOPE[name]) if name in SCOPE else (self.bounds[-1] if self.bounds else 0)
        if depth and depth >= bound:
            self.cut(depth)


def read(source: str) -> Page:
    """Elements and texts of a page. Unclosed, misnested and cut-off markup is read as far as it goes."""
    page = Page()
    stack = _Open(page)
    position = 0
    for match in _TOKEN.finditer(source):
        if match.start() < position:
            continue  # inside raw text
        if match.start() > position:
            page.texts.append((stack.nodes[-1], html.unescape(source[position : match.start()])))
        position = match.end()
        name = match[2]
        if name is None:
            continue
        name = name.lower()
        if match[1]:
            stack.close(name)
            continue
        stack.close_implied(name)
        node = len(page.tag)
        page.tag.append(name)
        page.parent.append(stack.nodes[-1])
        found = _ATTRIBUTE.findall(match[3]) if match[3] else ()
        page.attributes.append(" ".join(html.unescape(b or c or d) for _, b, c, d in found).lower())
        if name in BLOCK:
            page.texts.append((stack.nodes[-1], ""))
        elif name == "br":
            page.texts.append((stack.nodes[-1], " "))
        # Only foreign elements close themselves; a slash elsewhere means nothing.
        foreign = name in ("svg", "math") or stack.last("math")
        if name in VOID or (foreign and match[3].endswith("/")):
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(source, position)
            position = end.end() if end else len(source)
            continue
        stack.push(node)
    rest = source[position:]
    if rest and not re.match(r"</?[a-zA-Z!?]", rest):
        page.texts.append((stack.nodes[-1], html.unescape(rest)))
    return page
