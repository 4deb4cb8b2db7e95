"""A page as nodes with features, for the boosted trees of html_extract.

Tags are read by one regular expression; open elements close as browsers close them where that matters for text
(paragraphs, list items, cells). Nodes are elements; inline elements without attributes lend their text to the element
around them, and text beside other elements gets a node of its own, so that it can be judged alone. Only elements that
never hold text to read (SILENT) are skipped; a drawing that closes itself, or that an ordinary element ends, hides
nothing behind it. Time is linear in the page's length, however broken it is.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

#: Comments, also the empty ones that close at once; tags, in whose attributes a quote only opens a value behind "="; and what
#: else browsers skip: declarations, and tags that the page's end cuts off.
_TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)*+)>|<[a-zA-Z/!?][^>]*(?:>|\Z)""", re.S)
_VALUE_AT_END = re.compile(r"""=\s*+[^\s"'>][^\s>]*+\Z""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_ATTR = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop|aria-label|data-component)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style head template iframe select datalist title".split())
CLOSES_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that stand on lines of their own; all others, unknown ones too, lie inside a line.
BLOCKS = CLOSES_P | CLOSES.keys() | frozenset("html body tbody thead tfoot caption colgroup optgroup legend button textarea object video audio canvas noscript dialog search br hr".split())
#: Elements of other languages, which a slash at the end of their tag closes.
FOREIGN = frozenset("svg math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover semantics annotation".split())
WALLS = frozenset("html body div article section main td th table ul ol dl aside nav header footer form blockquote figure".split())
#: Walls for the elements that end one by themselves; rows and cells end one another across cells.
CELL_WALLS = WALLS - {"td", "th"}
#: Where skipping an element ends: behind its end tag, or before a tag that cannot be inside it.
_ENDS = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in SILENT}
_ENDS["head"] = re.compile(r"</head\b[^>]*>|(?=<body\b)", re.I)
_SVG_END = re.compile(r"</svg\b[^>]*>|(?=<(?:body|blockquote|br|center|code|dd|div|dl|dt|em|h[1-6]|hr|img|li|ol|p|pre|span|strong|table|ul|article|section|main)\b)", re.I)
#: What a drawing shows as text.
_SVG_TEXT = re.compile(r"<(text|foreignobject)\b[^>]*>(.*?)</\1\s*>", re.I | re.S)
TAGS = {t: i for i, ts in enumerate(("div section span body html center", "article main", "nav menu", "header", "footer", "aside", "form fieldset button label input textarea", "ul ol dl", "li dt dd", "p pre blockquote", "h1 h2 h3 h4 h5 h6", "table tbody thead tr td th", "#text")) for t in ts.split()}
N_TAGS = 14
#: What words in class, id and role attributes say.
TOKENS = {
    w: i
    for i, ws in enumerate((
        "article content post entry main story body text prose maincontent articlebody postbody",
        "nav menu navbar navigation breadcrumb breadcrumbs pagination pager tabs toc sitemap topnav",
        "header masthead banner branding logo topbar",
        "footer foot copyright colophon contentinfo",
        "sidebar aside widget widgets related recommended trending",
        "ad ads advert adverts advertisement sponsor sponsored promo promotion adsense dfp taboola outbrain",
        "cookie cookies notice consent gdpr popup modal overlay",
        "comment comments replies discussion disqus commentlist feedback",
        "form search login signup subscribe newsletter subscription register searchbox",
        "share social sharing follow toolbar byline",
        # words that an article's own parts have as often as what stands around it: alone they decide nothing
        "top side bottom rail more popular complementary legal alert message warning notification reply respond response responses contact tools meta tags author",
    ))
    for w in ws.split()
}
N_TOKENS = 11
N_BASE = 22
IN_TAGS = ("article", "nav", "footer", "header", "aside", "form")
N_FEATURES = N_BASE + N_TAGS + 2 * N_TOKENS + len(IN_TAGS)

_seen: dict[str, int] = {}


def _closes_itself(tag: str, attributes: str) -> bool:
    """Whether a slash ends the element at once: only in FOREIGN, and not where the slash belongs to a value without quotes."""
    return tag in FOREIGN and attributes.endswith("/") and not _VALUE_AT_END.search(attributes)


def _token_bits(attributes: str) -> int:
    """The groups of TOKENS that an element's attributes name, as bits."""
    bits = _seen.get(attributes)
    if bits is None:
        bits = 0
        for value in _ATTR.findall(attributes):
            for word in _WORD.findall(value):
                group = TOKENS.get(word.lower())
                if group is not None:
                    bits |= 1 << group
        if len(_seen) > 10000:
            _seen.clear()
        _seen[attributes] = bits
    return bits


class Node:
    __slots__ = ("tag", "parent", "depth", "bits", "above", "inside", "children", "chars", "links", "nodes", "paras", "para_chars", "points", "pieces", "anchors", "controls", "start", "end", "place")

    def __init__(self, tag: str, parent: Node | None, bits: int, start: int):
        self.tag, self.parent, self.bits, self.start = tag, parent, bits, start
        self.depth = parent.depth + 1 if parent else 0
        self.above = parent.above | parent.bits if parent else 0
        self.inside = parent.inside | (1 << IN_TAGS.index(tag) if tag in IN_TAGS else 0) if parent else 0
        if tag == "main":
            self.inside |= 1
        self.children: list[Node] = []
        self.chars = self.links = self.nodes = self.paras = self.para_chars = self.points = self.pieces = self.anchors = self.controls = 0
        self.end = start
        self.place = 0
        if parent:
            self.place = len(parent.children)
            parent.children.append(self)


class Open:
    """The open elements, (tag, node that its text belongs to, in a link), with the places of each tag and of walls."""

    def __init__(self, root: Node):
        self.stack: list[tuple[str, Node, bool]] = [("html", root, False)]
        self.at: dict[str, list[int]] = {}
        self.walls: list[int] = []
        self.cell_walls: list[int] = []

    def push(self, tag: str, node: Node, link: bool) -> None:
        place = len(self.stack)
        self.stack.append((tag, node, link))
        self.at.setdefault(tag, []).append(place)
        if tag in WALLS:
            self.walls.append(place)
            if tag in CELL_WALLS:
                self.cell_walls.append(place)

    def _cut(self, place: int) -> None:
        while len(self.stack) > place:
            tag = self.stack.pop()[0]
            self.at[tag].pop()
            if tag in WALLS:
                self.walls.pop()
                if tag in CELL_WALLS:
                    self.cell_walls.pop()

    def leave(self, tags: set[str], walls: list[int]) -> None:
        """Closes the innermost open element of these tags, if no wall stands before it."""
        place = max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)
        if place and (not walls or walls[-1] <= place):
            self._cut(place)

    def close(self, tag: str) -> None:
        """An end tag: of inline elements and paragraphs it doesn't reach over a wall."""
        place = self.at[tag][-1] if self.at.get(tag) else 0
        if place and not ((tag not in BLOCKS or tag == "p") and self.walls and self.walls[-1] > place):
            self._cut(place)


class Page:
    """nodes in page order, and the text as pieces (node number, break number, raw text)."""

    def __init__(self, source: str):
        root = Node("html", None, 0, 0)
        self.nodes, self.pieces = [root], []
        open_ = Open(root)
        stack = open_.stack
        self._at, self._breaks, self._added = 0, 0, False
        pos, n = 0, len(source)
        numbers = {id(root): 0}
        endless: set[str] = set()  # elements of which no end is left
        while pos < n:
            m = _TAG.search(source, pos)
            stop = m.start() if m else n
            if stop > pos:
                self._text(source[pos:stop], stack[-1], numbers)
            if not m:
                break
            pos = m.end()
            tag = m[2]
            if tag is None:
                continue
            tag = tag.lower()
            if m[1]:
                if tag in BLOCKS:
                    self._breaks += 1
                open_.close(tag)
                continue
            attributes = m[3]
            if tag in SILENT:
                if tag in endless:
                    continue
                end = _ENDS[tag].search(source, pos)
                if end:
                    pos = end.end()
                elif tag in ("script", "style"):
                    pos = n
                else:
                    endless.add(tag)
                continue
            if tag == "svg":
                end = None if tag in endless or _closes_itself(tag, attributes) else _SVG_END.search(source, pos)
                if end:
                    for shown in _SVG_TEXT.finditer(source, pos, end.start()):
                        self._breaks += 1
                        self._text(_TAG.sub("", shown[2]), stack[-1], numbers)
                        self._breaks += 1
                    pos = end.end()
                elif not _closes_itself(tag, attributes):
                    endless.add(tag)
                continue
            if tag in BLOCKS:
                self._breaks += 1
            if tag in VOID:
                if tag == "input":
                    stack[-1][1].controls += 1
                continue
            if tag in ("html", "body"):
                root.bits |= _token_bits(attributes)
                continue
            if tag in CLOSES_P:
                open_.leave({"p"}, open_.walls)
            elif tag in CLOSES:
                open_.leave(CLOSES[tag], open_.cell_walls if tag in ("tr", "td", "th") else open_.walls)
            link = stack[-1][2] or tag == "a"
            if tag not in BLOCKS and ("=" not in attributes or not _token_bits(attributes)):
                node = stack[-1][1]
                if tag == "a":
                    node.anchors += 1
            else:
                node = Node(tag, stack[-1][1], _token_bits(attributes) if "=" in attributes else 0, self._at)
                numbers[id(node)] = len(self.nodes)
                self.nodes.append(node)
                if tag == "a":
                    node.anchors += 1
                if tag in ("button", "textarea"):
                    node.controls += 1
            if not _closes_itself(tag, attributes):
                open_.push(tag, node, link)

    def _text(self, raw: str, top: tuple[str, Node, bool], numbers: dict[int, int]) -> None:
        _, node, link = top
        kept = raw.strip()
        if kept and node.tag in WALLS:
            if node.children and node.children[-1].tag == "#text" and node.children[-1].end == self._at:
                node = node.children[-1]
            else:
                node = Node("#text", node, 0, self._at)
                numbers[id(node)] = len(self.nodes)
                self.nodes.append(node)
        elif not kept and node.tag in WALLS and node.children and node.children[-1].tag == "#text":
            node = node.children[-1]
        self.pieces.append((numbers[id(node)], self._breaks, raw))
        if kept:
            n = len(kept)
            node.chars += n
            node.pieces += 1
            node.points += kept.count(".") + kept.count(",") + kept.count("?") + kept.count("!")
            if link:
                node.links += n
            self._at += n
            node.end = self._at

    def features(self) -> list[list[float]]:
        """A row of N_FEATURES numbers for each node."""
        return list(self.rows())

    def rows(self) -> Iterator[list[float]]:
        """features() one by one, so that a page of very many nodes doesn't need them all at once."""
        self._add_up()
        return map(self._row, self.nodes)

    def _add_up(self) -> None:
        """Sums of each node's subtree; once a page."""
        if self._added:
            return
        self._added = True
        for node in reversed(self.nodes):
            p = node.parent
            if node.tag == "p":
                node.paras += 1
                node.para_chars = max(node.para_chars, node.chars)
            if p:
                p.chars += node.chars
                p.links += node.links
                p.nodes += node.nodes + 1
                p.paras += node.paras
                p.para_chars += node.para_chars
                p.points += node.points
                p.pieces += node.pieces
                p.anchors += node.anchors
                p.controls += node.controls
                p.end = max(p.end, node.end)

    def _row(self, node: Node) -> list[float]:
        log, whole = math.log1p, max(1, self.nodes[0].chars)
        p = node.parent or node
        kin, chars = p.children, node.chars
        some = max(1, chars)
        before = kin[node.place - 1].chars if node.parent and node.place else 0
        after = kin[node.place + 1].chars if node.parent and node.place + 1 < len(kin) else 0
        row = [
            log(chars), node.links / some, chars / whole, log(chars / (node.nodes + 1)), log(node.paras), node.para_chars / some, node.points / some,
            log(chars / max(1, node.pieces)), node.depth, node.place, len(kin), node.place / max(1, len(kin)), chars / max(1, p.chars), p.links / max(1, p.chars), node.start / whole, node.end / whole,
            log(node.anchors), node.controls, log(before), log(after), len(node.children), p.paras / max(1, p.nodes),
        ]
        kinds = [0.0] * (N_TAGS + 2 * N_TOKENS + len(IN_TAGS))
        kinds[TAGS.get(node.tag, N_TAGS - 1)] = 1.0
        for g in range(N_TOKENS):
            if node.bits >> g & 1:
                kinds[N_TAGS + g] = 1.0
            if node.above >> g & 1:
                kinds[N_TAGS + N_TOKENS + g] = 1.0
        for g in range(len(IN_TAGS)):
            if node.inside >> g & 1:
                kinds[N_TAGS + 2 * N_TOKENS + g] = 1.0
        return row + kinds

    def decode(self, scores: list[float]) -> list[bool]:
        """Kept nodes: of all choices in which a kept node's ancestors are kept, the one with the largest sum of scores."""
        gain = list(scores)
        number = {id(node): i for i, node in enumerate(self.nodes)}
        for i in range(len(self.nodes) - 1, 0, -1):
            if gain[i] > 0:
                gain[number[id(self.nodes[i].parent)]] += gain[i]
        kept = [True] * len(self.nodes)  # the root always
        for i, node in enumerate(self.nodes[1:], 1):
            kept[i] = gain[i] > 0 and kept[number[id(node.parent)]]
        return kept

    def text(self, kept: list[bool]) -> str:
        out, last = [], -1
        for node, at, raw in self.pieces:
            if kept[node]:
                if at != last:
                    out.append(" ")
                    last = at
                out.append(html.unescape(raw) if "&" in raw else raw)
        return " ".join("".join(out).split())
