"""Pages as sequences of leaf blocks: text between block-level tags."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from html import unescape

# Content of these elements is never text of the page. Only the foreign ones, svg and
# math, may close themselves; names that go on (<svg-icon>) are other elements.
_RAW = {
    name: re.compile(rf"</{name}\s*>", re.I) for name in
    "script style noscript template svg iframe object canvas math".split()
}
_FOREIGN = frozenset(("svg", "math"))
# What ends with its first ">" or the page, the start of a tag, text. Nothing here
# looks at a character twice.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*+)"
    r"|(?P<text>[^<]++|<)",
    re.S,
)
# Attributes without < or > inside quotes, as nearly all are.
_ATTRIBUTES = re.compile(r"(?:\"[^\"<>]*+\"|'[^'<>]*+'|[^'\"<>])*+>")
_QUOTE_OR_END = re.compile(r"[\"'>]")
_NAMES = re.compile(
    r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I
)
_PART = re.compile(r"[a-z]+")

# Tags inside a line of text: they end no block.
_INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
_EMPTY = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# An opening tag closes an open one of these before it.
_CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
    "option": {"option"},
    **{h: {"p"} for h in "h1 h2 h3 h4 h5 h6 div ul ol dl table section article aside "
       "header footer nav form main blockquote pre figure hr".split()},
}
# Where looking for a tag to close ends.
_HOLDS = frozenset("ul ol dl table td th div section article aside main body form nav".split())


class Node:
    """An element that ends lines, known by its tag, its name parts and its parent.
    Equal paths are one node, so what is worked out for a path is kept in `memo`."""

    __slots__ = ("parent", "tag", "names", "depth", "children", "memo")

    def __init__(self, parent: Node | None, tag: str, names: tuple[str, ...]):
        self.parent, self.tag, self.names = parent, tag, names
        self.depth = parent.depth + 1 if parent else 0
        self.children: dict[tuple, Node] = {}
        self.memo: dict = {}

    def child(self, tag: str, names: tuple[str, ...]) -> Node:
        found = self.children.get((tag, names))
        if found is None:
            found = self.children[tag, names] = Node(self, tag, names)
        return found

    def worked_out(self, name: str, start, step):
        """`step(value of the parent, node)` from the root down, each node once."""
        chain, node = [], self
        while name not in node.memo:
            chain.append(node)
            if node.parent is None:
                break
            node = node.parent
        for node in reversed(chain):
            node.memo[name] = step(node.parent.memo[name], node) if node.parent else start
        return self.memo[name]

    def path(self) -> tuple[tuple[str, tuple[str, ...]], ...]:
        """(tag, name parts) of each element, outermost first."""
        out, node = [], self
        while node.parent is not None:
            out.append((node.tag, node.names))
            node = node.parent
        return tuple(reversed(out))


@dataclass(frozen=True)
class Block:
    """A leaf block: its text, its innermost element, and its linked characters."""

    text: str
    node: Node
    linked: int

    @property
    def path(self) -> tuple[tuple[str, tuple[str, ...]], ...]:
        return self.node.path()


class _Tags:
    """Where tags end, in time linear in the page, quotes balanced or not."""

    def __init__(self, html: str):
        self.html = html
        self.last = {c: html.rfind(c) for c in "\"'>"}
        # Scans that ran to the end of the page: where each was in or out of quotes.
        self.failed: list[tuple[list[int], list[str]]] = []

    def end(self, at: int) -> int:
        """Just behind the > that ends the tag whose name ends at `at`; -1 without one."""
        found = _ATTRIBUTES.match(self.html, at)
        return found.end() if found else self._scan(at)

    def _known(self, at: int, state: str) -> bool:
        """Whether a scan that failed was in this state here."""
        for places, states in self.failed:
            i = bisect_right(places, at) - 1
            if i >= 0 and states[i] == state:
                return True
        return False

    def _scan(self, at: int) -> int:
        places, states = [at], [""]
        while at <= self.last[">"] and not self._known(at, ""):
            mark = _QUOTE_OR_END.search(self.html, at)
            if mark is None:
                break
            if mark[0] == ">":
                return mark.end()
            inside = mark.end()
            if self.last[mark[0]] < inside or self._known(inside, mark[0]):
                break
            at = self.html.find(mark[0], inside) + 1
            places += [inside, at]
            states += [mark[0], ""]
        self.failed.append((places, states))
        return -1


def _names(attrs: str) -> tuple[str, ...]:
    if not attrs:
        return ()
    found = " ".join("".join(m) for m in _NAMES.findall(attrs)).lower()
    return tuple(_PART.findall(found))


def blocks(html: str | None, root: Node | None = None) -> list[Block]:
    """The leaf blocks of a page in order; blank ones are left out.

    Tags that are never closed, or closed twice, do no harm: a closing tag ends
    the innermost open element of its name, if there is one. A tag that has no end
    is text. `root` shares equal paths between pages. Time is linear in the page,
    whatever its nesting and quoting.
    """
    html = html or ""
    out: list[Block] = []
    # Open elements with the node of the block that they are in, how many are open of
    # each tag, in all and in each scope; a scope starts with a holding element.
    stack: list[tuple[str, Node]] = []
    root = root or Node(None, "", ())
    opened: Counter[str] = Counter()
    scopes: list[Counter[str]] = [Counter()]
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                node = stack[-1][1] if stack else root
                out.append(Block(text, node, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def pop_to(tags) -> None:
        """Close elements up to the innermost one of these tags."""
        while True:
            tag = stack.pop()[0]
            opened[tag] -= 1
            scopes[-1][tag] -= 1
            if tag in _HOLDS:
                scopes.pop()
            if tag in tags:
                return

    tags = _Tags(html)
    at = 0
    while at < len(html):
        found = _TOKEN.match(html, at)
        start, at = at, found.end()
        text, tag = found["text"], found["tag"]
        if tag is not None:
            end = tags.end(at)
            if end < 0:
                text, at = "<", start + 1
        if text is not None:
            pieces.append(text)
            if opened["a"]:
                linked += len(text.strip())
            continue
        if tag is None:
            continue
        attrs, at, tag = html[at : end - 1], end, tag.lower()
        if tag in _RAW and not found["end"]:
            if not (tag in _FOREIGN and attrs.endswith("/")):
                close = _RAW[tag].search(html, at)
                at = close.end() if close else len(html)
            continue
        if tag not in _INLINE:
            flush()
        elif tag == "br":
            pieces.append(" ")
        if found["end"]:
            if opened[tag]:
                pop_to((tag,))
        elif tag not in _EMPTY and not attrs.endswith("/"):
            closes = _CLOSES.get(tag, ())
            if any(scopes[-1][c] for c in closes):
                pop_to(closes)
            parent = stack[-1][1] if stack else root
            if tag in _HOLDS:
                scopes.append(Counter())
            stack.append((tag, parent if tag in _INLINE else parent.child(tag, _names(attrs))))
            opened[tag] += 1
            scopes[-1][tag] += 1
    flush()
    return out
