"""A small HTML tree: elements with their texts in page order, as forgiving as pages are careless."""

from __future__ import annotations

import re
from collections.abc import Iterable
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
UNSEEN = frozenset("head script style template noscript iframe object svg math canvas audio video map select textarea"
                   " button datalist option title noembed noframes dialog".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption"
                   " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search"
                   " section summary table tbody td tfoot th thead tr ul".split())
_CLOSES_P = BLOCKS - frozenset("body html caption td th tr tbody thead tfoot legend".split())
#: A start tag of the key ends open elements of its first set, looked for no further out than one of the second.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
_ENDS |= {"thead": _ENDS["tbody"], "tfoot": _ENDS["tbody"]}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SCOPE = frozenset("table td th caption button object html".split())
#: An everyday tag, or else any place where markup may begin. The bounds are those of the quick path alone: what exceeds
#: them is read by ``_Markup``.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]{0,60}+)(?=[\s/>])((?:[^>"']{1,100}+|"[^"]{0,200}+"|'[^']{0,200}+'){0,64}+)>"""
                  r"""|<(?=[a-zA-Z!?]|/[a-zA-Z])""")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
_PLAIN = re.compile(r"""[^>"']*+""")
_COMMENT_END = re.compile(r"--!?>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class Node:
    """An element: tag, raw attributes, parent's place (-1 for the root), depth, and what it holds in order: texts (str)
    and places of child elements (int)."""

    __slots__ = ("tag", "raw", "parent", "depth", "inside", "unseen")

    def __init__(self, tag: str, raw: str, parent: int, depth: int, unseen: bool):
        self.tag, self.raw, self.parent, self.depth, self.unseen = tag, raw, parent, depth, unseen
        self.inside: list[str | int] = []

    def attributes(self) -> dict[str, str]:
        return {k.lower(): unescape(a or b or c) for k, a, b, c in reversed(_ATTRIBUTE.findall(self.raw))}


class _Markup:
    """Ends of markup that the quick path leaves, each found in a time that adds up to the length of the page."""

    def __init__(self, html: str):
        self._html = html
        self._last = {mark: html.rfind(mark) for mark in (">", '"', "'", "]]>")}
        self._dead: set[int] = set()  # quotes that open on a way to no end

    def special(self, at: int) -> tuple[int, str]:
        """(end, text) of the comment, section or declaration at ``at``; end 0 if it is none."""
        html = self._html
        if html.startswith("<!--", at):
            if html.startswith((">", "->"), at + 4):
                return html.index(">", at) + 1, ""
            end = _COMMENT_END.search(html, at + 4)
            return (end.end() if end else len(html)), ""
        if html.startswith("<![CDATA[", at) and at + 9 <= self._last["]]>"]:
            end = html.index("]]>", at + 9)
            return end + 3, html[at + 9:end]
        return (html.index(">", at) + 1 if at < self._last[">"] else 0), ""

    def tag(self, at: int) -> tuple[int, str, str]:
        """(end, name, attributes) of the tag at ``at``; end 0 if no more tag ends. A quote that nothing closes is no
        quote: such a tag ends at the next ``>``."""
        if at > self._last[">"]:
            return 0, "", ""
        name = _NAME.match(self._html, at)
        end = self._quoted_end(name.end())
        if end < 0:
            end = self._html.index(">", name.end())
        return end + 1, name[1], self._html[name.end():end]

    def _quoted_end(self, at: int) -> int:
        html, passed = self._html, []
        while True:
            at = _PLAIN.match(html, at).end()
            mark = html[at:at + 1]
            if mark == ">":
                return at
            if not mark or at in self._dead or at >= self._last[mark]:
                self._dead.update(passed)
                return -1
            passed.append(at)
            at = html.index(mark, at + 1) + 1


class _Open:
    """The open elements, outermost first, with the places of each tag, of blocks and of scopes among them."""

    def __init__(self, nodes: list[Node]):
        self._nodes = nodes
        self.stack = [0]
        self._places: dict[str, list[int]] = {}

    def __contains__(self, tag: str) -> bool:
        return bool(self._places.get(tag))

    def _keys(self, tag: str) -> list[str]:
        return [tag, *(["#block"] if tag in BLOCKS else []), *(["#scope"] if tag in _SCOPE else [])]

    def push(self, node: int) -> None:
        for key in self._keys(self._nodes[node].tag):
            self._places.setdefault(key, []).append(len(self.stack))
        self.stack.append(node)

    def _nearest(self, keys: Iterable[str]) -> int:
        return max((self._places[k][-1] for k in keys if self._places.get(k)), default=0)

    def end(self, tags: Iterable[str], stop: Iterable[str]) -> bool:
        """End the innermost open element of ``tags`` and all inside it, unless one of ``stop`` stands in between."""
        place = self._nearest(tags)
        if not place or place < self._nearest(stop):
            return False
        self.cut(place)
        return True

    def cut(self, place: int) -> None:
        while len(self.stack) > place:
            for key in self._keys(self._nodes[self.stack.pop()].tag):
                self._places[key].pop()


def parse(html: str) -> list[Node]:
    """The elements in page order; the first is a root that holds all. Comments and declarations are left out.

    The time grows with the length of the page, however careless its markup.
    """
    nodes = [Node("#root", "", -1, 0, False)]
    opened, markup = _Open(nodes), _Markup(html)
    stack = opened.stack

    def text(part: str) -> None:
        if part:
            nodes[stack[-1]].inside.append(unescape(part) if "&" in part else part)

    begin = at = 0  # of the text not yet taken, and where markup is looked for
    while True:
        found = _TAG.search(html, at)
        if not found:
            text(html[begin:])
            return nodes
        start, section = found.start(), ""
        if found[2]:
            tag, raw, end = found[2], found[3], found.end()
        elif html[start + 1] in "!?":
            tag, raw, (end, section) = "", "", markup.special(start)
        else:
            end, tag, raw = markup.tag(start)
        if not end:  # nothing ends here: the sign is text
            at = start + 1
            continue
        text(html[begin:start])
        begin = at = end
        tag = tag.lower()
        if not tag:
            text(section)
            continue
        if html[start + 1] == "/":
            if tag in BLOCKS or tag in UNSEEN:
                ended = opened.end([tag] if tag not in _HEADINGS else _HEADINGS, ["#scope"])
            else:  # an inline end tag doesn't reach out of its block
                ended = opened.end([tag], ["#block"])
            if tag == "br" and not ended:
                text("\n")
            continue
        if tag in _CLOSES_P:
            opened.end(["p"], ["#scope"])
        if tag in _HEADINGS and nodes[stack[-1]].tag in _HEADINGS:
            opened.cut(len(stack) - 1)
        if tag in _ENDS:
            while opened.end(*_ENDS[tag]):
                pass
        if tag == "body":
            opened.end(["head"], [])
        if tag in ("html", "body") and tag in opened:
            continue
        parent = stack[-1]
        node = Node(tag, raw, parent, len(stack), nodes[parent].unseen or tag in UNSEEN)
        nodes.append(node)
        nodes[parent].inside.append(len(nodes) - 1)
        if tag == "br":
            node.inside.append("\n")
        if tag in VOID or (html[end - 2] == "/" and tag not in BLOCKS and tag not in _RAW):
            continue
        if tag in _RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            last = html.find(">", close.end()) if close else -1
            node.inside.append(html[at:close.start()] if last >= 0 else html[at:])
            begin = at = last + 1 if last >= 0 else len(html)
            continue
        opened.push(len(nodes) - 1)


def blocks(nodes: list[Node], keep: list[bool]) -> list[str]:
    """Texts of kept elements by block: white space runs become one space, ends are trimmed, empty blocks left out."""
    out: list[str] = []
    line: list[str] = []

    def close() -> None:
        if line:
            joined = " ".join("".join(line).split())
            if joined:
                out.append(joined)
            line.clear()

    work: list[tuple[int, int]] = [(0, 0)]
    while work:
        n, i = work.pop()
        node = nodes[n]
        if i == 0 and node.tag in BLOCKS:
            close()
        inside = node.inside
        while i < len(inside):
            part = inside[i]
            i += 1
            if isinstance(part, int):
                if not nodes[part].unseen:
                    work.append((n, i))
                    work.append((part, 0))
                    break
            elif keep[n]:
                line.append(part)
        else:
            if node.tag in BLOCKS:
                close()
    close()
    return out
