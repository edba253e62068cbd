"""Small per-page helper: a tag tree and the CSS selector forms the sources use.

Supported: ``tag``, ``.class``, ``#id``, ``[a]``, ``[a=v] [a^=v] [a$=v] [a*=v]``, ``:nth-of-type(n)``,
and the descendant and child combinators. Anything else is rejected when a selector is parsed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
    "nav ol p pre section table ul".split()
)
# An opening tag ends an open element of the named kinds, up to the nearest listed container.
_ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
} | {tag: ({"p"}, {"td", "th", "li", "div", "article", "section", "table"}) for tag in CLOSES_P}


class Node:
    """An element; ``content`` holds its text pieces and child elements in order, ``nth`` its number among equal tags."""

    __slots__ = ("tag", "attrs", "parent", "content", "nth", "counts")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent, self.content, self.nth, self.counts = tag, attrs, parent, [], 1, {}
        if parent is not None:
            self.nth = parent.counts[tag] = parent.counts.get(tag, 0) + 1

    def elements(self) -> Iterator[Node]:
        """All elements below, in document order."""
        stack = [c for c in reversed(self.content) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.content) if isinstance(c, Node))

    def texts(self) -> Iterator[str]:
        """Text pieces of the element and everything below it, scripts and styles left out."""
        stack = list(reversed(self.content))
        while stack:
            piece = stack.pop()
            if isinstance(piece, str):
                yield piece
            elif piece.tag not in ("script", "style"):
                stack.extend(reversed(piece.content))

    def text(self) -> str:
        return "".join(piece.strip() for piece in self.texts())

    def own_texts(self) -> list[str]:
        return [piece for piece in self.content if isinstance(piece, str)]


class _TreeBuilder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        ended, containers = _ENDS.get(tag, ((), ()))
        node = self.here
        while ended and node.parent is not None and node.tag not in containers:
            if node.tag in ended:
                self.here = node.parent
            node = node.parent
        values: dict[str, str] = {}
        for name, value in attrs:
            values.setdefault(name, value or "")
        child = Node(tag, values, self.here)
        self.here.content.append(child)
        if tag not in VOID:
            self.here = child

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        node = self.here
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.here = node.parent

    def handle_data(self, data: str) -> None:
        content = self.here.content
        if content and isinstance(content[-1], str):
            content[-1] += data
        else:
            content.append(data)

    def handle_comment(self, data: str) -> None:
        self.here.content.append("")  # keeps the text on both sides apart


def parse_page(html: str | None) -> Node:
    """Tag tree of a page; incomplete markup is accepted."""
    builder = _TreeBuilder()
    builder.feed(html or "")
    builder.close()
    return builder.root


_SIMPLE = re.compile(
    r"\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)|:nth-of-type\((?P<nth>\d+)\)"
    r"|\[(?P<attr>[\w-]+)(?:(?P<op>[\^$*]?=)(?P<quote>['\"]?)(?P<value>[^\]'\"]*)(?P=quote))?\]"
)
_TESTS = {
    None: lambda have, want: True,
    "=": lambda have, want: have == want,
    "^=": lambda have, want: have.startswith(want) and want != "",
    "$=": lambda have, want: have.endswith(want) and want != "",
    "*=": lambda have, want: want in have and want != "",
}


@lru_cache(maxsize=1024)
def parse_selector(selector: str) -> tuple[tuple[str, str | None, tuple], ...]:
    """Steps ``(combinator, tag, conditions)`` of a selector; ValueError for an unsupported form."""
    tokens = re.findall(r"\s*>\s*|\s+|[^\s>\[]*(?:\[[^\]]*\][^\s>\[]*)+|[^\s>\[]+", selector.strip())
    steps, combinator = [], " "
    for token in tokens:
        if not token.strip() or token.strip() == ">":
            if not steps or combinator == ">":
                raise ValueError(f"unsupported selector: {selector!r}")
            combinator = token.strip() or combinator or " "
            continue
        tag = re.match(r"[A-Za-z][\w-]*|\*", token)
        rest, conditions = token[tag.end() if tag else 0 :], []
        while rest:
            found = _SIMPLE.match(rest)
            if not found:
                raise ValueError(f"unsupported selector: {selector!r}")
            conditions.append(tuple(found.groupdict().items()))
            rest = rest[found.end() :]
        name = tag.group().lower() if tag and tag.group() != "*" else None
        steps.append((combinator, name, tuple(conditions)))
        combinator = " "
    if not steps or re.search(r">\s*$", selector):
        raise ValueError(f"unsupported selector: {selector!r}")
    return tuple(steps)


def _holds(node: Node, condition: tuple) -> bool:
    c = dict(condition)
    if c["cls"]:
        return c["cls"] in node.attrs.get("class", "").split()
    if c["id"]:
        return node.attrs.get("id") == c["id"]
    if c["nth"]:
        return node.nth == int(c["nth"])
    return c["attr"] in node.attrs and _TESTS[c["op"]](node.attrs[c["attr"]], c["value"])


def _matches(node: Node, steps: tuple) -> bool:
    combinator, tag, conditions = steps[-1]
    if (tag and node.tag != tag) or not all(_holds(node, c) for c in conditions):
        return False
    if len(steps) == 1:
        return True
    above = node.parent
    while above is not None and above.parent is not None:
        if _matches(above, steps[:-1]):
            return True
        if combinator == ">":
            return False
        above = above.parent
    return False


def select(node: Node, selector: str) -> Iterator[Node]:
    """Elements below ``node`` that match, in document order."""
    steps = parse_selector(selector)
    return (found for found in node.elements() if _matches(found, steps))


def select_one(node: Node, selector: str) -> Node | None:
    return next(select(node, selector), None)
