"""Groups of CSS selectors, compiled once: candidates in the order in which they are written.

A candidate has compounds of a tag, ``#id``, ``.class`` and ``[attribute]`` tests (``=``, ``*=``,
``^=``, ``$=``), joined by blanks (inside) or ``>`` (right inside). Unlike in a browser the first
candidate that matches anything wins, not the one whose element comes first in the page.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from .page import Node

Test = Callable[["Node"], bool]

_PART = re.compile(r"""\#(?P<id>[\w-]+) | \.(?P<cls>[\w-]+) | \[\s*(?P<name>[\w:-]+)\s*(?:(?P<how>[*^$]?=)\s*(?P<q>["']?)(?P<value>[^\]]*?)(?P=q)\s*)?\]""", re.VERBOSE)
_COMPOUND = re.compile(r"(?P<tag>\*|[a-zA-Z][\w-]*)?(?P<parts>(?:#[\w-]+|\.[\w-]+|\[[^\]]*\])*)")
_HOW: dict[str, Callable[[str, str], bool]] = {"=": str.__eq__, "*=": lambda a, v: v in a, "^=": str.startswith, "$=": str.endswith}


def _compound(text: str) -> Test:
    m = _COMPOUND.fullmatch(text)
    if not text or not m:
        raise ValueError(f"no selector: {text!r}")
    tag, tests = m["tag"], []
    for p in _PART.finditer(m["parts"]):
        if p["id"]:
            tests.append(lambda n, v=p["id"]: n.attrs.get("id") == v)
        elif p["cls"]:
            tests.append(lambda n, v=p["cls"]: n.has(v))
        elif p["how"]:
            tests.append(lambda n, a=p["name"], f=_HOW[p["how"]], v=p["value"]: a in n.attrs and f(n.attrs[a], v))
        else:
            tests.append(lambda n, a=p["name"]: a in n.attrs)
    if sum(len(p[0]) for p in _PART.finditer(m["parts"])) != len(m["parts"]):
        raise ValueError(f"no selector: {text!r}")
    return lambda n: tag in (None, "*", n.tag) and all(t(n) for t in tests)


def _candidate(text: str) -> Test:
    """The test of a node and what is above it."""
    words = re.findall(r"(?:\[[^\]]*\]|[^\s>\[])+|>", text)
    spelt = "".join("".join(words).split()) == "".join(text.split())
    if not spelt or not words or words[0] == ">" or words[-1] == ">":
        raise ValueError(f"no selector: {text!r}")
    *above, last = [w if w == ">" else _compound(w) for w in words]

    def climbs(node: Node, rest: list) -> bool:
        if not rest:
            return True
        *rest, test = rest
        if test == ">":
            *rest, test = rest
            up = node.parent
            return up is not None and bool(up.tag) and test(up) and climbs(up, rest)
        up = node.parent
        while up is not None and up.tag:
            if test(up) and climbs(up, rest):
                return True
            up = up.parent
        return False

    return lambda n: last(n) and climbs(n, above)


class Group:
    """Candidates by priority. An empty group matches nothing."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.candidates = [_candidate(c.strip()) for c in text.split(",") if c.strip()]

    def first(self, scope: Node) -> Node | None:
        """The first element of the first candidate that has any."""
        return next(self._hits(scope), None)

    def all(self, scope: Node) -> list[Node]:
        """All elements of the first candidate that has any; candidates aren't united, which would count elements twice."""
        for test in self.candidates:
            if found := [n for n in scope.walk() if test(n)]:
                return found
        return []

    def _hits(self, scope: Node) -> Iterator[Node]:
        return (n for test in self.candidates for n in scope.walk() if test(n))


@functools.lru_cache(1024)
def group(text: str) -> Group:
    return Group(text)
