"""Elements of raw pages by ordered candidate selectors, in Arrow batches."""

from __future__ import annotations

from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..ddl import columns
from .urls import QA_SITE, Site, normalize_url

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ELEMENT = columns("text string, href string")


class Selector(NamedTuple):
    """An element by tag, class and attribute; null matches all."""

    tag: str | None = None
    css_class: str | None = None
    attribute: str | None = None

    def matches(self, tag: str, attrs: dict[str, str | None]) -> bool:
        return self.tag in (None, tag) and (self.css_class is None or self.css_class in (attrs.get("class") or "").split()) and (self.attribute is None or self.attribute in attrs)


class _Picker(HTMLParser):
    """The first element of each selector: its attributes and the text inside."""

    def __init__(self, selectors: tuple[Selector, ...]) -> None:
        super().__init__(convert_charrefs=True)
        self.selectors = selectors
        self.attrs: list[dict[str, str | None] | None] = [None] * len(selectors)
        self.pieces: list[list[str]] = [[] for _ in selectors]
        self.open: list[tuple[str, list[int]]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        named = dict(attrs)
        begun = [i for i, s in enumerate(self.selectors) if self.attrs[i] is None and s.matches(tag, named)]
        for i in begun:
            self.attrs[i] = named
        if tag not in VOID:
            self.open.append((tag, begun))

    def handle_endtag(self, tag: str) -> None:
        if any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data: str) -> None:
        if piece := data.strip():
            for _, begun in self.open:
                for i in begun:
                    self.pieces[i].append(piece)


def pick_element(html: str | None, selectors: tuple[Selector, ...]) -> tuple[str | None, str | None] | None:
    """(text, href) of the first selector that matches anything; a meta element's text is its content. Blank counts as null."""
    picker = _Picker(selectors)
    picker.feed(html or "")
    picker.close()
    for selector_attrs, pieces in zip(picker.attrs, picker.pieces):
        if selector_attrs is not None:
            text = "".join(pieces) or (selector_attrs.get("content") or "").strip()
            return text or None, (selector_attrs.get("href") or "").strip() or None
    return None


def css_pick(html: Column, *selectors: Selector) -> Column:
    """struct<text, href> by pick_element; null if no selector matches."""

    @F.pandas_udf(ELEMENT)
    def pick(pages: pd.Series) -> pd.DataFrame:
        rows = [pick_element(p, selectors) or (None, None) for p in pages]
        return pd.DataFrame(rows, columns=["text", "href"])

    return pick(html)


def card_fate(href: Column, site: Site = QA_SITE) -> Column:
    """``no_link``, ``not_content`` or ``kept``: what becomes of a search card with this link."""
    return F.when(href.isNull(), "no_link").when(normalize_url(href, site).isNull(), "not_content").otherwise("kept")
