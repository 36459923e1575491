"""Visible text of raw pages, by the standard library's parser in Arrow batches."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)

    def handle_data(self, data: str) -> None:
        if not self.hidden and (piece := data.strip()):
            self.pieces.append(piece)


def visible_text(html: str | None) -> str:
    """Tags stripped, pieces stripped and joined by line feeds; empty for null."""
    parser = _Text()
    parser.feed(html or "")
    parser.close()
    return "\n".join(parser.pieces)


@F.pandas_udf(T.StringType())
def html_to_text(html: pd.Series) -> pd.Series:
    return html.map(visible_text)
