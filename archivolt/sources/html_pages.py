"""HTML predicates and extraction on Python's own parser, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class _Collector(HTMLParser):
    """Start tags, links and table rows of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags: list[tuple[str, dict]] = []
        self.rows: list[list[str]] = []
        self._cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        self.tags.append((tag, {k: v or "" for k, v in attrs}))
        if tag == "tr":
            self._end_cell()
            self.rows.append([])
        elif tag in ("td", "th"):
            self._end_cell()
            self._cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self._end_cell()

    def handle_data(self, data):
        if self._cell is not None:
            self._cell.append(data)

    def _end_cell(self):
        if self._cell is not None and self.rows:
            self.rows[-1].append("".join(self._cell).strip())
        self._cell = None


def parse(html: str | None) -> _Collector:
    out = _Collector()
    if html:
        out.feed(html)
        out.close()
        out._end_cell()
    return out


def has_element(html: Column, tag: str, attribute: str, value: str) -> Column:
    """Whether a page has the element with the attribute; a class matches as one of several (P22, X1). Null for null."""

    @F.pandas_udf("boolean")
    def run(pages: pd.Series) -> pd.Series:
        hit = lambda a: value in a.get(attribute, "").split() if attribute == "class" else a.get(attribute) == value
        return pages.map(lambda h: None if h is None else any(t == tag and attribute in a and hit(a) for t, a in parse(h).tags))

    return run(html)


def links(html: Column) -> Column:
    """Stripped targets of a page's anchors in order; anchors without a target are skipped."""

    @F.pandas_udf("array<string>")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: None if h is None else [a["href"].strip() for t, a in parse(h).tags if t == "a" and a.get("href")])

    return run(html)


def title(html: Column) -> Column:
    """Title of a page with its character references resolved, null without one."""

    @F.pandas_udf("string")
    def resolved(texts: pd.Series) -> pd.Series:
        from html import unescape

        return texts.map(lambda t: unescape(t) if t and "&" in t else t)

    return F.nullif(F.trim(resolved(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))), F.lit(""))


def table_rows(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, pos, cells) of all table rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(u, i, cells) for u, h in zip(b.url, b.html) for i, cells in enumerate(parse(h).rows)]
            yield pd.DataFrame(rows, columns=["url", "pos", "cells"])

    return pages.select(F.col(url).alias("url"), F.col(html).alias("html")).mapInPandas(run, "url string, pos int, cells array<string>")


def table_column(pages: DataFrame, index: int, least_cells: int, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct cells of one column of the pages' tables, header row left out, sorted."""
    rows = table_rows(pages, url, html).where((F.col("pos") > 0) & (F.size("cells") >= least_cells))
    return rows.select(F.get("cells", F.lit(index)).alias("value")).where("value <> ''").distinct().orderBy("value")
