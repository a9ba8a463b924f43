"""Links, tables and indicators out of raw pages (JOB-1 to JOB-3)."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import absolute_url, capture, collapse

ANCHOR = r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"


def extract_links(pages: DataFrame, keywords: list[str] | None = None, suffixes: list[str] | None = None) -> DataFrame:
    """(page_id, pos, url, title) of each page's anchors, the first of each absolute URL of a page."""
    # pages are searched once, and the anchors found once more for their parts
    found = F.transform(F.regexp_extract_all("html", F.lit(ANCHOR), 0), lambda a: F.struct(F.regexp_extract(a, ANCHOR, 1).alias("href"), F.regexp_extract(a, ANCHOR, 2).alias("title")))
    links = pages.select("page_id", F.col("url").alias("base"), F.posexplode(found).alias("pos", "a"))
    links = links.select("page_id", "pos", absolute_url(F.trim("a.href"), F.col("base")).alias("url"), collapse(F.regexp_replace("a.title", "<[^>]*>", " ")).alias("title"))
    if suffixes:
        links = links.where(F.lower("url").rlike(f"({'|'.join(s.replace('.', '[.]') for s in suffixes)})$"))
    if keywords:
        links = links.where(F.exists(F.array(*(F.lit(k.lower()) for k in keywords)), lambda k: F.contains(F.lower("title"), k) | F.contains(F.lower("url"), k)))
    first = links.groupBy("page_id", "url").agg(F.min("pos").alias("pos"), F.min_by("title", "pos").alias("title"))
    return first.select("page_id", "pos", "url", "title")


class _Cells(HTMLParser):
    """Grids of a page's tables; a table within a cell adds its text to that cell."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.depth, self.cell = 0, None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.tables.append([])
        elif self.depth == 1 and tag == "tr":
            self._end()
            self.tables[-1].append([])
        elif self.depth == 1 and tag in ("td", "th"):
            self._end()
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.cell = []
        elif tag == "br" and self.cell is not None:
            self.cell.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.depth:
            if self.depth == 1:
                self._end()
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th", "tr"):
            self._end()

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)

    def _end(self) -> None:
        if self.cell is not None:
            self.tables[-1][-1].append("".join(self.cell).strip())
            self.cell = None


def _tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for page_id, html in zip(pdf["page_id"], pdf["html"], strict=True):
            parser = _Cells()
            parser.feed(html or "")
            parser.close()
            out += [(page_id, k, [r for r in grid if r]) for k, grid in enumerate(parser.tables)]
        yield pd.DataFrame(out, columns=["page_id", "table_no", "grid"])


def extract_html_tables(pages: DataFrame) -> DataFrame:
    """(page_id, table_no, grid) of every table; Python takes the cells out, all else stays Column work."""
    return pages.select("page_id", "html").mapInPandas(_tables, "page_id long, table_no int, grid array<array<string>>")


def text_indicators(docs: DataFrame, text: str, title: str, patterns: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """(keep..., year, one column for each indicator): the first pattern that matches; rows without any are dropped."""
    found = {name: F.coalesce(*(F.trim(capture(F.col(text), p)) for p in ps)) for name, ps in patterns.items()}
    year = capture(F.col(title), r"((?:19|20)[0-9]{2})")
    return docs.select(*keep, year.alias("year"), *(c.alias(n) for n, c in found.items())).where(F.coalesce(*(F.col(n) for n in found)).isNotNull())
