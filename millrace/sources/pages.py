"""Readers of what sites publish: sitemaps, feeds, archive indexes, tables of pages, lists of companies.

Each takes a DataFrame with the raw text, so that any file source can feed it, and gives typed rows. Text that can't
be parsed gives no rows; it is reported by ``unreadable`` where a reader says so.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize


def lenient_date(text: Column) -> Column:
    """The date as written at the head of a text (``yyyy-MM-dd...`` or ``yyyy-MM``), else null; no zone is applied."""
    t = F.trim(text)
    whole = F.regexp_extract(t, r"^(\d{4}-\d{2}-\d{2})(?:$|[T ])", 1)
    month = F.regexp_extract(t, r"^(\d{4}-\d{2})$", 1)
    return F.coalesce(F.nullif(whole, F.lit("")).try_cast("date"), F.when(month != "", F.concat(month, F.lit("-01"))).try_cast("date"))


def in_range_or_undated(day: Column, start: str, end: str) -> Column:
    return day.isNull() | day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1].lower()


def _xml(text: str | None):
    """The root of a document, or None; documents that declare entities are refused."""
    if not text or "<!ENTITY" in text or "<!DOCTYPE" in text:
        return None
    try:
        return ET.fromstring(text.strip())
    except ET.ParseError:
        return None


def _find(node, *names: str) -> str | None:
    for x in node.iter():
        if x is not node and _local(x.tag) in names and (x.text or "").strip():
            return x.text.strip()
    return None


def _rows_of(df: DataFrame, key: str, text: str, parse, schema: str) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(k, *row) for k, t in zip(pdf[key], pdf[text]) for row in parse(t)], columns=names)

    return df.select(key, text).mapInPandas(run, schema)


def _sitemap(text):
    root = _xml(text)
    if root is None:
        return
    kind = "index" if _local(root.tag) == "sitemapindex" else "url"
    for node in root:
        if _local(node.tag) in ("sitemap", "url"):
            loc = next((x.text.strip() for x in node if _local(x.tag) == "loc" and (x.text or "").strip()), None)
            if loc:
                yield kind, loc, _find(node, "lastmod", "publication_date"), _find(node, "title")


def sitemap(files: DataFrame, start: str, end: str, key: str = "path", text: str = "value") -> DataFrame:
    """(path, kind, loc, lastmod, title): children of an index that may hold entries since ``start``, and entries
    of a leaf in the range or without a date. A date that can't be read is no reason to leave a row out."""
    rows = _rows_of(files, key, text, _sitemap, f"{key} string, kind string, loc string, lastmod_text string, title string").withColumn("lastmod", lenient_date(F.col("lastmod_text"))).drop("lastmod_text")
    since = F.col("lastmod").isNull() | (F.col("lastmod") >= F.lit(start).cast("date"))
    return rows.filter(F.when(F.col("kind") == "index", since).otherwise(in_range_or_undated(F.col("lastmod"), start, end)))


def crawl(roots: list[str], pages: DataFrame, start: str, end: str) -> DataFrame:
    """Entries of all leaves that ``roots`` lead to, from fetched ``pages`` (path, value), however deep; every page is visited once."""
    spark = pages.sparkSession
    frontier = materialize(spark.createDataFrame([(r,) for r in roots], "path string").distinct(), "frontier")
    visited, found = frontier, None
    while not frontier.isEmpty():
        rows = materialize(sitemap(pages.join(frontier, "path", "left_semi"), start, end), "sitemaps")
        leaves = rows.filter("kind = 'url'")
        found = leaves if found is None else found.unionByName(leaves)
        frontier = materialize(rows.filter("kind = 'index'").select(F.col("loc").alias("path")).distinct().join(visited, "path", "left_anti"), "frontier")
        visited = visited.unionByName(frontier)
    found = found if found is not None else sitemap(pages.limit(0), start, end)
    return found.select("loc", "lastmod", "title").distinct()


def _feed(text):
    root = _xml(text)
    if root is None:
        return
    for node in root.iter():
        if _local(node.tag) in ("item", "entry"):
            link = next((x.get("href") or (x.text or "").strip() for x in node if _local(x.tag) == "link" and (x.get("href") or (x.text or "").strip())), None)
            if link:
                yield link, _find(node, "pubdate", "published", "updated"), _find(node, "title")


def feed(files: DataFrame, key: str = "path", text: str = "value") -> DataFrame:
    """(path, link, published, title) of RSS and Atom entries with a link."""
    return _rows_of(files, key, text, _feed, f"{key} string, link string, published string, title string")


def archive_index(files: DataFrame, text: str = "value") -> DataFrame:
    """(original, day) from an archive's JSON list of rows: the header row and short rows are skipped."""
    rows = files.select(F.posexplode(F.from_json(text, "array<array<string>>")).alias("i", "r")).filter((F.col("i") > 0) & (F.size("r") >= 2))
    return rows.select(F.col("r")[1].alias("original"), F.try_to_date(F.substring(F.col("r")[0], 1, 8), "yyyyMMdd").alias("day"))


class _Table(HTMLParser):
    """Cells of the table with a given id, row by row; of any table if no id is given."""

    def __init__(self, wanted: str | None) -> None:
        super().__init__()
        self.wanted, self.depth, self.rows, self.cell = wanted, 0, [], None

    def handle_starttag(self, tag, attrs) -> None:
        if tag == "table" and (self.depth or self.wanted in (None, dict(attrs).get("id"))):
            self.depth += 1
        elif self.depth == 1 and tag == "tr":
            self.rows.append([])
        elif self.depth == 1 and tag in ("td", "th") and self.rows:
            self.cell = []

    def handle_endtag(self, tag) -> None:
        if tag == "table" and self.depth:
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data) -> None:
        if self.cell is not None:
            self.cell.append(data)


def html_rows(html: str | None, table_id: str | None) -> list[list[str]]:
    if not html:
        return []
    parser = _Table(table_id)
    parser.feed(html)
    return parser.rows


#: fixed values: columns of the constituents table, in their places
CONSTITUENTS = ("symbol", "security", "gics_sector", "gics_sub_industry", "hq_location", "date_added", "cik", "founded")


def constituents(pages: DataFrame, key: str = "path", text: str = "value", table_id: str = "constituents") -> DataFrame:
    """Rows of a constituents table by cell position; rows with fewer cells or no symbol are skipped, symbols upper case."""

    def parse(html):
        for cells in html_rows(html, table_id)[1:]:
            if len(cells) >= len(CONSTITUENTS) and (symbol := cells[0].strip("| ").upper()):
                yield (symbol, *cells[1 : len(CONSTITUENTS)])

    return _rows_of(pages, key, text, parse, f"{key} string, " + ", ".join(f"{c} string" for c in CONSTITUENTS))


def by_header(pages: DataFrame, wanted: dict[str, str], key: str = "path", text: str = "value", table_id: str | None = None) -> DataFrame:
    """Columns ``wanted`` (name -> header) of a page's table, found by the names in its first row: rows without the first of them are skipped, columns that the table lacks are null."""
    names = list(wanted)

    def parse(html):
        rows = html_rows(html, table_id)
        at = {h: k for k, h in enumerate(rows[0])} if rows else {}
        for cells in rows[1:]:
            got = [cells[at[wanted[n]]] if wanted[n] in at and at[wanted[n]] < len(cells) else None for n in names]
            if got[0]:
                yield tuple(got)

    return _rows_of(pages, key, text, parse, f"{key} string, " + ", ".join(f"{n} string" for n in names))


def change_log(pages: DataFrame, key: str = "path", text: str = "value", table_id: str = "changes") -> DataFrame:
    """(ordinal, effective_date, added_ticker, added_security, removed_ticker, removed_security, reason): two header rows
    are skipped, as are rows without a readable date or without either ticker."""

    def parse(html):
        for n, cells in enumerate(html_rows(html, table_id)[2:]):
            if len(cells) >= 5 and (cells[1] or cells[3]):
                yield n, cells[0], cells[1].upper(), cells[2], cells[3].upper(), cells[4], cells[5] if len(cells) > 5 else ""

    rows = _rows_of(pages, key, text, parse, f"{key} string, ordinal long, day string, added_ticker string, added_security string, removed_ticker string, removed_security string, reason string")
    return rows.withColumn("effective_date", F.try_to_date("day", "MMMM d, yyyy")).filter("effective_date IS NOT NULL").drop("day")


#: fixed values: wiki marks that a cell loses, in order
_WIKI = [(r"<ref[^>]*/>", ""), (r"<ref[^>]*>.*?</ref>", ""), (r"<!--.*?-->", ""), (r"\{\{[^{}|]*\|([^{}|]*)(?:\|[^{}]*)?\}\}", r"\1"), (r"\{\{[^{}]*\}\}", ""), (r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", r"\1"), (r"\[https?://\S+ ([^\]]*)\]", r"\1"), (r"'{2,}", ""), (r"<[^>]+>", ""), (r"&nbsp;", " ")]


def wiki_cell(cell: str) -> str:
    for pattern, to in _WIKI:
        cell = re.sub(pattern, to, cell, flags=re.S)
    return " ".join(cell.split())


def wiki_table(text: str | None) -> tuple[list[dict[str, str]], int]:
    """(rows by header name, rows dropped because their number of cells isn't the header's) of the first table in wikitext."""
    if not text or "{|" not in text:
        return [], 0
    body = text[text.index("{|") :].split("|}")[0].split("\n")[1:]
    header: list[str] = []
    rows: list[list[str]] = [[]]
    for line in body:
        if line.startswith("|-"):
            rows.append([])
        elif line.startswith("!"):
            header += [wiki_cell(c.split("|")[-1]) for c in re.split(r"!!|\n!", line[1:])]
        elif line.startswith("|"):
            rows[-1] += [wiki_cell(c) for c in line[1:].split("||")]
    full = [r for r in rows if r]
    good = [dict(zip(header, r)) for r in full if len(r) == len(header)]
    return good, len(full) - len(good)


def wiki_rows(pages: DataFrame, key: str = "path", text: str = "value") -> DataFrame:
    """(path, row_no, header, cell, dropped): the cells of each page's first wiki table, with how many of its rows were dropped."""

    def parse(t):
        rows, dropped = wiki_table(t)
        for n, row in enumerate(rows, 1):
            for header, cell in row.items():
                yield n, header, cell, dropped

    return _rows_of(pages, key, text, parse, f"{key} string, row_no int, header string, cell string, dropped int")


#: fixed values: headers of company lists
COMPANY_HEADERS = {"ticker": ("ticker", "Symbol"), "name": ("name", "Security", "Company"), "sector": ("sector", "GICS Sector")}


def companies(csv: DataFrame) -> DataFrame:
    """(ticker, name, sector) of a list whose headers may be any of the known ones; rows without ticker or name are dropped."""
    pick = lambda names: F.coalesce(*[F.nullif(F.trim(F.col(f"`{n}`")), F.lit("")) for n in names if n in csv.columns], F.lit(None).cast("string"))
    rows = csv.select(F.upper(pick(COMPANY_HEADERS["ticker"])).alias("ticker"), pick(COMPANY_HEADERS["name"]).alias("name"), pick(COMPANY_HEADERS["sector"]).alias("sector"))
    return rows.filter("ticker IS NOT NULL AND name IS NOT NULL")


def raw_entries(lines: DataFrame, text: str = "value") -> DataFrame:
    """(url, lastmod, title) from lines that each hold a JSON array of three; other lines are skipped."""
    a = F.from_json(text, "array<string>")
    return lines.select(a.alias("a")).filter(F.size("a") >= 1).select(F.get("a", F.lit(0)).alias("url"), F.get("a", F.lit(1)).alias("lastmod"), F.get("a", F.lit(2)).alias("title")).filter("url IS NOT NULL")


def before_first_older(messages: DataFrame, key: str, order: str, day: str, start: str, end: str) -> DataFrame:
    """Messages of a paged API as a reader meets them: those before the first that is older than ``start``, in the range."""
    from pyspark.sql import Window

    older = (F.col(day) < F.lit(start).cast("date")).cast("int")
    met = messages.withColumn("_stop", F.max(older).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
    return met.filter((F.coalesce("_stop", F.lit(0)) == 0) & F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date"))).drop("_stop")


def news(df: DataFrame) -> DataFrame:
    """(ticker, datetime, headline, summary, source, url, category): seconds since 1970 as ISO text in UTC, missing text empty."""
    at = F.date_format(F.timestamp_seconds("datetime"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return df.select("ticker", F.coalesce(at, F.lit("")).alias("datetime"), *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("headline", "summary", "source", "url", "category")])
