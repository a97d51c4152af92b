"""Small field functions as columns: identifiers, dates as written, durations, search texts, names in addresses."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import matching, urls


def cik(value: Column) -> Column:
    """Digits padded with zeros to ten; null for anything but digits; longer ones stay as they are."""
    v = F.trim(value.cast("string"))
    return F.when(v.rlike(r"^\d+$"), F.when(F.length(v) >= 10, v).otherwise(F.lpad(v, 10, "0")))


def written_date(value: Column) -> Column:
    """A date as text is commonly written: ISO at its head, or month name, day, year; else null."""
    head = F.regexp_extract(value, r"^\s*(\d{4}-\d{2}-\d{2})", 1)
    return F.coalesce(F.nullif(head, F.lit("")).try_cast("date"), F.try_to_date(F.trim(value), "MMMM d, yyyy"), F.try_to_date(F.trim(value), "MMM d, yyyy"))


def duration(seconds: Column) -> Column:
    """Seconds as ``1h02m03s``, ``2m03s`` or ``3s``."""
    s = F.floor(seconds).cast("long")
    h, m, r = (s / 3600).cast("long"), (s % 3600 / 60).cast("long"), s % 60
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.when(h > 0, F.concat(h.cast("string"), F.lit("h"), two(m), F.lit("m"), two(r), F.lit("s"))).when(m > 0, F.concat(m.cast("string"), F.lit("m"), two(r), F.lit("s"))).otherwise(F.concat(r.cast("string"), F.lit("s")))


def span_class(start: Column, end: Column) -> Column:
    """The narrowest of day, week, month, year that holds a range: d, w, m, y, or null beyond a year."""
    n = F.datediff(end, start)
    return F.when(n <= 1, "d").when(n <= 7, "w").when(n <= 31, "m").when(n <= 366, "y")


def period_column(name: Column) -> tuple[Column, Column]:
    """(end date, kind) of a statement column such as ``2024-03-31 (Q1)``; kind is null without brackets, both null for other names."""
    pattern = r"^(\d{4}-\d{2}-\d{2})(?: \((Q[1-4]|YTD|FY)\))?$"
    return F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).try_cast("date"), F.nullif(F.regexp_extract(name, pattern, 2), F.lit(""))


def signature(roots: list[str], version: int) -> str:
    """Sixteen hexadecimal digits that change with the set of roots or the version."""
    return hashlib.sha256(json.dumps([sorted(roots), version]).encode()).hexdigest()[:16]


def search_texts(domain: Column, company: Column, ticker: Column, start: Column, end: Column) -> Column:
    """Texts to search one site for a company: one per year of a range, and one by name alone."""
    years = F.transform(F.sequence(F.year(start), F.year(end)), lambda y: F.concat(F.lit("site:"), domain, F.lit(" "), company, F.lit(" "), ticker, F.lit(" "), y.cast("string")))
    return F.concat(years, F.array(F.concat(F.lit("site:"), domain, F.lit(' "'), company, F.lit('"'))))


def full_name_present(company: Column, url: Column, title: Column) -> Column:
    """Whether the name without company forms, of four letters or more, stands in the address or title."""
    name = matching.normalized_name(company)
    plain = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " ")
    return (F.length(name) >= 4) & F.concat(F.lit(" "), plain(url), F.lit(" "), plain(title), F.lit(" ")).contains(F.concat(F.lit(" "), name, F.lit(" ")))


def slug_present(company: Column, url: Column) -> Column:
    """Whether a spelling of the name is a whole part of the path, as slugs are written, with or without a final ``s``."""
    path = F.concat(F.lit("-"), F.regexp_replace(F.lower(urls.part(url, 3)), "[^a-z0-9]+", "-"), F.lit("-"))
    forms = F.transform(matching.loose_forms(company), lambda f: F.replace(f, F.lit(" "), F.lit("-")))
    return F.exists(forms, lambda f: path.contains(F.concat(F.lit("-"), f, F.lit("-"))) | path.contains(F.concat(F.lit("-"), f, F.lit("s-"))))


def symbol_on_cover(text: Column, ticker: Column, window: int = 900) -> Column:
    """Whether a ticker stands within ``window`` characters after "trading symbol" on a cover page; null without that phrase."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?s)<[^>]+>", " "), r"&(?:#160|nbsp);", " ")
    at = F.position(F.lit("trading symbol"), F.lower(bare))
    near = matching.edges(F.substr(bare, at, F.lit(window)))
    return F.when(at > 0, near.contains(F.concat(F.lit(" "), ticker, F.lit(" "))))


#: fixed values: what to search a site for, per year and once per company
SEARCHES = {
    "cnbc.com": (("site:cnbc.com {ticker} {year}",), ("site:cnbc.com {company} stock news",)),
    "ft.com": (("site:ft.com {ticker} {year}", 'site:ft.com "{company}" {year}'), ()),
    "investing.com": (("site:investing.com/news {ticker} {year}", 'site:investing.com/news "{company}" {year}'), ()),
    "nasdaq.com": (("site:nasdaq.com/articles {ticker} {year}",), ()),
    "seekingalpha.com": (("site:seekingalpha.com/article {ticker} {year}",), ('site:seekingalpha.com "{ticker}" analysis',)),
    "stocktwits.com": (("site:stocktwits.com {ticker} {year}",), ()),
    "finance.yahoo.com": (("site:finance.yahoo.com {ticker} news {year}",), ()),
}


def site_searches(site: str, company: Column, ticker: Column, start: Column, end: Column) -> Column:
    """The searches of one known site as an array, years first."""
    yearly, once = SEARCHES[site]
    fill = lambda text, year: F.replace(F.replace(F.replace(F.lit(text), F.lit("{company}"), company), F.lit("{ticker}"), ticker), F.lit("{year}"), year)
    years = F.flatten(F.transform(F.sequence(F.year(start), F.year(end)), lambda y: F.array(*[fill(t, y.cast("string")) for t in yearly])))
    return F.concat(years, F.array(*[fill(t, F.lit("")) for t in once])) if once else years
