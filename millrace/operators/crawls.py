"""Sitemap entries and the log of crawls that saw them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import urls
from millrace.functions.timestamps import DAY_US


def latest_complete(crawls: DataFrame) -> DataFrame:
    """(domain, started_at, entries, range_start) of each domain's latest complete crawl."""
    done = crawls.filter("complete AND started_at IS NOT NULL")
    return done.groupBy("domain").agg(F.max(F.struct("started_at", "entries", "range_start")).alias("c")).select("domain", "c.started_at", "c.entries", "c.range_start")


def current_entries(entries: DataFrame, crawls: DataFrame) -> DataFrame:
    """Entries that the latest complete crawl of their domain saw."""
    last = latest_complete(crawls).select("domain", F.col("started_at").alias("_at"))
    return entries.join(last, "domain").filter(F.col("last_seen") == F.col("_at")).drop("_at")


def duplicates(entries: DataFrame) -> DataFrame:
    """(url, listed, lastmods, undated): canonical URLs listed more than once, with how many dates they carry."""
    g = entries.groupBy(urls.normalize(F.col("url")).alias("url")).agg(F.count("*").alias("listed"), F.count_distinct("lastmod").alias("lastmods"), F.max(F.col("lastmod").isNull()).alias("undated"))
    return g.filter("listed > 1")


def upsert(stored: DataFrame, seen: DataFrame) -> DataFrame:
    """``stored`` after a crawl: one row per (domain, url); an older crawl that ends last never sets ``last_seen`` back.

    The first sighting stays; date and title come from the newer of the two sightings.
    """
    keys = ["domain", "url"]
    both = stored.select(*keys, "lastmod", "title", "first_seen", "last_seen").unionByName(seen.select(*keys, "lastmod", "title", "first_seen", "last_seen"))
    g = both.groupBy(*keys).agg(F.max(F.struct("last_seen", "lastmod", "title")).alias("n"), F.min("first_seen").alias("first_seen"))
    return g.select(*keys, "n.lastmod", "n.title", "first_seen", "n.last_seen")


def retained(entries: DataFrame, now_us: int, days: int = 90) -> DataFrame:
    """Entries seen in the last ``days`` days."""
    return entries.filter(F.unix_micros("last_seen") >= F.lit(now_us - days * DAY_US))


def gaps(crawls: DataFrame) -> DataFrame:
    """(domain, crawls, complete, open, failures, latest_complete): the state of each domain's crawls."""
    return crawls.groupBy("domain").agg(
        F.count("*").alias("crawls"), F.count_if("complete").alias("complete"), F.count_if(F.col("finished_at").isNull()).alias("open"),
        F.coalesce(F.sum("failures"), F.lit(0)).cast("long").alias("failures"), F.max(F.when(F.col("complete"), F.col("started_at"))).alias("latest_complete"),
    )


#: Days that a crawl counts as fresh; minutes after which an open one is given up.
FRESH_DAYS, STALE_MINUTES = 7, 30


def policy(crawls: DataFrame, asked: DataFrame, now_us: int, force: bool = False) -> DataFrame:
    """What to do for each of ``asked`` (domain, start, signature): (domain, usable, refresh, crawl_start, busy, age_days).

    A crawl is a basis if it is complete and of the same signature. ``usable``: the latest complete crawl is one and covers the start;
    ``refresh``: it isn't, or is older than a week, or a crawl is forced; ``crawl_start``: a refresh never narrows what its basis covers;
    ``busy``: another crawl of the domain is open and not stale.
    """
    done = crawls.filter("complete AND started_at IS NOT NULL").groupBy("domain").agg(F.max(F.struct("started_at", "finished_at", "range_start", F.col("signature").alias("own"))).alias("c"))
    open_ = crawls.groupBy("domain").agg(F.coalesce(F.max(F.when(F.col("finished_at").isNull(), F.unix_micros("started_at"))) > now_us - STALE_MINUTES * 60_000_000, F.lit(False)).alias("busy"))
    rows = asked.join(done.select("domain", "c.*"), "domain", "left").join(open_, "domain", "left")
    same = F.coalesce(F.col("own") == F.col("signature"), F.lit(False))
    usable = same & F.coalesce(F.col("range_start") <= F.col("start"), F.lit(False))
    age = F.floor((F.lit(now_us) - F.unix_micros(F.coalesce("finished_at", "started_at"))) / F.lit(float(DAY_US))).cast("long")
    old = F.coalesce(F.lit(now_us) - F.unix_micros(F.coalesce("finished_at", "started_at")) > FRESH_DAYS * DAY_US, F.lit(True))
    start = F.when(same, F.least("start", "range_start")).otherwise(F.col("start"))
    return rows.select("domain", usable.alias("usable"), (~usable | old | F.lit(force)).alias("refresh"), start.alias("crawl_start"), F.coalesce("busy", F.lit(False)).alias("busy"), age.alias("age_days"))


def kept_crawls(crawls: DataFrame, now_us: int, days: int = 90) -> DataFrame:
    """Crawls started in the last ``days`` days, and each domain's latest complete one."""
    last = latest_complete(crawls).select("domain", F.col("started_at").alias("_last"))
    rows = crawls.join(last, "domain", "left")
    return rows.filter((F.unix_micros("started_at") >= F.lit(now_us - days * DAY_US)) | (F.col("started_at") == F.col("_last"))).drop("_last")


def cached_first(live: DataFrame, cached: DataFrame, start: str, end: str) -> DataFrame:
    """Entries of ``live`` (url, title) whose canonical URL ``cached`` (url, lastmod as a date) doesn't list in the range or undated: what the cache gives comes first. Each URL once, with its greatest title."""
    inside = F.col("lastmod").isNull() | F.col("lastmod").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    known = cached.filter(inside).select(urls.normalize(F.col("url")).alias("url")).distinct()
    return live.groupBy(urls.normalize(F.col("url")).alias("url")).agg(F.max("title").alias("title")).join(known, "url", "left_anti")
