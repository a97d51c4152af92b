"""Registered queries over stored state: holding articles back, classing anew, price rows, calendars, membership and crawl steps. Each stands beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import oracles as O
from millrace.functions import calendar
from millrace.operators import crawls, holds, labels, membership, prices, queue, reclass
from millrace.session import materialize
from millrace.sources.pages import lenient_date
from millrace.sources.tables import table

NOW_US = 1_767_139_200_000_000  # 2025-12-31 00:00 UTC
_TITLES = "titled_rows AS (SELECT d.*, a.title AS fetched FROM discovered_urls d LEFT JOIN articles a ON a.id = d.id)"


def _classes(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "discovered_urls").select("id", "match_class")


def quarantine_sync(s: SparkSession, d: str) -> DataFrame:
    """Articles after being held back or released."""
    return holds.synced(table(s, d, "articles"), _classes(s, d)).select("id", "fetch_status", "prev_fetch_status")


def quarantine_counts(s: SparkSession, d: str) -> DataFrame:
    """Held articles by the status they had, after syncing."""
    rows = holds.synced(table(s, d, "articles"), _classes(s, d)).filter("fetch_status = 'quarantined'")
    return rows.groupBy(F.coalesce("prev_fetch_status", F.lit("none")).alias("before")).agg(F.count("*").alias("n"))


def sync_forecast(s: SparkSession, d: str) -> DataFrame:
    return holds.sync_counts(table(s, d, "articles"), _classes(s, d))


def held_accepts(s: SparkSession, d: str) -> DataFrame:
    """Accepted pairs whose article is still held: before and after syncing."""
    a, c = table(s, d, "articles"), _classes(s, d)
    count = lambda rows, name: rows.join(c.filter("match_class = 'accept'"), "id", "left_semi").filter("fetch_status = 'quarantined'").agg(F.count("*").alias("n")).select(F.lit(name).alias("state"), "n")
    return count(a, "before").unionByName(count(holds.synced(a, c), "after"))


def fetch_marks(s: SparkSession, d: str) -> DataFrame:
    """The queue after the results of its fetched articles, by id."""
    a = table(s, d, "articles")
    results = a.select("id", F.col("http_status_code").alias("code"), F.when(F.col("http_status_code").isNull(), F.col("fetch_status")).alias("reason"))
    return holds.marked(table(s, d, "discovered_urls"), results).select("id", "status", F.coalesce("fetch_status_code", F.lit(-1)).alias("fetch_status_code"), F.coalesce("title", F.lit("-")).alias("title"))


def fetch_marks_by_url(s: SparkSession, d: str) -> DataFrame:
    """The queue after each address was marked for every ticker that has it: fetched if its last row was."""
    q = table(s, d, "discovered_urls")
    return holds.marked(q, q.select("url", F.coalesce("fetch_status_code", F.lit(599)).alias("code"), F.lit(None).cast("string").alias("reason")), "url").groupBy("domain", "status").agg(F.count("*").alias("n"))


def reevaluated_pairs(s: SparkSession, d: str) -> DataFrame:
    """Pairs that the fetched title promotes."""
    q = table(s, d, "discovered_urls")
    after = holds.reevaluated(q, table(s, d, "articles").select("id", "title"))
    return after.join(q.select("id", F.col("match_class").alias("_old")), "id").filter("match_class <> _old").select("id", "match_class", "match_reason")


def recorded_fetch(s: SparkSession, d: str) -> DataFrame:
    """Articles and pairs after all articles were recorded as freshly fetched."""
    a = table(s, d, "articles").dropDuplicates(["id"])
    q, saved = holds.recorded(table(s, d, "discovered_urls"), a.limit(0), a)
    pairs = q.groupBy(F.lit("pairs").alias("of"), F.coalesce("status", F.lit("none")).alias("status")).agg(F.count("*").alias("n"))
    return pairs.unionByName(saved.groupBy(F.lit("articles").alias("of"), F.coalesce("fetch_status", F.lit("none")).alias("status")).agg(F.count("*").alias("n")))


def _titled(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "articles").select("id", F.col("title").alias("_t"))
    rows = table(s, d, "discovered_urls").join(a, "id", "left")
    return rows.withColumn("title", F.coalesce(F.nullif("title", F.lit("")), F.col("_t"), F.lit(""))).drop("_t")


def reclass_audit(s: SparkSession, d: str) -> DataFrame:
    return reclass.promotions(_titled(s, d))


def reclass_applied(s: SparkSession, d: str) -> DataFrame:
    return reclass.applied(table(s, d, "discovered_urls"), reclass_audit(s, d)).select("id", "match_class", "match_reason", "status")


def reclass_reverted(s: SparkSession, d: str) -> DataFrame:
    """The queue after a run was written and taken back."""
    q, audit = table(s, d, "discovered_urls"), materialize(reclass_audit(s, d), "audit")
    return reclass.reverted(reclass.applied(q, audit), audit).select("id", "match_class", "match_reason", "status")


def reclass_report(s: SparkSession, d: str) -> DataFrame:
    return reclass.report(table(s, d, "discovered_urls"), table(s, d, "articles"), materialize(reclass_audit(s, d), "audit"))


def reclass_conditions(s: SparkSession, d: str) -> DataFrame:
    q, audit = table(s, d, "discovered_urls"), materialize(reclass_audit(s, d), "audit")
    return reclass.conditions(q, reclass.applied(q, audit), audit)


def reclass_problems(s: SparkSession, d: str) -> DataFrame:
    """Problems of an audit list that has been spoilt on purpose."""
    k = F.col("id")
    bad = reclass_audit(s, d).withColumns({"new_class": F.when(k % 5 == 0, "reject").otherwise(F.col("new_class")), "url": F.when(k % 3 == 0, F.concat("url", F.lit("x"))).otherwise(F.col("url")), "new_reason": F.when(k % 11 == 0, "").otherwise(F.col("new_reason"))})
    bad = bad.withColumn("id", F.when(k % 7 == 0, F.concat(F.lit("n"), k.cast("string"))).when(k % 13 == 0, (k + 100_000_000_000).cast("string")).otherwise(k.cast("string")))
    return reclass.problems(bad, table(s, d, "discovered_urls"))


def retag_counts(s: SparkSession, d: str) -> DataFrame:
    """Old class, new class and new status of all pairs, per source."""
    q = table(s, d, "discovered_urls").select("id", "source", F.col("match_class").alias("old_class"))
    return q.join(reclass.retags(_titled(s, d)), "id").groupBy("source", "old_class", "new_class", "new_status").agg(F.count("*").alias("n"))


def name_hits(s: SparkSession, d: str) -> DataFrame:
    """How many accepts per ticker and one-word name came by the name."""
    rows = table(s, d, "discovered_urls").filter("match_class = 'accept' AND match_reason = 'name' AND company IS NOT NULL")
    from millrace.functions.matching import full_name

    return rows.withColumn("name", full_name(F.col("company"))).filter("name <> '' AND NOT contains(name, ' ')").groupBy("ticker", "name").agg(F.count("*").alias("n"))


def redated(s: SparkSession, d: str) -> DataFrame:
    """Rows whose address carries a year, and how many of these lie before 2022, per source."""
    from millrace.functions import urls

    y = urls.year(F.col("url"))
    return table(s, d, "discovered_urls").groupBy("source").agg(F.count_if(y.isNotNull()).alias("with_year"), F.count_if(y < 2022).alias("earlier"))


def new_rejects(s: SparkSession, d: str) -> DataFrame:
    """Of the later rows of the queue as a batch: distinct rejects that the first rows don't have."""
    q = table(s, d, "discovered_urls")
    first = queue.first_per_key(q, ["url", "ticker"], ["id"]).filter("id % 2 = 0")
    batch = q.filter("match_class = 'reject'").select("url", "ticker").distinct()
    return batch.join(first.select("url", "ticker"), ["url", "ticker"], "left_anti").agg(F.count("*").alias("n"))


def reset_pairs(s: SparkSession, d: str) -> DataFrame:
    """Failed pairs set back to pending, rejects refused, per class."""
    q = table(s, d, "discovered_urls")
    ok = (F.col("status") == "failed") & (F.col("match_class") != "reject")
    return q.withColumn("status", F.when(ok, "pending").otherwise(F.col("status"))).groupBy("match_class", "status").agg(F.count("*").alias("n"))


def _bars(s: SparkSession, d: str) -> DataFrame:
    """Daily price rows of five symbols, from orders."""
    o = table(s, d, "orders").select(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("day"), F.floor(F.col("o_totalprice") / 50_000).alias("p"))
    split = F.when((F.month("day") == 1) & (F.dayofmonth("day") == 15), F.lit(2.0)).when((F.month("day") == 7) & (F.dayofmonth("day") == 4), F.lit(1.3)).otherwise(F.lit(1.0))
    g = o.groupBy("symbol", "day").agg(F.min("p").cast("double").alias("open"), F.max("p").cast("double").alias("high"), F.min("p").cast("double").alias("low"), F.max("p").cast("double").alias("close"), (F.count("*") - 1).cast("double").alias("volume"))
    return g.withColumn("split_factor", split)


_BARS = """bars AS (SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS day, CAST(min(floor(o_totalprice / 50000)) AS DOUBLE) AS open, CAST(max(floor(o_totalprice / 50000)) AS DOUBLE) AS high,
  CAST(min(floor(o_totalprice / 50000)) AS DOUBLE) AS low, CAST(max(floor(o_totalprice / 50000)) AS DOUBLE) AS close, CAST(count(*) - 1 AS DOUBLE) AS volume,
  CASE WHEN month(CAST(o_orderdate AS DATE)) = 1 AND day(CAST(o_orderdate AS DATE)) = 15 THEN 2.0 WHEN month(CAST(o_orderdate AS DATE)) = 7 AND day(CAST(o_orderdate AS DATE)) = 4 THEN 1.3 ELSE 1.0 END::DOUBLE AS split_factor FROM orders GROUP BY ALL)"""


def adjusted_series(s: SparkSession, d: str) -> DataFrame:
    rows = _bars(s, d).withColumn("split_factor", F.when(F.col("split_factor") == 2.0, F.lit(2.0)).otherwise(F.lit(1.0)))
    out = prices.adjusted(rows, "1996-01-01", "2000-12-31")
    return out.select("symbol", "day", *[F.round(c, 6).alias(c) for c in ("adj_open", "adj_high", "adj_low", "adj_close")], "adj_volume", "raw_close")


def non_trades(s: SparkSession, d: str) -> DataFrame:
    gone = s.createDataFrame([("1-URGENT", "1999-06-02"), ("5-LOW", "2000-01-05")], "symbol string, d string").select("symbol", F.col("d").cast("date").alias("delisted_on"))
    return prices.no_trades(_bars(s, d), gone)


def split_events(s: SparkSession, d: str) -> DataFrame:
    known = s.createDataFrame([("2-HIGH", "1998-07-04", "spin-off")], "symbol string, d string, kind string").select("symbol", F.col("d").cast("date").alias("day"), "kind")
    return prices.split_events(_bars(s, d), known)


def vendor_candles(s: SparkSession, d: str) -> DataFrame:
    """Candles per symbol from the first vendor that has any; the first has arrays of two symbols only."""
    bars = _bars(s, d)
    arrays = bars.filter("symbol < '3'").groupBy("symbol", F.year("day").alias("y"), F.month("day").alias("m")).agg(F.sort_array(F.collect_list(F.struct(F.unix_date("day").alias("t"), "open", "high", "low", "close", "volume"))).alias("r"))
    pick = lambda c: F.transform("r", lambda x: x[c])
    answers = arrays.select("symbol", F.lit("first").alias("source"), F.transform("r", lambda x: x["t"].cast("long") * 86400).alias("t"), pick("open").alias("o"), pick("high").alias("h"), pick("low").alias("l"), pick("close").alias("c"), pick("volume").alias("v"))
    both = prices.from_arrays(answers).unionByName(bars.select("symbol", "day", "open", "high", "low", "close", "volume", F.lit("second").alias("source")))
    return prices.first_vendor(both, ("first", "second"), "1997-01-01", "1997-12-31").groupBy("symbol", "source", "fallback").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


def distributions(s: SparkSession, d: str) -> DataFrame:
    """Which form a second source's distributions have: that of the even symbols is adjusted."""
    rows = _bars(s, d).select("symbol", "day", F.col("close").alias("cash"), F.lit(2.0).alias("factor"))
    other = rows.select("symbol", "day", F.when(F.substring("symbol", 1, 1).cast("int") % 2 == 0, F.col("cash") / 2).otherwise(F.col("cash")).alias("amount"))
    return prices.distribution_form(rows, other)


def missing_sessions(s: SparkSession, d: str) -> DataFrame:
    """Sessions of 2024 and 2025 on which no article of a sector was fetched."""
    rows = table(s, d, "articles").filter("gics_sector IS NOT NULL").select(F.col("gics_sector").alias("symbol"), F.to_date("fetched_at").alias("day"))
    return prices.missing_sessions(rows, calendar.sessions(s, "2024-01-01", "2025-12-31"))


def session_steps(s: SparkSession, d: str) -> DataFrame:
    """For each day on which an article was fetched: the last session on or before it and the fifth after it."""
    days = table(s, d, "articles").filter("fetched_at BETWEEN '2022-01-01' AND '2025-11-30'").select(F.to_date("fetched_at").alias("day"))
    return calendar.stepped(days, calendar.sessions(s, "2021-01-01", "2025-12-31"), 5)


def off_calendar_days(s: SparkSession, d: str) -> DataFrame:
    days = table(s, d, "articles").filter("fetched_at BETWEEN '2022-01-01' AND '2025-11-30'").select(F.to_date("fetched_at").alias("day"))
    return calendar.off_calendar(days, calendar.sessions(s, "2021-01-01", "2025-12-31"))


def _roster(s: SparkSession, d: str) -> DataFrame:
    """Today's roster: open symbols but those in the first half of the alphabet with a fixed last letter, and ten others."""
    u = table(s, d, "universe_membership")
    mine = u.filter("valid_to IS NULL AND symbol < 'P' OR valid_to IS NULL AND right(symbol, 1) <> 'K'").select("symbol", "security").groupBy("symbol").agg(F.max("security").alias("security"))
    return mine.unionByName(s.range(10).select(F.concat(F.lit("NEW"), F.col("id").cast("string")).alias("symbol"), F.lit("New Co").alias("security")))


_ROSTER = """roster AS (SELECT symbol, max(security) AS security FROM universe_membership WHERE valid_to IS NULL AND (symbol < 'P' OR right(symbol, 1) <> 'K') GROUP BY symbol UNION ALL SELECT 'NEW' || i, 'New Co' FROM range(10) t(i))"""


def snapshot_recorded(s: SparkSession, d: str) -> DataFrame:
    out = membership.record_snapshot(table(s, d, "universe_membership"), _roster(s, d), "2025-12-15")
    return out.select("symbol", "valid_from", "valid_to", "source").distinct()


def membership_backfilled(s: SparkSession, d: str) -> DataFrame:
    """Rows by source when a backfill runs over stored ones, plainly and by force."""
    u = table(s, d, "universe_membership")
    built = u.filter("source = 'live_snapshot'").select("symbol", "valid_from")
    count = lambda force, name: membership.backfilled(u, built, "changes_backfill", force).groupBy(F.lit(name).alias("run"), "source").agg(F.count("*").alias("n"))
    return count(False, "plain").unionByName(count(True, "forced"))


def membership_relabelled(s: SparkSession, d: str) -> DataFrame:
    u = table(s, d, "universe_membership")
    updates = u.filter("gics_revision_timestamp IS NOT NULL").groupBy("symbol", "valid_from").agg(F.max(F.upper("gics_sector")).alias("gics_sector"))
    return membership.relabelled(u, updates, ("gics_sector",)).groupBy("gics_sector").agg(F.count("*").alias("n"))


def coverage_days(s: SparkSession, d: str) -> DataFrame:
    days = s.range(3).select(F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") * 4000).cast("int")).alias("day"))
    return membership.coverage(table(s, d, "universe_membership"), days)


def crawl_policy(s: SparkSession, d: str) -> DataFrame:
    """What to do for each site at the end of 2025; half of the sites have changed their sitemaps."""
    c = table(s, d, "sitemap_crawls")
    sign = F.when(F.pmod(F.length("domain"), F.lit(2)) == 0, F.max_by("signature", F.when(F.col("complete"), F.col("started_at")))).otherwise(F.lit("changed"))
    asked = c.groupBy("domain").agg(sign.alias("signature")).withColumn("start", F.lit("2023-06-30").cast("date"))
    return crawls.policy(c, asked, NOW_US)


def crawl_retention(s: SparkSession, d: str) -> DataFrame:
    """Crawls and entries that are kept at the end of 2025."""
    c = crawls.kept_crawls(table(s, d, "sitemap_crawls"), NOW_US).groupBy("domain").agg(F.count("*").alias("crawls"))
    e = crawls.retained(table(s, d, "sitemap_entries"), NOW_US).groupBy("domain").agg(F.count("*").alias("entries"))
    return c.join(e, "domain", "full_outer").select("domain", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("crawls", "entries")])


def live_after_cache(s: SparkSession, d: str) -> DataFrame:
    """Queue addresses that the current sitemap entries of 2024 don't give already."""
    now = crawls.current_entries(table(s, d, "sitemap_entries"), table(s, d, "sitemap_crawls")).select("url", lenient_date(F.col("lastmod")).alias("lastmod"))
    return crawls.cached_first(table(s, d, "discovered_urls").select("url", "title"), now, "2024-01-01", "2024-12-31").select("url")


def members_public(s: SparkSession, d: str) -> DataFrame:
    """Membership in its public form, from a table without citations."""
    return membership.public(table(s, d, "universe_membership").drop("gics_revision_id", "gics_revision_timestamp"))


def tracked_tickers(s: SparkSession, d: str) -> DataFrame:
    return membership.tracked(table(s, d, "articles").filter("ticker IS NOT NULL"), table(s, d, "universe_membership"))


def chosen_stints(s: SparkSession, d: str) -> DataFrame:
    return membership.chosen_stint(table(s, d, "universe_membership"), "2022-06-01")


def sheet_spliced(s: SparkSession, d: str) -> DataFrame:
    """Every tenth pair as a new sheet, with what an older sheet of every fourth says of it."""
    q = table(s, d, "discovered_urls")
    old = q.filter("id % 4 = 0").select("id", F.when(F.col("id") % 3 == 0, "yes").otherwise("").alias("label"), F.lit("seen").alias("notes"))
    return labels.spliced(q.filter("id % 10 = 0").select("id", (F.col("id") / 10).cast("long").alias("ordinal")), old)


def sample_verdict(s: SparkSession, d: str) -> DataFrame:
    """Whether labels that say no to every thousandth accept pass."""
    q = table(s, d, "discovered_urls")
    label = F.when(F.col("match_class") == "accept", F.when(F.col("id") % 1000 == 0, "no").otherwise("yes")).otherwise("no")
    return labels.verdict(q.select("match_class", label.alias("label")))


def class_members(s: SparkSession, d: str) -> DataFrame:
    """Pairs per class as ruled now and source."""
    rows = reclass.retags(_titled(s, d)).join(table(s, d, "discovered_urls").select("id", "source"), "id")
    return rows.groupBy("new_class", "source").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


def _deletable(s: SparkSession, d: str) -> DataFrame:
    q = table(s, d, "discovered_urls")
    return queue.deletable(q, table(s, d, "articles"), crawls.latest_complete(table(s, d, "sitemap_crawls")), q.filter("id % 50 = 0"))


def deletable_kinds(s: SparkSession, d: str) -> DataFrame:
    """Pairs that may go, by whether their address is in the current sitemaps, with shares."""
    now = crawls.current_entries(table(s, d, "sitemap_entries"), table(s, d, "sitemap_crawls")).select("url").distinct().withColumn("_now", F.lit(True))
    g = _deletable(s, d).join(now, "url", "left").groupBy(F.when(F.col("_now"), "listed").otherwise("left").alias("kind")).agg(F.count("*").alias("n"))
    total = g.agg(F.sum("n").alias("t"))
    return g.join(F.broadcast(total)).select("kind", "n", F.round(F.col("n") / F.col("t"), 6).alias("share"))


def delete_conditions(s: SparkSession, d: str) -> DataFrame:
    q, gone = table(s, d, "discovered_urls"), materialize(_deletable(s, d).select("id"), "gone")
    return queue.delete_conditions(q, q.join(gone, "id", "left_anti"), gone, table(s, d, "articles"))


def progress_lines(s: SparkSession, d: str) -> DataFrame:
    return queue.progress(table(s, d, "discovered_urls"))


def entry_counts(s: SparkSession, d: str) -> DataFrame:
    """Current entries of each site in 2024 or undated."""
    e = crawls.current_entries(table(s, d, "sitemap_entries"), table(s, d, "sitemap_crawls")).withColumn("day", lenient_date(F.col("lastmod")))
    inside = F.col("day").isNull() | F.col("day").between(F.lit("2024-01-01").cast("date"), F.lit("2024-12-31").cast("date"))
    return e.groupBy("domain").agg(F.count_if(inside).alias("n"))


def startup_counts(s: SparkSession, d: str) -> DataFrame:
    """Rows of the pipeline's tables, and membership rows that a backfill wrote."""
    names = ("discovered_urls", "articles", "sitemap_entries", "sitemap_crawls", "universe_membership")
    counts = [table(s, d, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("of"), "n") for n in names]
    counts.append(table(s, d, "universe_membership").filter("source = 'changes_backfill'").agg(F.count("*").alias("n")).select(F.lit("backfilled").alias("of"), "n"))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    quarantine_sync, quarantine_counts, sync_forecast, held_accepts, fetch_marks, fetch_marks_by_url, reevaluated_pairs, recorded_fetch, reclass_audit, reclass_applied, reclass_reverted, reclass_report, reclass_conditions,
    reclass_problems, retag_counts, name_hits, redated, new_rejects, reset_pairs, adjusted_series, non_trades, split_events, vendor_candles, distributions, missing_sessions, session_steps, off_calendar_days, snapshot_recorded,
    membership_backfilled, membership_relabelled, coverage_days, crawl_policy, crawl_retention, live_after_cache,
    members_public, tracked_tickers, chosen_stints, sheet_spliced, sample_verdict, class_members, deletable_kinds, delete_conditions, progress_lines, entry_counts, startup_counts,
)

_SYNC = """synced AS (SELECT a.*, d.match_class, CASE WHEN d.match_class <> 'accept' AND (fetch_status IS NULL OR fetch_status <> 'quarantined') THEN 'quarantined' WHEN d.match_class = 'accept' AND fetch_status = 'quarantined' THEN prev_fetch_status ELSE fetch_status END AS s2,
  CASE WHEN d.match_class <> 'accept' AND (fetch_status IS NULL OR fetch_status <> 'quarantined') THEN fetch_status WHEN d.match_class = 'accept' AND (fetch_status = 'quarantined' OR prev_fetch_status IS NOT NULL) THEN NULL ELSE prev_fetch_status END AS p2
  FROM articles a LEFT JOIN discovered_urls d ON d.id = a.id)"""
_AUDIT = f"""{O._PAIRS}, audit AS (SELECT c.id, d.ticker, d.url, d.match_class AS old_class, d.match_reason AS old_reason, c.match_class AS new_class, c.match_reason AS new_reason, d.status AS old_status, CASE WHEN d.status = 'skipped' THEN 'pending' ELSE d.status END AS new_status
  FROM classed c JOIN discovered_urls d ON d.id = c.id WHERE d.match_class = 'reject' AND d.source <> 'api' AND c.match_class <> 'reject')"""
_APPLIED = "applied AS (SELECT d.id, coalesce(a.new_class, d.match_class) AS match_class, CASE WHEN a.id IS NULL THEN d.match_reason ELSE a.new_reason END AS match_reason, CASE WHEN a.id IS NOT NULL AND status = 'skipped' THEN 'pending' ELSE status END AS status FROM discovered_urls d LEFT JOIN audit a ON a.id = d.id)"
_RANK = "CASE {0} WHEN 'reject' THEN 0 WHEN 'review' THEN 1 WHEN 'accept' THEN 2 END"
_AGAIN = f"again AS (SELECT id, match_class AS old, split_part(c, '|', 1) AS match_class, split_part(c, '|', 2) AS match_reason FROM (SELECT *, {O._CLASS} AS c FROM ({O._company(O._texts('SELECT id, url, company, ticker, match_class, concat_ws(chr(32), nullif(title, chr(1) || chr(2)), fetched) AS title FROM both_titles'))})))"
_BOTH = "both_titles AS (SELECT d.id, d.url, d.company, d.ticker, d.match_class, nullif(d.title, '') AS title, nullif(a.title, '') AS fetched FROM discovered_urls d JOIN articles a ON a.id = d.id WHERE d.match_class <> 'reject')"
_SESSION = O._SESSIONS.format(first=2020, last=2027, start="2021-01-01", end="2025-12-31")
_FETCHED = "days AS (SELECT DISTINCT CAST(fetched_at AT TIME ZONE 'UTC' AS DATE) AS day FROM articles WHERE fetched_at BETWEEN TIMESTAMPTZ '2022-01-01 00:00:00+00' AND TIMESTAMPTZ '2025-11-30 00:00:00+00')"

SQL = {
    "quarantine_sync": f"WITH {_SYNC} SELECT id, s2 AS fetch_status, p2 AS prev_fetch_status FROM synced",
    "quarantine_counts": f"WITH {_SYNC} SELECT coalesce(p2, 'none') AS before, count(*) AS n FROM synced WHERE s2 = 'quarantined' GROUP BY 1",
    "sync_forecast": f"WITH {_SYNC} SELECT count(*) FILTER (s2 = 'quarantined' AND fetch_status IS DISTINCT FROM 'quarantined') AS held, count(*) FILTER (match_class = 'accept' AND (fetch_status = 'quarantined' OR prev_fetch_status IS NOT NULL)) AS released, count(*) FILTER (s2 = 'ok' AND match_class IS NOT NULL) - count(*) FILTER (fetch_status = 'ok' AND match_class IS NOT NULL) AS ok_change FROM synced",
    "held_accepts": f"WITH {_SYNC} SELECT 'before' AS state, count(*) AS n FROM synced WHERE match_class = 'accept' AND fetch_status = 'quarantined' UNION ALL SELECT 'after', count(*) FROM synced WHERE match_class = 'accept' AND s2 = 'quarantined'",
    "fetch_marks": """WITH r AS (SELECT id, max(http_status_code) AS code, max(CASE WHEN http_status_code IS NULL THEN fetch_status END) AS reason FROM articles GROUP BY id)
SELECT d.id, CASE WHEN r.id IS NULL THEN status WHEN code IS NOT NULL THEN CASE WHEN code BETWEEN 200 AND 299 THEN 'fetched' ELSE 'failed' END ELSE 'skipped' END AS status, coalesce(code, fetch_status_code, -1) AS fetch_status_code, coalesce(CASE WHEN r.id IS NOT NULL AND code IS NULL THEN coalesce(title, nullif(reason, '')) ELSE title END, '-') AS title FROM discovered_urls d LEFT JOIN r ON r.id = d.id""",
    "fetch_marks_by_url": "WITH r AS (SELECT url, max(coalesce(fetch_status_code, 599)) AS code FROM discovered_urls GROUP BY url) SELECT domain, CASE WHEN code BETWEEN 200 AND 299 THEN 'fetched' ELSE 'failed' END AS status, count(*) AS n FROM discovered_urls JOIN r USING (url) GROUP BY ALL",
    "reevaluated_pairs": f"WITH {_BOTH}, {_AGAIN} SELECT id, match_class, match_reason FROM again WHERE {_RANK.format('match_class')} > {_RANK.format('old')}",
    "recorded_fetch": f"""WITH {_BOTH.replace("WHERE d.match_class <> 'reject'", "WHERE d.match_class <> 'reject' AND a.fetch_status <> 'failed'")}, {_AGAIN}, up AS (SELECT id, match_class FROM again WHERE {_RANK.format('match_class')} > {_RANK.format('old')}),
p AS (SELECT d.id, coalesce(up.match_class, d.match_class) AS cls, CASE WHEN a.id IS NOT NULL THEN a.fetch_status ELSE d.status END AS status FROM discovered_urls d LEFT JOIN up ON up.id = d.id LEFT JOIN articles a ON a.id = d.id),
s AS (SELECT CASE WHEN p.cls <> 'accept' THEN 'quarantined' WHEN p.cls = 'accept' AND a.fetch_status = 'quarantined' THEN NULL ELSE a.fetch_status END AS status FROM articles a LEFT JOIN p ON p.id = a.id)
SELECT 'pairs' AS of, coalesce(status, 'none') AS status, count(*) AS n FROM p GROUP BY ALL UNION ALL SELECT 'articles', coalesce(status, 'none'), count(*) FROM s GROUP BY ALL""",
    "reclass_audit": f"WITH {_AUDIT} SELECT * FROM audit",
    "reclass_applied": f"WITH {_AUDIT}, {_APPLIED} SELECT * FROM applied",
    "reclass_reverted": "SELECT id, match_class, match_reason, status FROM discovered_urls",
    "reclass_report": f"""WITH {_AUDIT}, {_APPLIED}, j AS (SELECT a.fetch_status AS fs, a.prev_fetch_status AS ps, p.match_class AS c FROM articles a JOIN applied p ON p.id = a.id)
SELECT 'status ' || coalesce(old_status, 'none') AS figure, count(*) AS n FROM audit GROUP BY 1 UNION ALL SELECT 'lifted', count(*) FROM audit WHERE old_status = 'skipped' UNION ALL SELECT 'feed rejects', count(*) FROM discovered_urls WHERE match_class = 'reject' AND source = 'api'
UNION ALL SELECT 'ok articles', count(*) FROM articles WHERE fetch_status = 'ok' UNION ALL SELECT 'held', count(*) FROM j WHERE c <> 'accept' AND fs IS DISTINCT FROM 'quarantined' UNION ALL SELECT 'released', count(*) FROM j WHERE c = 'accept' AND (fs = 'quarantined' OR ps IS NOT NULL)
UNION ALL SELECT 'ok_change', count(*) FILTER (c = 'accept' AND fs = 'quarantined' AND ps = 'ok') - count(*) FILTER (c <> 'accept' AND fs = 'ok') FROM j""",
    "reclass_conditions": "SELECT * FROM (VALUES ('as many as listed', true), ('none still a reject', true), ('no other row', true), ('accepts moved', true)) t(condition, holds)",
    "reclass_problems": f"""WITH {_AUDIT}, bad AS (SELECT CASE WHEN id % 7 = 0 THEN 'n' || id WHEN id % 13 = 0 THEN CAST(id + 100000000000 AS VARCHAR) ELSE CAST(id AS VARCHAR) END AS t, CASE WHEN id % 3 = 0 THEN url || 'x' ELSE url END AS url, ticker, CASE WHEN id % 5 = 0 THEN 'reject' ELSE new_class END AS new_class,
  CASE WHEN id % 11 = 0 THEN '' ELSE new_reason END AS new_reason, old_reason, old_status, new_status FROM audit), b AS (SELECT bad.*, TRY_CAST(t AS BIGINT) AS i, d.id AS known, d.url AS u FROM bad LEFT JOIN discovered_urls d ON d.id = TRY_CAST(t AS BIGINT))
SELECT 'not_a_number' AS problem, count(*) FILTER (i IS NULL) AS n FROM b UNION ALL SELECT 'no_promotion', count(*) FILTER (new_class = 'reject') FROM b UNION ALL SELECT 'blank', count(*) FILTER (new_reason = '' OR old_reason IS NULL OR trim(old_reason) = '' OR old_status IS NULL OR new_status IS NULL) FROM b
UNION ALL SELECT 'unknown', count(*) FILTER (i IS NOT NULL AND known IS NULL) FROM b UNION ALL SELECT 'another_pair', count(*) FILTER (known IS NOT NULL AND u <> url) FROM b UNION ALL SELECT 'repeated', 0""",
    "retag_counts": f"""WITH {O._PAIRS}, n AS (SELECT d.source, d.match_class AS old_class, CASE WHEN d.source = 'api' THEN 'accept' ELSE c.match_class END AS new_class, d.status FROM discovered_urls d LEFT JOIN classed c ON c.id = d.id WHERE d.source = 'api' OR c.id IS NOT NULL)
SELECT source, old_class, new_class, CASE WHEN new_class = 'reject' AND status = 'pending' THEN 'skipped' ELSE status END AS new_status, count(*) AS n FROM n GROUP BY ALL""",
    "name_hits": r"""SELECT ticker, name, count(*) AS n FROM (SELECT ticker, trim(regexp_replace(regexp_replace(lower(replace(company, '&', ' and ')), '\b(inc|corp|corporation|co|company|ltd|plc|llc|holdings|group|the|class [a-c])\b\.?', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS name FROM discovered_urls WHERE match_class = 'accept' AND match_reason = 'name' AND company IS NOT NULL) WHERE name <> '' AND NOT contains(name, ' ') GROUP BY ALL""",
    "redated": r"SELECT source, count(y) AS with_year, count(*) FILTER (y < 2022) AS earlier FROM (SELECT source, TRY_CAST(regexp_extract(url, '/((?:19|20)\d{2})/', 1) AS INTEGER) AS y FROM discovered_urls) GROUP BY source",
    "new_rejects": "WITH f AS (SELECT url, ticker, min(id) AS id FROM discovered_urls GROUP BY ALL) SELECT count(*) AS n FROM (SELECT DISTINCT url, ticker FROM discovered_urls WHERE match_class = 'reject' EXCEPT SELECT url, ticker FROM f WHERE id % 2 = 0)",
    "reset_pairs": "SELECT match_class, CASE WHEN status = 'failed' AND match_class <> 'reject' THEN 'pending' ELSE status END AS status, count(*) AS n FROM discovered_urls GROUP BY ALL",
    "adjusted_series": f"""WITH {_BARS}, f AS (SELECT *, coalesce(product(CASE WHEN split_factor = 2 THEN 2.0 ELSE 1.0 END) OVER (PARTITION BY symbol ORDER BY day DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1.0) AS x FROM bars)
SELECT symbol, CAST(day AS VARCHAR) AS day, round(open / x, 6) AS adj_open, round(high / x, 6) AS adj_high, round(low / x, 6) AS adj_low, round(close / x, 6) AS adj_close, CAST(round_even(volume * x, 0) AS BIGINT) AS adj_volume, close AS raw_close FROM f WHERE day BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
    "non_trades": f"""WITH {_BARS}, g AS (SELECT * FROM (VALUES ('1-URGENT', DATE '1999-06-02'), ('5-LOW', DATE '2000-01-05')) t(symbol, gone)), m AS (SELECT symbol, median(volume) AS med FROM bars GROUP BY symbol),
r AS (SELECT b.symbol, b.day, close, volume, gone, med, coalesce(lag(close) OVER w = close, false) AS same, min(close) OVER l AS lo, max(close) OVER l AS hi FROM bars b LEFT JOIN g USING (symbol) JOIN m ON m.symbol = b.symbol WINDOW w AS (PARTITION BY b.symbol ORDER BY b.day), l AS (PARTITION BY b.symbol ORDER BY b.day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT symbol, CAST(day AS VARCHAR) AS day, reason FROM (SELECT *, CASE WHEN same AND volume = 0 THEN 'carried' WHEN day > gone THEN 'otc' WHEN day = gone THEN CASE WHEN same AND coalesce(lo <> close OR hi <> close, false) THEN 'halt' ELSE 'otc' END WHEN same AND med > 0 AND volume < 0.10 * med THEN 'carried' END AS reason FROM r) WHERE reason IS NOT NULL""",
    "split_events": f"WITH {_BARS} SELECT symbol, CAST(day AS VARCHAR) AS day, split_factor AS factor, CASE WHEN symbol = '2-HIGH' AND day = DATE '1998-07-04' THEN 'spin-off' WHEN split_factor = 2 THEN 'split' ELSE 'other action' END AS kind FROM bars WHERE split_factor <> 1",
    "vendor_candles": f"WITH {_BARS} SELECT symbol, CASE WHEN symbol < '3' THEN 'first' ELSE 'second' END AS source, symbol >= '3' AS fallback, count(*) AS n, sum(volume) AS volume FROM bars WHERE year(day) = 1997 GROUP BY ALL",
    "distributions": f"WITH {_BARS}, x AS (SELECT symbol, close AS cash, CASE WHEN CAST(substr(symbol, 1, 1) AS INTEGER) % 2 = 0 THEN close / 2 ELSE close END AS amount FROM bars) SELECT symbol, count(*) AS shared, round(max(abs(cash - amount)), 6) AS raw_gap, round(max(abs(cash / 2 - amount)), 6) AS adjusted_gap, CASE WHEN max(abs(cash - amount)) <= max(abs(cash / 2 - amount)) THEN 'raw' ELSE 'adjusted' END AS form FROM x GROUP BY symbol",
    "missing_sessions": f"""WITH {O._SESSIONS.format(first=2023, last=2027, start="2024-01-01", end="2025-12-31")}, c AS (SELECT day, row_number() OVER (ORDER BY day) AS n FROM sessions), o AS (SELECT DISTINCT gics_sector AS symbol, c.day, n FROM articles JOIN c ON c.day = CAST(fetched_at AT TIME ZONE 'UTC' AS DATE) WHERE gics_sector IS NOT NULL),
g AS (SELECT symbol, count(*) AS got, min(day) AS a, max(day) AS b, min(n) AS na, max(n) AS nb, (SELECT max(n) FROM c) AS top FROM o GROUP BY symbol)
SELECT symbol, top - na + 1 AS expected, got, CAST(a AS VARCHAR) AS first_day, CAST(b AS VARCHAR) AS last_day, top - na + 1 - got AS missing, CASE WHEN top - na + 1 = got THEN NULL WHEN got = nb - na + 1 THEN 'tail' ELSE 'inside' END AS reason FROM g""",
    "session_steps": f"WITH {_SESSION}, c AS (SELECT day, row_number() OVER (ORDER BY day) AS n FROM sessions), {_FETCHED}, l AS (SELECT d.day, max(c.day) AS last, max(c.n) AS n FROM days d LEFT JOIN c ON c.day <= d.day GROUP BY d.day) SELECT CAST(l.day AS VARCHAR) AS day, CAST(last AS VARCHAR) AS last, CAST(c.day AS VARCHAR) AS next FROM l LEFT JOIN c ON c.n = coalesce(l.n, 0) + 5",
    "off_calendar_days": f"WITH {_SESSION}, {_FETCHED} SELECT CAST(day AS VARCHAR) AS day FROM days WHERE day NOT IN (SELECT day FROM sessions)",
    "snapshot_recorded": f"""WITH {_ROSTER}, o AS (SELECT DISTINCT symbol FROM universe_membership WHERE valid_to IS NULL)
SELECT DISTINCT symbol, CAST(valid_from AS VARCHAR) AS valid_from, CAST(CASE WHEN valid_to IS NULL AND symbol NOT IN (SELECT symbol FROM roster) THEN DATE '2025-12-14' ELSE valid_to END AS VARCHAR) AS valid_to, source FROM universe_membership UNION SELECT symbol, '2025-12-15', NULL, 'snapshot' FROM roster WHERE symbol NOT IN (SELECT symbol FROM o)""",
    "membership_backfilled": "SELECT 'plain' AS run, source, count(*) AS n FROM universe_membership GROUP BY ALL UNION ALL SELECT 'forced', s, count(*) FROM universe_membership, (VALUES ('live_snapshot'), ('changes_backfill')) t(s) WHERE source = 'live_snapshot' GROUP BY s",
    "membership_relabelled": "WITH u AS (SELECT symbol, valid_from, max(upper(gics_sector)) AS g FROM universe_membership WHERE gics_revision_timestamp IS NOT NULL GROUP BY ALL) SELECT CASE WHEN u.symbol IS NOT NULL THEN g ELSE gics_sector END AS gics_sector, count(*) AS n FROM universe_membership m LEFT JOIN u ON u.symbol = m.symbol AND u.valid_from = m.valid_from GROUP BY 1",
    "coverage_days": "SELECT CAST(day AS VARCHAR) AS day, CASE WHEN f IS NULL THEN 'empty' WHEN day < f THEN 'too early' END AS problem FROM (SELECT DATE '2000-01-01' + CAST(i * 4000 AS INTEGER) AS day FROM range(3) t(i)), (SELECT min(valid_from) AS f FROM universe_membership)",
    "crawl_policy": f"""WITH d AS (SELECT domain, max(CASE WHEN complete THEN started_at END) AS began, max(CASE WHEN finished_at IS NULL THEN epoch_us(started_at) END) AS open_us, arg_max(signature, started_at) FILTER (complete) AS latest FROM sitemap_crawls GROUP BY domain),
x AS (SELECT d.*, c.finished_at, c.range_start, c.signature AS own, CASE WHEN length(d.domain) % 2 = 0 THEN latest ELSE 'changed' END AS signature FROM d LEFT JOIN sitemap_crawls c ON c.domain = d.domain AND c.started_at = d.began AND c.complete),
y AS (SELECT *, coalesce(own = signature, false) AS same, coalesce(own = signature, false) AND coalesce(range_start <= DATE '2023-06-30', false) AS usable, {NOW_US} - epoch_us(coalesce(finished_at, began)) AS age FROM x)
SELECT domain, usable, NOT usable OR coalesce(age > 7 * 86400000000, true) AS refresh, CAST(CASE WHEN same THEN least(DATE '2023-06-30', range_start) ELSE DATE '2023-06-30' END AS VARCHAR) AS crawl_start, coalesce(open_us > {NOW_US} - 1800000000, false) AS busy, CAST(floor(age / 86400000000.0) AS BIGINT) AS age_days FROM y""",
    "crawl_retention": f"""WITH l AS (SELECT domain, max(started_at) AS last FROM sitemap_crawls WHERE complete GROUP BY domain), c AS (SELECT s.domain, count(*) AS crawls FROM sitemap_crawls s LEFT JOIN l USING (domain) WHERE epoch_us(started_at) >= {NOW_US} - 90 * 86400000000 OR started_at = last GROUP BY s.domain),
e AS (SELECT domain, count(*) AS entries FROM sitemap_entries WHERE epoch_us(last_seen) >= {NOW_US} - 90 * 86400000000 GROUP BY domain) SELECT coalesce(c.domain, e.domain) AS domain, coalesce(crawls, 0) AS crawls, coalesce(entries, 0) AS entries FROM c FULL JOIN e ON c.domain = e.domain""",
    "live_after_cache": rf"""WITH c AS (SELECT domain, max(started_at) AS at FROM sitemap_crawls WHERE complete GROUP BY domain), k AS (SELECT {O._NORMAL} AS url FROM sitemap_entries e JOIN c ON c.domain = e.domain AND e.last_seen = c.at
  WHERE coalesce(coalesce(TRY_CAST(nullif(regexp_extract(trim(lastmod), '^(\d{{4}}-\d{{2}}-\d{{2}})(?:$|[T ])', 1), '') AS DATE), TRY_CAST(nullif(regexp_extract(trim(lastmod), '^(\d{{4}}-\d{{2}})$', 1), '') || '-01' AS DATE)) BETWEEN DATE '2024-01-01' AND DATE '2024-12-31', true))
SELECT DISTINCT {O._NORMAL} AS url FROM discovered_urls WHERE {O._NORMAL} NOT IN (SELECT url FROM k)""",
    "members_public": "SELECT symbol, security, gics_sector, gics_sub_industry, hq_location, date_added, cik, founded, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, source, CAST(NULL AS VARCHAR) AS gics_revision_id FROM universe_membership",
    "tracked_tickers": "SELECT DISTINCT ticker, upper(trim(ticker)) IN (SELECT upper(trim(symbol)) FROM universe_membership WHERE valid_to IS NULL AND symbol IS NOT NULL) AS tracked FROM articles WHERE ticker IS NOT NULL",
    "chosen_stints": """SELECT symbol, CAST(greatest(valid_from, DATE '2022-06-01') AS VARCHAR) AS start, CAST(valid_to AS VARCHAR) AS "end" FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY coalesce(valid_to, DATE '9999-12-31') DESC, valid_from DESC) AS k FROM universe_membership WHERE symbol IS NOT NULL AND valid_from IS NOT NULL) WHERE k = 1""",
    "sheet_spliced": "SELECT id, id // 10 AS ordinal, CASE WHEN id % 12 = 0 THEN 'yes' ELSE '' END AS label, CASE WHEN id % 12 = 0 THEN 'seen' ELSE '' END AS notes FROM discovered_urls WHERE id % 10 = 0",
    "sample_verdict": "SELECT count(*) FILTER (match_class = 'accept' AND id % 1000 = 0) AS wrong, 0 AS missed, 0 AS unlabelled, count(*) FILTER (match_class = 'accept' AND id % 1000 = 0) <= 5 AS passed FROM discovered_urls",
    "class_members": f"WITH {O._PAIRS}, n AS (SELECT d.id, d.source, CASE WHEN d.source = 'api' THEN 'accept' ELSE c.match_class END AS new_class FROM discovered_urls d LEFT JOIN classed c ON c.id = d.id WHERE d.source = 'api' OR c.id IS NOT NULL) SELECT new_class, source, count(*) AS n, min(id) AS first_id FROM n GROUP BY ALL",
    "deletable_kinds": """WITH l AS (SELECT domain, max(started_at) AS began, arg_max(entries, started_at) AS n FROM sitemap_crawls WHERE complete GROUP BY domain), k AS (SELECT DISTINCT url FROM sitemap_entries e JOIN l ON l.domain = e.domain AND e.last_seen = l.began),
g AS (SELECT CASE WHEN url IN (SELECT url FROM k) THEN 'listed' ELSE 'left' END AS kind, count(*) AS n FROM discovered_urls d WHERE match_class = 'reject' AND status = 'skipped' AND source = 'sitemap' AND domain IN (SELECT domain FROM l WHERE n > 0) AND id NOT IN (SELECT id FROM articles) AND id % 50 <> 0 GROUP BY 1)
SELECT kind, n, round(n / sum(n) OVER (), 6) AS share FROM g""",
    "delete_conditions": "SELECT * FROM (VALUES ('count', true), ('none listed', true), ('no other', true), ('rejects only', true), ('no article', true)) t(condition, holds)",
    "progress_lines": "SELECT ticker, count(*) FILTER (status <> 'pending') || ' of ' || count(*) || ' processed' AS line FROM discovered_urls WHERE match_class <> 'reject' GROUP BY ticker",
    "entry_counts": r"""WITH c AS (SELECT domain, max(started_at) AS began FROM sitemap_crawls WHERE complete GROUP BY domain) SELECT e.domain, count(*) FILTER (coalesce(coalesce(TRY_CAST(nullif(regexp_extract(trim(lastmod), '^(\d{4}-\d{2}-\d{2})(?:$|[T ])', 1), '') AS DATE), TRY_CAST(nullif(regexp_extract(trim(lastmod), '^(\d{4}-\d{2})$', 1), '') || '-01' AS DATE)) BETWEEN DATE '2024-01-01' AND DATE '2024-12-31', true)) AS n
FROM sitemap_entries e JOIN c ON c.domain = e.domain AND e.last_seen = c.began GROUP BY e.domain""",
    "startup_counts": " UNION ALL ".join(f"SELECT '{n}' AS of, count(*) AS n FROM {n}" for n in ("discovered_urls", "articles", "sitemap_entries", "sitemap_crawls", "universe_membership")) + " UNION ALL SELECT 'backfilled', count(*) FROM universe_membership WHERE source = 'changes_backfill'",
}
