"""Registered queries of readers, field functions, labels, filings, statements, pages and writers. Text that the readers take is made from the
tables, row by row, so that what comes back can be checked against them. Each stands beside its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import oracles as O
from millrace.functions import articles as A
from millrace.functions import fields, urls
from millrace.operators import facts, filings, labels, queue, series
from millrace.session import work_dir
from millrace.sources import pages, schema, sinks
from millrace.sources.tables import table


def _xml(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _node(name: str, c: Column) -> Column:
    return F.when(c.isNotNull(), F.concat(F.lit(f"<{name}>"), _xml(c), F.lit(f"</{name}>"))).otherwise(F.lit(""))


def sitemap_read(s: SparkSession, d: str) -> DataFrame:
    """Entries of 2023 and 2024, or undated, read from a sitemap file per entry."""
    e = table(s, d, "sitemap_entries")
    body = F.concat(F.lit("<urlset xmlns='x'><url>"), _node("loc", F.col("url")), _node("lastmod", F.col("lastmod")), _node("title", F.col("title")), F.lit("</url></urlset>"))
    return pages.sitemap(e.select(F.col("domain").alias("path"), body.alias("value")), "2023-01-01", "2024-12-31").select(F.col("path").alias("domain"), "loc", "lastmod", F.coalesce("title", F.lit("-")).alias("title"))


def sitemap_crawled(s: SparkSession, d: str) -> DataFrame:
    """Entries of the longest addresses of each site, reached from one root through an index per site; sites whose index is older than the range aren't opened."""
    e = table(s, d, "sitemap_entries").groupBy("domain").agg(F.max(F.struct(F.length("url").alias("n"), "url")).alias("m")).select("domain", "m.url")
    old = F.pmod(F.length("domain"), F.lit(3)) == 0
    each = F.concat(F.lit("<sitemap><loc>index/"), F.col("domain"), F.lit("</loc><lastmod>"), F.when(old, "2020-01-01").otherwise("2024-02-01"), F.lit("</lastmod></sitemap>"))
    root = e.agg(F.concat(F.lit("<sitemapindex>"), F.array_join(F.sort_array(F.collect_list(each)), ""), F.lit("<sitemap><loc>root</loc></sitemap></sitemapindex>")).alias("value")).select(F.lit("root").alias("path"), "value")
    index = e.select(F.concat(F.lit("index/"), "domain").alias("path"), F.concat(F.lit("<sitemapindex><sitemap><loc>leaf/"), "domain", F.lit("</loc></sitemap></sitemapindex>")).alias("value"))
    leaf = e.select(F.concat(F.lit("leaf/"), "domain").alias("path"), F.concat(F.lit("<urlset><url>"), _node("loc", F.col("url")), F.lit("</url></urlset>")).alias("value"))
    return pages.crawl(["root"], root.unionByName(index).unionByName(leaf), "2024-01-01", "2024-12-31").select("loc")


def feed_read(s: SparkSession, d: str) -> DataFrame:
    q = table(s, d, "discovered_urls").select("id", "url", "title", "pub_date")
    body = F.concat(F.lit("<rss><channel><item>"), _node("title", F.col("title")), _node("link", F.col("url")), _node("pubDate", F.translate("pub_date", "\u0000\u0001", "")), F.lit("</item></channel></rss>"))
    return pages.feed(q.select(F.col("id").cast("string").alias("path"), body.alias("value"))).select(F.col("path").cast("long").alias("id"), "link", F.coalesce("title", F.lit("-")).alias("title"))


def archive_read(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "sitemap_entries").filter("first_seen IS NOT NULL")
    rows = F.to_json(F.array(F.array(F.lit("timestamp"), F.lit("original")), F.array(F.date_format("first_seen", "yyyyMMddHHmmss"), F.col("url")), F.array(F.lit("short"))))
    return pages.archive_index(e.select(rows.alias("value"))).select(F.col("original").alias("url"), "day")


def _members(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "universe_membership").select("symbol", *[F.coalesce(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit("")).alias(c) for c in ("security", "gics_sector", "gics_sub_industry", "hq_location", "date_added", "cik", "founded")])


def _html(cells: list[Column], header: list[str], table_id: str) -> Column:
    head = "".join(f"<th>{h}</th>" for h in header)
    return F.concat(F.lit(f"<html><table id='{table_id}'><tr>{head}</tr><tr>"), *[x for c in cells for x in (F.lit("<td>"), _xml(c), F.lit("</td>"))], F.lit("</tr></table></html>"))


def constituents_read(s: SparkSession, d: str) -> DataFrame:
    m = _members(s, d)
    value = _html([F.col(c) for c in pages.CONSTITUENTS], list(pages.CONSTITUENTS), "constituents")
    return pages.constituents(m.select(F.col("symbol").alias("path"), value.alias("value"))).drop("path")


def constituents_by_header(s: SparkSession, d: str) -> DataFrame:
    m = _members(s, d)
    value = _html([F.col("security"), F.col("symbol")], ["Security", "Symbol"], "any")
    return pages.by_header(m.select(F.col("symbol").alias("path"), value.alias("value")), {"symbol": "Symbol", "security": "Security", "sector": "GICS Sector"}).select("symbol", "security", "sector")


def change_log_read(s: SparkSession, d: str) -> DataFrame:
    """Departures written as a page's list of changes and read back."""
    m = table(s, d, "universe_membership").filter("valid_to IS NOT NULL").select("symbol", F.trim(F.regexp_replace("security", r"\s+", " ")).alias("security"), "valid_to")
    cells = [F.date_format("valid_to", "MMMM d, yyyy"), F.lit(""), F.lit(""), F.col("symbol"), F.col("security"), F.lit("left")]
    two = F.replace(_html(cells, ["Date", "Added", "Removed"], "changes"), F.lit("</tr><tr><td>"), F.lit("</tr><tr><th>Ticker</th></tr><tr><td>"))
    return pages.change_log(m.select(F.col("symbol").alias("path"), two.alias("value"))).select("removed_ticker", "removed_security", "effective_date", "reason").distinct()


def wiki_read(s: SparkSession, d: str) -> DataFrame:
    """Members written as wiki tables, with links, bold text and notes, and read back."""
    m = _members(s, d).filter("security <> ''").select("symbol", "security").distinct()
    value = F.concat(F.lit("text\n{| class=x\n! Symbol !! Security\n|-\n| [[Page|"), "symbol", F.lit("]] || '''"), "security", F.lit("'''<ref name=a>note</ref>\n|-\n| only one\n|}\nrest"))
    return pages.wiki_rows(m.select(F.col("symbol").alias("path"), value.alias("value"))).select(F.col("path").alias("symbol"), "row_no", "header", "cell", "dropped")


def company_list(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "universe_membership").select(F.lower("symbol").alias("Symbol"), F.col("security").alias("Security"), F.col("gics_sector").alias("GICS Sector"))
    return pages.companies(m).distinct()


def raw_entries_read(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "sitemap_entries").select(F.to_json(F.array("url", F.coalesce("lastmod", F.lit("")), F.coalesce("title", F.lit("")))).alias("value"))
    broken = s.range(3).select(F.lit("[broken").alias("value"))
    return pages.raw_entries(e.unionByName(broken))


def news_read(s: SparkSession, d: str) -> DataFrame:
    q = table(s, d, "discovered_urls").select("ticker", (F.col("id") * 1000 + 1_600_000_000).alias("datetime"), F.col("title").alias("headline"), F.lit(None).cast("string").alias("summary"), "source", "url", F.lit("general").alias("category"))
    return pages.news(q)


def messages_read(s: SparkSession, d: str) -> DataFrame:
    """Events per user as a paged stream, newest first, up to the first before the range."""
    e = table(s, d, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), (-F.col("event_id")).alias("place"))
    first = e.agg(F.date_sub(F.max("day"), 3).alias("d")).first()["d"]
    return pages.before_first_older(e, "user_id", "place", "day", str(first), "2999-01-01").select("event_id", "user_id")


def search_hits(s: SparkSession, d: str) -> DataFrame:
    """Queue rows as hits of searches: valid addresses in canonical form, the first of each pair, with its query."""
    q = table(s, d, "discovered_urls").filter(urls.is_http(F.col("url")))
    rows = q.select(urls.normalize(F.col("url")).alias("url"), "ticker", "id", F.coalesce("query", F.lit("-")).alias("query"))
    return queue.first_per_key(rows, ["url", "ticker"], ["id"])


def article_pages(s: SparkSession, d: str) -> DataFrame:
    """Addresses of every known site, half of them of articles, told apart by their form."""
    q = table(s, d, "discovered_urls").select("id", F.regexp_replace(F.lower(F.coalesce("title", F.lit("x"))), "[^a-z0-9]+", "-").alias("slug"))
    n = F.col("id").cast("string")
    ok = F.pmod(F.col("id"), F.lit(2)) == 0
    made = {
        "cnbc.com": F.concat(F.lit("https://www.cnbc.com/2024/03/05/"), "slug", F.when(ok, ".html").otherwise("/")), "ft.com": F.concat(F.lit("https://www.ft.com/content/"), F.substring(F.md5(n), 1, 28), F.when(ok, "-abcdef0").otherwise("-abcdefg")),
        "investing.com": F.concat(F.lit("https://www.investing.com/news/"), F.when(ok, "economy").otherwise("sports"), F.lit("/"), "slug", F.lit("-"), n), "nasdaq.com": F.concat(F.lit("https://www.nasdaq.com/articles/"), "slug", F.when(ok, "-2024-03-05").otherwise("-2024")),
        "seekingalpha.com": F.concat(F.lit("https://seekingalpha.com/"), F.when(ok, "article/").otherwise("symbol/"), n, F.lit("-"), "slug"), "stocktwits.com": F.concat(F.lit("https://stocktwits.com/user_1/"), F.when(ok, "message/").otherwise("watch/"), n),
        "yahoo.com": F.concat(F.lit("https://finance.yahoo.com/"), F.when(ok, "news/").otherwise("quote/"), "slug"), "other.test": F.concat(F.lit("https://other.test/"), "slug"),
    }
    rows = q.select("id", F.inline(F.array(*[F.struct(F.lit(k).alias("site"), v.alias("url")) for k, v in made.items()])))
    return rows.select("id", "site", urls.is_article(F.col("url")).alias("article"))


def site_searches(s: SparkSession, d: str) -> DataFrame:
    """What to search each known site for, for every tracked company."""
    u = table(s, d, "universe_membership").groupBy("symbol").agg(F.max("security").alias("company"))
    day = lambda x: F.lit(x).cast("date")
    made = F.array(*[F.struct(F.lit(k).alias("site"), fields.site_searches(k, F.col("company"), F.col("symbol"), day("2023-05-01"), day("2025-01-31")).alias("q")) for k in fields.SEARCHES])
    return u.select("symbol", F.inline(made)).select("symbol", "site", F.posexplode("q").alias("n", "query"))


def cover_symbols(s: SparkSession, d: str) -> DataFrame:
    """Whether a symbol stands near the phrase on a cover page; far behind it for every third, without the phrase for every fifth."""
    u = table(s, d, "universe_membership").select("symbol", "cik").distinct()
    n = F.length("cik") + F.length("symbol")
    gap = F.when(n % 3 == 0, F.repeat(F.lit("word "), 300)).otherwise(F.lit("<td> Common&nbsp;Stock </td>"))
    text = F.concat(F.lit("<p>Cover</p>"), F.when(n % 5 == 0, "Security").otherwise("Trading Symbol(s)"), F.lit(" "), gap, F.lit(" <b>"), "symbol", F.lit("</b> end"))
    return u.select("symbol", "cik", fields.symbol_on_cover(text, F.col("symbol")).alias("found"))


def durations(s: SparkSession, d: str) -> DataFrame:
    """How long each crawl took, in words."""
    c = table(s, d, "sitemap_crawls").filter("finished_at IS NOT NULL")
    took = (F.unix_micros("finished_at") - F.unix_micros("started_at")) / 1_000_000
    return c.select("domain", "started_at", fields.duration(took).alias("took"))


def paywalled_pages(s: SparkSession, d: str) -> DataFrame:
    """What fetched pages are worth by code, site, wording and length; every third site is taken for one behind a wall."""
    a = table(s, d, "articles")
    domain = F.when(F.pmod(F.length("source_domain"), F.lit(3)) == 0, F.lit("ft.com")).otherwise(F.col("source_domain"))
    html = F.concat(F.lit("<p>"), F.coalesce("body_text", F.lit("")), F.when(F.col("id") % 4 == 0, "Subscribe to read").otherwise(""), F.lit("</p>"))
    got = A.fetch_status(F.col("http_status_code"), html, domain, F.coalesce("body_text", F.lit("")))
    return a.select(got.alias("status"), F.coalesce("http_status_code", F.lit(0)).alias("code")).groupBy("status", "code").agg(F.count("*").alias("n"))


def page_fields_read(s: SparkSession, d: str) -> DataFrame:
    """Title, date and author from a page's structured data, or from its meta tags for every third."""
    a = table(s, d, "articles").select("id", F.coalesce("title", F.lit("")).alias("t"), F.coalesce("author", F.lit("")).alias("a"))
    person = F.when(F.col("id") % 2 == 0, F.array(F.struct(F.lit("Person").alias("@type"), F.col("a").alias("name"))))
    graph = F.to_json(F.struct(F.array(F.struct(F.lit("WebSite").alias("@type"), F.lit("n").alias("headline"), F.lit(None).cast("string").alias("datePublished"), F.lit(None).cast("array<struct<`@type`:string,name:string>>").alias("author")), F.struct(F.lit("NewsArticle").alias("@type"), F.col("t").alias("headline"), F.lit("2024-05-06").alias("datePublished"), person.alias("author"))).alias("@graph")))
    attr = lambda c: F.translate(c, '"<>', "   ")
    meta = F.concat(F.lit('<meta property="og:title" content="'), attr("t"), F.lit('"><meta name="author" content="'), attr("a"), F.lit('"><meta property="article:published_time" content="2024-05-07">'))
    page = F.when(F.col("id") % 3 == 0, meta).otherwise(F.concat(F.lit('<script type="application/ld+json">{broken</script><script type="application/ld+json">'), F.replace(graph, F.lit("</"), F.lit("<\\/")), F.lit("</script>")))
    read = a.select("id", A.page_fields_udf()(page).alias("f"))
    return read.select("id", *[F.coalesce(f"f.{c}", F.lit("")).alias(c) for c in ("title", "published", "author")])


def _sheet(s: SparkSession, d: str) -> DataFrame:
    """A sample of pairs with an assistant's labels, and a person's for every third."""
    q = table(s, d, "discovered_urls").filter("id % 10 = 0")
    return q.select("id", "match_class", F.when(F.col("match_class") == "accept", " Yes").otherwise("no").alias("assistant_label"), F.when(F.col("id") % 3 == 0, F.when(F.col("id") % 2 == 0, "yes").otherwise("unclear")).otherwise("").alias("label"))


def merged_labels(s: SparkSession, d: str) -> DataFrame:
    sheet = _sheet(s, d)
    rows = labels.merge_labels(sheet.select("id", "match_class", "assistant_label"), sheet.select("id", "label"))
    return rows.groupBy("match_class", "label").agg(F.count("*").alias("n"), F.count_if("agrees").alias("agreed"))


def label_sheet(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "articles").filter("body_text IS NOT NULL")
    return a.select("id", labels.excerpt(F.regexp_replace("body_text", "[^ -~\n]", "")).alias("excerpt"))


def sheet_problems(s: SparkSession, d: str) -> DataFrame:
    sheet = _sheet(s, d)
    return labels.sheet_problems(sheet.unionByName(sheet.filter("id % 50 = 0")), table(s, d, "articles").select("id"))


def label_differences(s: SparkSession, d: str) -> DataFrame:
    """Figures per class that two ways of counting don't share."""
    q = table(s, d, "discovered_urls")
    mine = q.groupBy("match_class").agg(F.count("*").alias("n"))
    theirs = q.filter("match_class <> 'review' AND id % 2 = 0 OR match_class = 'reject'").groupBy("match_class").agg(F.count("*").alias("n"))
    return labels.differences(mine, theirs, "match_class", "n").select("match_class", F.coalesce("actual", F.lit(0)).alias("actual"), F.coalesce("expected", F.lit(0)).alias("expected"))


def sample_refreshed(s: SparkSession, d: str) -> DataFrame:
    """How many rows of each class an old sample keeps and gets anew, once classes have moved."""
    q = table(s, d, "discovered_urls")
    old = q.filter("id % 20 = 0").select("id", F.col("match_class").alias("stratum"))
    now = q.select("id", F.when((F.col("id") % 40 == 0) & (F.col("match_class") == "review"), "accept").otherwise(F.col("match_class")).alias("stratum"))
    new = labels.refresh(old, now, "stratum", 7)
    return new.join(old.select("id", F.lit(True).alias("kept")), "id", "left").groupBy("stratum").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept"))


def _filings(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").filter("ticker IS NOT NULL AND doc_type IS NOT NULL").select(F.col("ticker").alias("cik"), F.col("doc_type").alias("form"), F.col("published_on").alias("filing_date"), F.col("doc_id").alias("accession_number"))


def filings_latest(s: SparkSession, d: str) -> DataFrame:
    return filings.latest(_filings(s, d), "filing").select("cik", "filing_date", "accession_number")


def filings_listed(s: SparkSession, d: str) -> DataFrame:
    """The ten newest filings, and the filings of a year."""
    f = _filings(s, d)
    ten = filings.listed(f, "filing").select(F.lit("newest").alias("kind"), "accession_number")
    return ten.unionByName(filings.of_year(f, "news", 2024).select(F.lit("of 2024").alias("kind"), "accession_number"))


def filing_years(s: SparkSession, d: str) -> DataFrame:
    return filings.years(_filings(s, d).filter("filing_date IS NOT NULL"))


def filing_picks(s: SparkSession, d: str) -> DataFrame:
    spans = _filings(s, d).select("cik").distinct().select("cik", F.lit("2023-01-01").cast("date").alias("start"), F.lit("2023-12-31").cast("date").alias("end"))
    return filings.picked(_filings(s, d), spans, ("filing", "transcript"))


def filing_mentions(s: SparkSession, d: str) -> DataFrame:
    return filings.mentioning(table(s, d, "documents").filter("text IS NOT NULL").select("doc_id", "text"), "Refinancing").select("doc_id")


def statement_checked(s: SparkSession, d: str) -> DataFrame:
    """Quarterly totals as a statement against filed facts: of priorities one is filed as shown, one with the other sign, one with another value, one never, one twice."""
    o = table(s, d, "orders").select(F.col("o_orderpriority").alias("concept"), F.trunc("o_orderdate", "quarter").alias("q"), F.floor("o_totalprice").alias("v"))
    g = o.groupBy("concept", "q").agg(F.sum("v").cast("double").alias("value")).withColumns({"start": F.col("q").cast("date"), "end_date": F.date_sub(F.add_months(F.col("q").cast("date"), 3), 1)})
    k = F.substring("concept", 1, 1)
    statement = g.select(F.lit(1).alias("row_no"), "concept", F.date_format("end_date", "yyyy-MM-dd").alias("column"), "end_date", F.lit("Q1").alias("kind"), F.when(k == "2", -F.col("value")).when(k == "3", F.col("value") + 500).otherwise(F.col("value")).alias("value"))
    none = F.lit(None).cast("map<string,string>")
    filed = g.filter(k != "4").select("concept", F.col("value"), F.lit("usd").alias("unit_ref"), F.col("start").alias("period_start"), F.col("end_date").alias("period_end"), F.lit(None).cast("date").alias("period_instant"), none.alias("dims"))
    other = filed.filter(F.substring("concept", 1, 1) == "5").withColumn("value", F.col("value") + 7000)
    part = filed.withColumns({"value": F.lit(1.0), "dims": F.create_map(F.lit("axis"), F.lit("part"))})
    out = facts.reconcile(statement, filed.unionByName(other).unionByName(part))
    return out.select("concept", "column", "rendered", F.coalesce("corrected", F.lit(-1.0)).alias("corrected"), "verdict")


def cover_shares(s: SparkSession, d: str) -> DataFrame:
    """Shares on the cover per class and day: the last of each, none with another dimension."""
    p = table(s, d, "part").select(F.col("p_brand"), F.col("p_partkey"), F.col("p_size").cast("double").alias("value"))
    own = F.when(F.col("p_partkey") % 5 == 0, F.create_map(F.lit("other"), F.lit("x"))).when(F.col("p_partkey") % 2 == 0, F.create_map(F.lit("class_of_stock"), F.col("p_brand")))
    rows = p.select("value", own.alias("dims"), F.lit("2024-01-31").cast("date").alias("period_instant"), F.col("p_partkey").alias("ordinal"))
    return facts.cover_shares(rows).select(F.coalesce("share_class", F.lit("all")).alias("share_class"), "day", "shares")


def schema_evolved(s: SparkSession, d: str) -> DataFrame:
    """Queue rows of an older schema brought up to today's."""
    old = table(s, d, "discovered_urls").drop("match_class", "match_reason", "query", "status")
    return schema.evolve(old, "discovered_urls").groupBy("status", "match_class").agg(F.count("*").alias("n"), F.count("query").alias("queries"))


def rule_violations(s: SparkSession, d: str) -> DataFrame:
    q = table(s, d, "discovered_urls")
    return schema.violations(q.withColumns({"match_class": F.when(F.col("id") % 9 == 0, "maybe").otherwise(F.col("match_class")), "ticker": F.when(F.col("id") % 7 == 0, None).otherwise(F.col("ticker"))}))


def _folder(s: SparkSession, name: str) -> str:
    return f"{work_dir(s)}/{name}-{uuid.uuid4().hex}"


def pending_export(s: SparkSession, d: str) -> DataFrame:
    """Pending pairs, written as CSV and read back."""
    at = _folder(s, "pending")
    sinks.export_pending(table(s, d, "discovered_urls").withColumn("title", F.lit("t")), at)
    return s.read.option("header", True).csv(at).select(F.col("id").cast("long").alias("id"), "domain", "ticker")


def news_appended(s: SparkSession, d: str) -> DataFrame:
    """News rows appended in two parts and read back."""
    at, rows = _folder(s, "news"), news_read(s, d).select("ticker", "datetime", "source")
    for part in (0, 1):
        sinks.append_csv(rows.filter(F.pmod(F.length("ticker"), F.lit(2)) == part), at)
    return s.read.option("header", True).csv(at).groupBy("source").agg(F.count("*").alias("n"), F.max("datetime").alias("last"))


def class_lists(s: SparkSession, d: str) -> DataFrame:
    at = _folder(s, "lists")
    sinks.class_lists(table(s, d, "discovered_urls").filter("match_class <> 'accept'").select("id", "ticker", "match_class"), at)
    return s.read.option("header", True).csv(at).groupBy("match_class").agg(F.count("*").alias("n"), F.sum(F.col("id").cast("long")).alias("ids"))


def written_with_manifest(s: SparkSession, d: str) -> DataFrame:
    at = _folder(s, "manifest")
    sinks.write_with_manifest(table(s, d, "sites"), at)
    rows = s.read.json(f"{at}/manifest").select(F.col("rows").cast("long").alias("rows"), F.contains("schema", F.lit("time_zone")).alias("named"))
    return rows


def series_compared(s: SparkSession, d: str) -> DataFrame:
    """Daily totals of events against those of the even users."""
    e = table(s, d, "events").withColumn("day", F.to_date("ts"))
    return series.compare(e.groupBy("day").agg(F.count("*").cast("double").alias("n")), e.filter("user_id % 2 = 0").groupBy("day").agg(F.count("*").cast("double").alias("n")), "day", "n")


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    sitemap_read, sitemap_crawled, feed_read, archive_read, constituents_read, constituents_by_header, change_log_read, wiki_read, company_list, raw_entries_read, news_read, messages_read, search_hits, article_pages, site_searches, cover_symbols,
    durations, paywalled_pages, page_fields_read, merged_labels, label_sheet, sheet_problems, label_differences, sample_refreshed, filings_latest, filings_listed, filing_years, filing_picks, filing_mentions, statement_checked, cover_shares,
    schema_evolved, rule_violations, pending_export, news_appended, class_lists, written_with_manifest, series_compared,
)

_SHEET = "sheet AS (SELECT id, match_class, CASE WHEN match_class = 'accept' THEN 'yes' ELSE 'no' END AS al, CASE WHEN id % 3 = 0 THEN CASE WHEN id % 2 = 0 THEN 'yes' ELSE 'unclear' END END AS ml FROM discovered_urls WHERE id % 10 = 0)"
_FILINGS = "f AS (SELECT ticker AS cik, doc_type AS form, published_on AS filing_date, doc_id AS accession_number FROM documents WHERE ticker IS NOT NULL AND doc_type IS NOT NULL)"
_LENIENT = r"coalesce(TRY_CAST(nullif(regexp_extract(trim({0}), '^(\d{{4}}-\d{{2}}-\d{{2}})(?:$|[T ])', 1), '') AS DATE), TRY_CAST(nullif(regexp_extract(trim({0}), '^(\d{{4}}-\d{{2}})$', 1), '') || '-01' AS DATE))"
_CLEAN = lambda c: f"coalesce(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '')"
_SLUG = "regexp_replace(lower(coalesce(title, 'x')), '[^a-z0-9]+', '-', 'g')"

SQL = {
    "sitemap_read": f"SELECT domain, trim(url) AS loc, CAST({_LENIENT.format('lastmod')} AS VARCHAR) AS lastmod, coalesce(nullif(trim(title), ''), '-') AS title FROM sitemap_entries WHERE trim(url) <> '' AND coalesce({_LENIENT.format('lastmod')} BETWEEN DATE '2023-01-01' AND DATE '2024-12-31', true)",
    "sitemap_crawled": "SELECT arg_max(url, (length(url), url)) AS loc FROM sitemap_entries WHERE length(domain) % 3 <> 0 GROUP BY domain",
    "feed_read": "SELECT id, trim(url) AS link, coalesce(nullif(trim(title), ''), '-') AS title FROM discovered_urls WHERE trim(url) <> ''",
    "archive_read": "SELECT url, CAST(CAST(first_seen AT TIME ZONE 'UTC' AS DATE) AS VARCHAR) AS day FROM sitemap_entries WHERE first_seen IS NOT NULL",
    "constituents_read": f"SELECT upper(trim(symbol, '| ')) AS symbol, {', '.join(f'{_CLEAN(c)} AS {c}' for c in ('security', 'gics_sector', 'gics_sub_industry', 'hq_location', 'date_added', 'cik', 'founded'))} FROM universe_membership",
    "constituents_by_header": f"SELECT symbol, {_CLEAN('security')} AS security, CAST(NULL AS VARCHAR) AS sector FROM universe_membership",
    "change_log_read": f"SELECT DISTINCT upper(symbol) AS removed_ticker, {_CLEAN('security')} AS removed_security, CAST(valid_to AS VARCHAR) AS effective_date, 'left' AS reason FROM universe_membership WHERE valid_to IS NOT NULL",
    "wiki_read": f"WITH m AS (SELECT DISTINCT symbol, {_CLEAN('security')} AS security FROM universe_membership) SELECT symbol, 1 AS row_no, unnest(['Symbol', 'Security']) AS header, unnest([symbol, security]) AS cell, 1 AS dropped FROM m WHERE security <> ''",
    "company_list": "SELECT DISTINCT upper(symbol) AS ticker, nullif(trim(security), '') AS name, nullif(trim(gics_sector), '') AS sector FROM universe_membership WHERE trim(security) <> ''",
    "raw_entries_read": "SELECT url, coalesce(lastmod, '') AS lastmod, coalesce(title, '') AS title FROM sitemap_entries",
    "news_read": "SELECT ticker, strftime(make_timestamp((id * 1000 + 1600000000) * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS datetime, coalesce(title, '') AS headline, '' AS summary, coalesce(source, '') AS source, coalesce(url, '') AS url, 'general' AS category FROM discovered_urls",
    "messages_read": """WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events), b AS (SELECT max(day) - 3 AS b FROM e), m AS (SELECT *, max(CASE WHEN day < b THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM e, b) SELECT event_id, user_id FROM m WHERE stop = 0""",
    "search_hits": rf"WITH q AS (SELECT {O._NORMAL} AS url, ticker, id, coalesce(query, '-') AS query FROM discovered_urls WHERE regexp_matches(url, '^[hH][tT][tT][pP][sS]?://[^/?#]+')) SELECT url, ticker, min(id) AS id, arg_min(query, id) AS query FROM q GROUP BY url, ticker",
    "article_pages": rf"""WITH q AS (SELECT id, {_SLUG} AS slug, id % 2 = 0 AS ok FROM discovered_urls)
SELECT id, site, CASE WHEN site = 'other.test' THEN NULL WHEN site = 'cnbc.com' THEN ok AND regexp_full_match(slug, '[a-z0-9-]+') ELSE ok END AS article FROM q, (VALUES ('cnbc.com'), ('ft.com'), ('investing.com'), ('nasdaq.com'), ('seekingalpha.com'), ('stocktwits.com'), ('yahoo.com'), ('other.test')) t(site)""",
    "site_searches": """WITH u AS (SELECT symbol, max(security) AS company FROM universe_membership GROUP BY symbol), y AS (SELECT unnest([2023, 2024, 2025]) AS y),
r AS (SELECT symbol, 'cnbc.com' AS site, y - 2023 AS n, 'site:cnbc.com ' || symbol || ' ' || y AS query FROM u, y UNION ALL SELECT symbol, 'cnbc.com', 3, 'site:cnbc.com ' || company || ' stock news' FROM u
UNION ALL SELECT symbol, 'ft.com', 2 * (y - 2023), 'site:ft.com ' || symbol || ' ' || y FROM u, y UNION ALL SELECT symbol, 'ft.com', 2 * (y - 2023) + 1, 'site:ft.com "' || company || '" ' || y FROM u, y
UNION ALL SELECT symbol, 'investing.com', 2 * (y - 2023), 'site:investing.com/news ' || symbol || ' ' || y FROM u, y UNION ALL SELECT symbol, 'investing.com', 2 * (y - 2023) + 1, 'site:investing.com/news "' || company || '" ' || y FROM u, y
UNION ALL SELECT symbol, 'nasdaq.com', y - 2023, 'site:nasdaq.com/articles ' || symbol || ' ' || y FROM u, y UNION ALL SELECT symbol, 'seekingalpha.com', y - 2023, 'site:seekingalpha.com/article ' || symbol || ' ' || y FROM u, y UNION ALL SELECT symbol, 'seekingalpha.com', 3, 'site:seekingalpha.com "' || symbol || '" analysis' FROM u
UNION ALL SELECT symbol, 'stocktwits.com', y - 2023, 'site:stocktwits.com ' || symbol || ' ' || y FROM u, y UNION ALL SELECT symbol, 'finance.yahoo.com', y - 2023, 'site:finance.yahoo.com ' || symbol || ' news ' || y FROM u, y) SELECT symbol, site, CAST(n AS INTEGER) AS n, query FROM r""",
    "cover_symbols": "SELECT DISTINCT symbol, cik, CASE WHEN (length(cik) + length(symbol)) % 5 <> 0 THEN (length(cik) + length(symbol)) % 3 <> 0 WHEN cik IS NULL THEN true END AS found FROM universe_membership",
    "durations": "SELECT domain, epoch_us(started_at) AS started_at, CASE WHEN s >= 3600 THEN (s // 3600) || 'h' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' WHEN s >= 60 THEN (s // 60) || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' ELSE s || 's' END AS took FROM (SELECT *, (epoch_us(finished_at) - epoch_us(started_at)) // 1000000 AS s FROM sitemap_crawls WHERE finished_at IS NOT NULL)",
    "paywalled_pages": f"""WITH p AS (SELECT coalesce(http_status_code, 0) AS code, CASE WHEN coalesce(http_status_code, 599) >= 400 THEN 'failed' WHEN (length(source_domain) % 3 = 0 OR source_domain IN ('ft.com', 'seekingalpha.com'))
  AND (id % 4 = 0 OR contains(lower(coalesce(body_text, '')), 'subscribe to continue reading') OR contains(lower(coalesce(body_text, '')), 'subscribe to read') OR contains(lower(coalesce(body_text, '')), 'this content is for subscribers') OR contains(lower(coalesce(body_text, '')), 'to continue reading this article')) THEN 'paywalled'
  WHEN len(list_filter(regexp_split_to_array(coalesce(body_text, ''), '\\s+'), lambda w: w <> '')) < 80 THEN 'thin_content' ELSE coalesce((SELECT {O._WALL} FROM (SELECT lower(substr(coalesce(body_text, ''), 1, 300)) AS h)), 'ok') END AS status FROM articles) SELECT status, code, count(*) AS n FROM p GROUP BY ALL""",
    "page_fields_read": """SELECT id, CASE WHEN id % 3 = 0 THEN translate(coalesce(title, ''), '"<>', '   ') ELSE coalesce(title, '') END AS title, CASE WHEN id % 3 = 0 THEN '2024-05-07' ELSE '2024-05-06' END AS published, CASE WHEN id % 3 = 0 THEN translate(coalesce(author, ''), '"<>', '   ') WHEN id % 2 = 0 THEN coalesce(author, '') ELSE '' END AS author FROM articles""",
    "merged_labels": f"WITH {_SHEET} SELECT match_class, coalesce(ml, al) AS label, count(*) AS n, count(*) FILTER (ml = al) AS agreed FROM sheet GROUP BY ALL",
    "label_sheet": r"SELECT id, substr(trim(regexp_replace(trim(regexp_replace(body_text, '[^ -~\n]', '', 'g')), '\s+', ' ', 'g')), 1, 400) AS excerpt FROM articles WHERE body_text IS NOT NULL",
    "sheet_problems": f"WITH {_SHEET} SELECT (SELECT count(*) FROM sheet WHERE id % 50 = 0) AS repeated, (SELECT count(*) FROM sheet WHERE id IN (SELECT id FROM articles)) AS reused, (SELECT count(*) FILTER (ml IS NULL) + count(*) FILTER (ml IS NULL AND id % 50 = 0) FROM sheet) AS unlabelled",
    "label_differences": "SELECT * FROM (SELECT match_class, count(*) AS actual, count(*) FILTER (match_class <> 'review' AND id % 2 = 0 OR match_class = 'reject') AS expected FROM discovered_urls GROUP BY match_class) WHERE actual <> expected",
    "sample_refreshed": "SELECT match_class AS stratum, count(*) AS n, count(*) FILTER (NOT (id % 40 = 0 AND match_class = 'review')) AS kept FROM discovered_urls WHERE id % 20 = 0 GROUP BY match_class",
    "filings_latest": f"WITH {_FILINGS} SELECT cik, CAST(filing_date AS VARCHAR) AS filing_date, accession_number FROM (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY filing_date DESC NULLS LAST, accession_number DESC) AS k FROM f WHERE form = 'filing') WHERE k = 1",
    "filings_listed": f"WITH {_FILINGS} SELECT 'newest' AS kind, accession_number FROM (SELECT * FROM f WHERE form = 'filing' ORDER BY filing_date DESC, accession_number DESC LIMIT 10) UNION ALL SELECT 'of 2024', accession_number FROM f WHERE form = 'news' AND year(filing_date) = 2024",
    "filing_years": f"WITH {_FILINGS} SELECT DISTINCT cik, CAST(year(filing_date) AS INTEGER) AS year FROM f WHERE filing_date IS NOT NULL",
    "filing_picks": f"""WITH {_FILINGS}, r AS (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY (filing_date >= DATE '2023-01-01') DESC, form = 'transcript', filing_date DESC) AS k FROM f WHERE form IN ('filing', 'transcript') AND filing_date <= DATE '2023-12-31')
SELECT cik, '2023-01-01' AS start, '2023-12-31' AS "end", form, CAST(filing_date AS VARCHAR) AS filing_date FROM r WHERE k = 1""",
    "filing_mentions": "SELECT doc_id FROM documents WHERE contains(lower(text), 'refinancing')",
    "statement_checked": """WITH g AS (SELECT o_orderpriority AS concept, date_trunc('quarter', o_orderdate) AS q, CAST(sum(floor(o_totalprice)) AS DOUBLE) AS v FROM orders GROUP BY ALL), c AS (SELECT concept, substr(concept, 1, 1) AS k, strftime(q + INTERVAL 3 MONTH - INTERVAL 1 DAY, '%Y-%m-%d') AS "column", v FROM g)
SELECT concept, "column", CASE k WHEN '2' THEN -v WHEN '3' THEN v + 500 ELSE v END AS rendered, CASE k WHEN '2' THEN -v WHEN '3' THEN v WHEN '4' THEN -1.0 ELSE v END AS corrected, CASE k WHEN '3' THEN 'corrected' WHEN '4' THEN 'unfiled' WHEN '5' THEN 'ambiguous' ELSE 'equal' END AS verdict FROM c""",
    "cover_shares": "SELECT CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'all' END AS share_class, '2024-01-31' AS day, CAST(arg_max(p_size, p_partkey) AS DOUBLE) AS shares FROM part WHERE p_partkey % 5 <> 0 GROUP BY 1",
    "schema_evolved": "SELECT 'pending' AS status, 'accept' AS match_class, count(*) AS n, 0 AS queries FROM discovered_urls",
    "rule_violations": "SELECT 'match_class' AS problem, count(*) FILTER (id % 9 = 0) AS n FROM discovered_urls UNION ALL SELECT 'no url', count(*) FILTER (url IS NULL) FROM discovered_urls UNION ALL SELECT 'no ticker', count(*) FILTER (id % 7 = 0 OR ticker IS NULL) FROM discovered_urls",
    "pending_export": "SELECT id, domain, ticker FROM discovered_urls WHERE status = 'pending'",
    "news_appended": "SELECT source, count(*) AS n, strftime(make_timestamp((max(id) * 1000 + 1600000000) * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS last FROM discovered_urls GROUP BY source",
    "class_lists": "SELECT match_class, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM discovered_urls WHERE match_class <> 'accept' GROUP BY match_class",
    "written_with_manifest": "SELECT count(*) AS rows, true AS named FROM sites",
    "series_compared": "WITH a AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (user_id % 2 = 0) AS m FROM events GROUP BY 1) SELECT count(*) FILTER (m > 0) AS shared, count(*) FILTER (m = 0) AS only_a, 0 AS only_b, CAST(max(CASE WHEN m > 0 THEN n - m END) AS DOUBLE) AS max_difference FROM a",
}
