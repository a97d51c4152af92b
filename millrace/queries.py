"""Registered queries of the core: name -> (spark, sf_dir) -> DataFrame, with SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace import reader_queries, stored_queries
from millrace.functions import articles as A
from millrace.functions import calendar, fields, matching, urls
from millrace.operators import asof, audit, crawls, history, labels, membership, moments, preselect, queue, series
from millrace.operators.store import BucketStore
from millrace.session import work_dir
from millrace.sources.tables import table
from millrace.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]


def _p2_found(s: SparkSession, d: str) -> DataFrame:
    return asof.found(table(s, d, "articles"), table(s, d, "universe_membership"), table(s, d, "sites"))


def _p2_attributes(s: SparkSession, d: str) -> DataFrame:
    return asof.attributes_at_publication(table(s, d, "articles"), table(s, d, "universe_membership"), table(s, d, "sites"))


def _p6_found(s: SparkSession, d: str) -> DataFrame:
    return history.found(table(s, d, "roster_snapshots"), table(s, d, "universe_membership"))


def _p6_versions(s: SparkSession, d: str) -> DataFrame:
    return history.versions(table(s, d, "roster_snapshots"), table(s, d, "universe_membership"))


def _p7_found(s: SparkSession, d: str) -> DataFrame:
    return moments.found(table(s, d, "discovered_urls"), table(s, d, "sitemap_entries"), table(s, d, "sites"))


def _p7_undeclared(s: SparkSession, d: str) -> DataFrame:
    """All moments with no date order declared: every order of day and month is chosen by Viterbi."""
    sites = table(s, d, "sites").withColumn("date_order", F.lit(None).cast("string"))
    return moments.moments_of(table(s, d, "discovered_urls"), table(s, d, "sitemap_entries"), sites, True)


def url_normalize(s: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return table(s, d, "discovered_urls").select("id", urls.normalize(u).alias("normal"), urls.host(u).alias("host"), urls.is_http(u).alias("valid"), F.coalesce(urls.year(u), F.lit(0)).alias("year"))


def url_first(s: SparkSession, d: str) -> DataFrame:
    """The first row of each canonical URL and ticker."""
    rows = table(s, d, "discovered_urls").select(urls.normalize(F.col("url")).alias("url"), "ticker", "id", "source", "status")
    return queue.first_per_key(rows, ["url", "ticker"], ["id"])


def sitemap_duplicates(s: SparkSession, d: str) -> DataFrame:
    return crawls.duplicates(table(s, d, "sitemap_entries"))


def queue_stats(s: SparkSession, d: str) -> DataFrame:
    return queue.stats(table(s, d, "discovered_urls"))


def queue_page(s: SparkSession, d: str) -> DataFrame:
    """The second page of accepted pairs of a part of a name, newest id first."""
    return queue.page(table(s, d, "discovered_urls"), match_class="accept", company_part="HOLDINGS", order_by="id", descending=True, limit=50, offset=50)[0].select("id", "url", "ticker", "company", "status")


def queue_page_total(s: SparkSession, d: str) -> DataFrame:
    return queue.page(table(s, d, "discovered_urls"), match_class="accept", company_part="HOLDINGS")[1]


def queue_merge(s: SparkSession, d: str) -> DataFrame:
    """The queue after its rediscoveries: first rows of each pair as stored, all later rows as one batch."""
    rows = table(s, d, "discovered_urls")
    first = queue.first_per_key(rows, ["url", "ticker"], ["id"])
    later = rows.join(first.select("id"), "id", "left_anti").withColumn("ordinal", F.col("id"))
    return queue.merge(first, later).select("id", "url", "ticker", "status", "match_class", "match_reason", "query")


def table_fingerprint(s: SparkSession, d: str) -> DataFrame:
    return queue.fingerprint(table(s, d, "discovered_urls"), table(s, d, "articles"))


def unfinished_pairs(s: SparkSession, d: str) -> DataFrame:
    """Pairs of company and site that no queue row has yet."""
    q = table(s, d, "discovered_urls")
    return queue.unfinished(q, table(s, d, "sites"), q)


def _titled(s: SparkSession, d: str) -> DataFrame:
    """Pairs with the queue's title or, where it has none, the article's."""
    articles = table(s, d, "articles").select("id", F.col("title").alias("_t"))
    rows = table(s, d, "discovered_urls").join(articles, "id", "left")
    return rows.withColumn("title", F.coalesce(F.nullif("title", F.lit("")), F.col("_t"), F.lit(""))).drop("_t")


def _classified(s: SparkSession, d: str) -> DataFrame:
    rows = matching.with_company(matching.text_columns(_titled(s, d).withColumnsRenamed({"match_class": "stored_class", "match_reason": "stored_reason"})))
    return matching.classified(rows)


def match_classify(s: SparkSession, d: str) -> DataFrame:
    return _classified(s, d).select("id", "match_class", "match_reason")


def class_transitions(s: SparkSession, d: str) -> DataFrame:
    return _classified(s, d).groupBy("stored_class", "match_class").agg(F.count("*").alias("n"))


def _entries(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "sitemap_entries").select(urls.normalize(F.col("url")).alias("url"), "title")
    return e.groupBy("url").agg(F.max("title").alias("title")).withColumn("entry_id", F.col("url"))


def _companies(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "universe_membership").groupBy(F.col("symbol").alias("ticker")).agg(F.max("security").alias("company"))


def match_preselect(s: SparkSession, d: str) -> DataFrame:
    """Sitemap entries against all tracked companies, by rare tokens."""
    return preselect.matches(_entries(s, d), _companies(s, d)).select(F.col("entry_id").alias("url"), "ticker", "match_class", "match_reason")


def match_counts(s: SparkSession, d: str) -> DataFrame:
    return match_preselect(s, d).groupBy("ticker").agg(F.count("*").alias("pairs"), F.count_if(F.col("match_class") == "accept").alias("accepted"))


def mode_audit(s: SparkSession, d: str) -> DataFrame:
    return audit.mode_audit(table(s, d, "discovered_urls"))


def quality_audit(s: SparkSession, d: str) -> DataFrame:
    return audit.quality_audit(table(s, d, "articles"))


def wall_by_status(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "articles").select("fetch_status", A.wall_kind(F.coalesce("body_text", F.lit(""))).alias("wall"))
    return a.groupBy("fetch_status").agg(F.count("*").alias("rows"), F.count_if(F.col("wall") == "failed").alias("failed"), F.count_if(F.col("wall") == "paywalled").alias("paywalled"))


def article_words(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "articles").filter("body_text IS NOT NULL").select("id", A.word_count(F.col("body_text")).alias("words"), (A.word_count(F.col("body_text")) < A.THIN).alias("thin"))


def latest_crawls(s: SparkSession, d: str) -> DataFrame:
    return crawls.latest_complete(table(s, d, "sitemap_crawls"))


def crawl_gaps(s: SparkSession, d: str) -> DataFrame:
    return crawls.gaps(table(s, d, "sitemap_crawls"))


def current_entries(s: SparkSession, d: str) -> DataFrame:
    return crawls.current_entries(table(s, d, "sitemap_entries"), table(s, d, "sitemap_crawls")).select("domain", "url", "lastmod", "last_seen")


def entry_upsert(s: SparkSession, d: str) -> DataFrame:
    """Entries of both halves of the sightings, merged without setting any sighting back."""
    e = table(s, d, "sitemap_entries")
    half = F.pmod(F.length("url"), F.lit(2)) == 0
    return crawls.upsert(e.filter(half), e.filter(~half).unionByName(e.filter(half)))


def membership_as_of(s: SparkSession, d: str) -> DataFrame:
    return membership.as_of(table(s, d, "universe_membership"), "2023-06-30")


def members_by_day(s: SparkSession, d: str) -> DataFrame:
    days = table(s, d, "roster_snapshots").select(F.col("snapshot_date").alias("day")).distinct()
    return membership.members_on(table(s, d, "universe_membership"), days)


def closed_targets(s: SparkSession, d: str) -> DataFrame:
    return membership.closed_targets(table(s, d, "universe_membership"), "2022-01-01")


def snapshot_changes(s: SparkSession, d: str) -> DataFrame:
    return membership.snapshot_changes(table(s, d, "roster_snapshots"))


def resolve_names(s: SparkSession, d: str) -> DataFrame:
    """First words of company names, and symbols in lower case, looked up as a symbol or part of a name."""
    u = table(s, d, "universe_membership")
    asked = u.select(F.split_part("security", F.lit(" "), F.lit(1)).alias("query")).unionByName(u.select(F.lower("symbol").alias("query")))
    return membership.resolve(u.select("symbol", "security").distinct(), asked)


def strata_sample(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "discovered_urls").withColumn("stratum", F.concat_ws("/", "domain", "source"))
    return audit.sample(rows.select("id", "stratum"), "stratum", 8, 54)


def strata_rates(s: SparkSession, d: str) -> DataFrame:
    """Rate of stored rejects that the rule would take, per domain, weighted by source."""
    rows = _classified(s, d).withColumn("stratum", F.concat_ws("/", "domain", "source"))
    cells = rows.groupBy("domain", "stratum").agg(F.count("*").alias("n"), F.count_if(F.col("match_class") != F.col("stored_class")).alias("k"), F.count("*").alias("size"))
    return audit.rate_of_strata(cells, "domain")


def deletable_pairs(s: SparkSession, d: str) -> DataFrame:
    """Pairs that may go, per domain: none of the ids that the strata sample holds."""
    last = crawls.latest_complete(table(s, d, "sitemap_crawls"))
    rows = queue.deletable(table(s, d, "discovered_urls"), table(s, d, "articles"), last, strata_sample(s, d))
    return rows.groupBy("domain").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def rule_scores(s: SparkSession, d: str) -> DataFrame:
    """How well simpler rules would find the stored accepts among fetched pairs."""
    q = table(s, d, "discovered_urls").select("id", "url", "title", "company", "ticker", (F.col("match_class") == "accept").alias("actual"))
    pairs = q.join(table(s, d, "articles").select("id", F.col("title").alias("_t"), F.col("body_text").alias("body")), "id")
    verdicts = audit.rule_verdicts(pairs.withColumn("title", F.coalesce(F.nullif("title", F.lit("")), "_t")))
    return audit.confusion(verdicts, F.col("predicted"), F.col("actual"), "rule")


def class_confusion(s: SparkSession, d: str) -> DataFrame:
    return audit.confusion(_classified(s, d), F.col("match_class") == "accept", F.col("stored_class") == "accept", "source")


def wilson_by_source(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "discovered_urls").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "failed").alias("k"))
    low, high = audit.wilson(F.col("k").cast("double"), F.col("n").cast("double"))
    return g.select("source", "n", "k", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


def top_tickers(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "discovered_urls").groupBy("ticker").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ticker").limit(20)


def trading_sessions(s: SparkSession, d: str) -> DataFrame:
    return calendar.sessions(s, "2021-01-01", "2025-12-31")


def quiet_sessions(s: SparkSession, d: str) -> DataFrame:
    """Sessions on which no article was fetched."""
    days = table(s, d, "articles").select(F.to_date("fetched_at").alias("day")).distinct()
    return calendar.sessions(s, "2024-01-01", "2025-12-31").join(days, "day", "left_anti").select("day")


def date_windows(s: SparkSession, d: str) -> DataFrame:
    w = calendar.windows(s, "2024-01-01", "2025-12-31", 7)
    a = table(s, d, "articles").select(F.to_date("fetched_at").alias("day"))
    return a.join(F.broadcast(w), F.col("day").between(F.col("first"), F.col("last"))).groupBy("first", "last").agg(F.count("*").alias("n"))


def _events(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def busiest_hour(s: SparkSession, d: str) -> DataFrame:
    return series.busiest(_events(s, d), "event_type", "ts", 3_600_000_000)


def user_sessions(s: SparkSession, d: str) -> DataFrame:
    return series.sessionize(_events(s, d), "user_id", "ts", 1800)


def daily_change(s: SparkSession, d: str) -> DataFrame:
    """Change of each event type's daily total against the day before it."""
    g = _events(s, d).groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum(F.when(~F.isnan("value"), F.col("value"))).alias("total"))
    return g.select("event_type", "day", F.round(series.change_ratio(F.col("total"), "event_type", "day"), 6).alias("change"))


def name_mentions(s: SparkSession, d: str) -> DataFrame:
    """How often an article's body has its company's full name."""
    a = table(s, d, "articles").filter("body_text IS NOT NULL AND company IS NOT NULL").select("id", matching.full_name(F.col("company")).alias("n"), matching.flat(F.col("body_text")).alias("b"))
    return a.filter("n <> ''").select("id", (F.size(F.split("b", F.concat(F.lit("\\Q "), F.col("n"), F.lit(" \\E")), -1)) - 1).alias("mentions"))


def field_formats(s: SparkSession, d: str) -> DataFrame:
    """Identifiers and dates of the roster in one form."""
    r = table(s, d, "roster_snapshots").select("symbol", "cik", "date_added").distinct()
    return r.select("symbol", fields.cik(F.col("cik")).alias("cik"), fields.written_date(F.col("date_added")).alias("added"), fields.span_class(fields.written_date(F.col("date_added")), F.lit("2025-06-30").cast("date")).alias("span")).distinct()


def search_texts(s: SparkSession, d: str) -> DataFrame:
    """What to search each site for, for every company that the queue has of it."""
    top = table(s, d, "discovered_urls").select("domain", "company", "ticker").distinct()
    day = lambda x: F.lit(x).cast("date")
    return top.select("domain", "ticker", F.explode(fields.search_texts(F.col("domain"), F.col("company"), F.col("ticker"), day("2021-03-01"), day("2025-11-30"))).alias("query")).distinct()


def name_presence(s: SparkSession, d: str) -> DataFrame:
    """Pairs whose address or title has the company's name, and whose path has it as a slug, per class."""
    q = table(s, d, "discovered_urls")
    c = F.col("company")
    return q.groupBy("match_class").agg(F.count("*").alias("n"), F.count_if(fields.full_name_present(c, F.col("url"), F.col("title"))).alias("named"), F.count_if(fields.slug_present(c, F.col("url"))).alias("slugged"))


def stored_presence(s: SparkSession, d: str) -> DataFrame:
    """Stored URLs by year of their address: still in the latest complete crawl, seen before only, never in a sitemap."""
    now = crawls.current_entries(table(s, d, "sitemap_entries"), table(s, d, "sitemap_crawls")).select(urls.normalize(F.col("url")).alias("url")).distinct().withColumn("now", F.lit(True))
    ever = table(s, d, "sitemap_entries").select(urls.normalize(F.col("url")).alias("url")).distinct().withColumn("ever", F.lit(True))
    own = table(s, d, "discovered_urls").select(urls.normalize(F.col("url")).alias("url")).distinct()
    kind = F.when(F.col("now"), "listed").when(F.col("ever"), "left").otherwise("never")
    return own.join(now, "url", "left").join(ever, "url", "left").groupBy(F.coalesce(urls.year(F.col("url")), F.lit(0)).alias("year"), kind.alias("kind")).agg(F.count("*").alias("n"))


def label_weights(s: SparkSession, d: str) -> DataFrame:
    """Grades of documents, each standing for all documents of its type."""
    docs = table(s, d, "documents").withColumn("doc_type", F.coalesce("doc_type", F.lit("?")))
    rows = table(s, d, "reading_labels").withColumnRenamed("grade_level", "label").join(docs.select("doc_id", "doc_type"), "doc_id")
    g = labels.weighted(rows, docs.groupBy("doc_type").agg(F.count("*").alias("size")), ["doc_type"])
    return g.select("doc_type", "label", "n", F.round("weight", 6).alias("weight"))


def stints_from_log(s: SparkSession, d: str) -> DataFrame:
    """Stints of symbols rebuilt from a log of joins and leaves and the last roster."""
    snaps = table(s, d, "roster_snapshots")
    log = membership.snapshot_changes(snaps).select("symbol", F.col("snapshot_date").alias("effective_date"), F.when(F.col("change") == "joined", "add").otherwise("remove").alias("kind"), F.lit(0).alias("ordinal"))
    last = snaps.agg(F.max("snapshot_date").alias("snapshot_date"))
    roster = snaps.join(F.broadcast(last), "snapshot_date", "left_semi").select(F.upper(F.trim("symbol")).alias("symbol"), F.lit(None).cast("date").alias("date_added")).distinct()
    return membership.stints_from_changes(log, roster, "2023-01-31")


def membership_spans(s: SparkSession, d: str) -> DataFrame:
    """Stints of all symbols that left, a row each."""
    u = table(s, d, "universe_membership")
    rows = membership.spans(u, u.filter("valid_to IS NOT NULL")).select("symbol", F.posexplode("stints").alias("n", "x"))
    return rows.select("symbol", (F.col("n") + 1).cast("long").alias("n"), "x.valid_from", "x.valid_to")


def ticker_names(s: SparkSession, d: str) -> DataFrame:
    u = table(s, d, "universe_membership")
    asked = table(s, d, "discovered_urls").select("ticker").unionByName(table(s, d, "articles").select("ticker")).filter("ticker IS NOT NULL")
    return membership.names(asked, u.filter("valid_to IS NULL"), u, "2021-06-30")


def label_stability(s: SparkSession, d: str) -> DataFrame:
    u = table(s, d, "universe_membership").filter("gics_revision_timestamp IS NOT NULL")
    rows = u.select(F.to_timestamp("gics_revision_timestamp").alias("ts"), "symbol", "cik", F.lower("gics_sub_industry").alias("label")).distinct()
    out = membership.label_stability(rows)
    return out.groupBy(F.coalesce(F.col("same").cast("string"), F.lit("none older")).alias("same")).agg(F.count("*").alias("n"))


def run_summary(s: SparkSession, d: str) -> DataFrame:
    """What fetching came to per domain, with its commonest error codes."""
    q = table(s, d, "discovered_urls")
    runs = q.select("domain", "ticker", F.when(F.col("status") == "done", 1).otherwise(0).alias("inserted"), F.when(F.col("fetch_status_code") >= 400, F.col("fetch_status_code").cast("string")).alias("error"))
    return queue.run_summary(runs)


def last_revisions(s: SparkSession, d: str) -> DataFrame:
    u = table(s, d, "universe_membership")
    revisions = u.filter("gics_revision_timestamp IS NOT NULL").select(F.col("gics_revision_id").alias("revid"), F.to_timestamp("gics_revision_timestamp").alias("ts"), "symbol", "cik", "gics_sector").distinct()
    stints = u.filter("valid_to IS NOT NULL").select("symbol", "cik", "valid_from", "valid_to").distinct()
    return membership.last_revision(stints, revisions).withColumn("depth", F.coalesce("depth", F.lit(-1)))


def stream_hours(s: SparkSession, d: str) -> DataFrame:
    """Events per hour and type, counted by a stream."""
    events = ingest.file_stream(s, f"{d.rstrip('/')}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return ingest.settle(ingest.event_counts(events, "1 hour", "1 hour"), "hours")


def stream_queue(s: SparkSession, d: str) -> DataFrame:
    """The queue that a stream of all its rows builds from nothing."""
    base = f"{work_dir(s)}/queue-{uuid.uuid4().hex}"
    store = BucketStore(s, f"{base}/store", ["url", "ticker"])
    ingest.ingest(ingest.file_stream(s, f"{d.rstrip('/')}/discovered_urls.parquet"), store, f"{base}/checkpoint").awaitTermination()
    return store.read().select("url", "ticker", "status", "match_class", "query")


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text and timestamps as microseconds: values that any two engines write alike."""
    kinds = {"date": lambda c: F.col(c).cast("string"), "timestamp": lambda c: F.unix_micros(c)}
    return df.select(*[kinds[t](c).alias(c) if t in kinds else F.col(c) for c, t in df.dtypes])


def _named(*fs: Query) -> dict[str, Query]:
    return {f.__name__: (lambda s, d, f=f: _plain(f(s, d))) for f in fs}


def queries() -> dict[str, Query]:
    return {
        "p2_found": _p2_found,
        "p2_attributes": _p2_attributes,
        "p6_found": _p6_found,
        "p6_versions": _p6_versions,
        "p7_found": _p7_found,
        "p7_undeclared": _p7_undeclared,
    } | _named(
        url_normalize, url_first, sitemap_duplicates, queue_stats, queue_page, queue_page_total, queue_merge, table_fingerprint, unfinished_pairs,
        match_classify, class_transitions, match_preselect, match_counts, mode_audit, quality_audit, wall_by_status, article_words,
        latest_crawls, crawl_gaps, current_entries, entry_upsert, membership_as_of, members_by_day, closed_targets, snapshot_changes, resolve_names,
        membership_spans, ticker_names, label_stability, run_summary, field_formats, search_texts, name_presence, stored_presence, label_weights, stints_from_log, last_revisions,
        stream_hours, stream_queue, deletable_pairs, rule_scores, strata_sample, strata_rates, class_confusion, wilson_by_source, top_tickers, trading_sessions, quiet_sessions, date_windows, busiest_hour, user_sessions, daily_change, name_mentions,
        *stored_queries.QUERIES, *reader_queries.QUERIES,
    )
