"""The queue of discovered pairs: counts, pages of it, duplicates, and merging of rediscoveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.matching import RANK
from millrace.session import small_enough

#: Sites that may be set against all companies.
SITES = 10_000

#: fixed values: columns that a page may be ordered by
ORDER_COLUMNS = ("id", "url", "domain", "company", "ticker", "source", "discovered_at", "pub_date", "status", "match_class")


def rank(cls: Column) -> Column:
    """reject 0, review 1, accept 2; null for anything else."""
    return F.try_element_at(F.create_map(*[x for k, v in RANK.items() for x in (F.lit(k), F.lit(v))]), cls)


def stats(queue: DataFrame) -> DataFrame:
    """(kind, value, n): the total and the counts by status, domain and class, in one pass."""
    g = queue.groupingSets([[], ["status"], ["domain"], ["match_class"]], "status", "domain", "match_class")
    g = g.agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    kind = F.when(F.col("g") == 3, "status").when(F.col("g") == 5, "domain").when(F.col("g") == 6, "match_class").otherwise("total")
    value = F.when(F.col("g") == 3, F.col("status")).when(F.col("g") == 5, F.col("domain")).when(F.col("g") == 6, F.col("match_class"))
    return g.select(kind.alias("kind"), value.alias("value"), "n")


def page(
    queue: DataFrame, *, domain: str | None = None, ticker: str | None = None, status: str | None = None, source: str | None = None, match_class: str | None = None,
    company_part: str | None = None, url_part: str | None = None, since: str | None = None, until: str | None = None, order_by: str = "id", descending: bool = False, limit: int = 100, offset: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """(rows of one page, a row with the total before paging). Text parts match without case; bounds compare ``pub_date`` as text."""
    if order_by not in ORDER_COLUMNS:
        raise ValueError(f"not a column to order by: {order_by}")
    rows = queue
    for name, value in (("domain", domain), ("ticker", ticker), ("status", status), ("source", source), ("match_class", match_class)):
        if value is not None:
            rows = rows.filter(F.col(name) == value)
    for name, value in (("company", company_part), ("url", url_part)):
        if value is not None:
            rows = rows.filter(F.lower(F.col(name)).contains(value.lower()))
    if since is not None:
        rows = rows.filter(F.col("pub_date") >= since)
    if until is not None:
        rows = rows.filter(F.col("pub_date") <= until)
    order = F.col(order_by).desc() if descending else F.col(order_by).asc()
    return rows.orderBy(order, "id").offset(offset).limit(limit), rows.agg(F.count("*").alias("total"))


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order: by a minimum, which combines before the shuffle."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    picked = rows.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in (*order, *rest)]).select(*rows.columns)


def numbered_rows(rows: DataFrame, at: str, ties: list[str], block: int = 1 << 16) -> DataFrame:
    """``rows`` with ``n``, their number from 1 in order of the long ``at``: counted by block, so that no task sorts them all."""
    blocked = rows.withColumn("_block", F.floor(F.col(at) / block).cast("long"))
    sizes = blocked.groupBy("_block").agg(F.count("*").alias("_n"))
    # a row per block of ``block`` values
    before = sizes.select("_block", F.coalesce(F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_block").orderBy(at, *ties))
    return blocked.join(before, "_block").withColumn("n", own + F.col("_before")).drop("_block", "_before")


def merge(stored: DataFrame, batch: DataFrame, top: DataFrame | None = None) -> DataFrame:
    """``stored`` after a batch of rediscoveries: new pairs appended, known pairs promoted, none demoted.

    A pair is (url, ticker). Within the batch, rows of one pair act in order of ``ordinal``. A higher class
    brings its reason along; an equal or lower one only fills a missing reason or query; a pair stored as
    ``reject`` and ``skipped`` goes back to ``pending`` when its class rises. New pairs get ids after the
    greatest, in order; a new ``reject`` is stored ``skipped``. Rows of an unknown class or a null key are left out.
    ``top`` (top), a row, is the greatest id where ``stored`` is only the part of the queue that the batch can touch.
    """
    keys = ["url", "ticker"]
    ok = batch.filter(rank(F.col("match_class")).isNotNull() & F.col("url").isNotNull() & F.col("ticker").isNotNull())
    r = rank(F.col("match_class"))
    # the first of the highest class wins; reasons and queries fill in from the first that has one
    filled = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("ordinal", c)))[c]
    best = ok.groupBy(*keys).agg(
        F.max(r).alias("b_rank"), F.min(F.struct((-r).alias("k"), "ordinal", "match_class", "match_reason")).alias("b"), filled("query").alias("b_query"), filled("match_reason").alias("b_any_reason"),
        F.min(F.struct("ordinal", "domain", "company", "source", "discovered_at", "pub_date", "title", "status", "fetch_status_code")).alias("b_first"),
    )
    known = stored.join(best, keys, "left")
    raised = F.coalesce(F.col("b_rank") > rank(F.col("match_class")), F.lit(False))
    lifted = raised & (F.col("match_class") == "reject") & (F.col("status") == "skipped")
    updates = {
        "status": F.when(lifted, F.lit("pending")).otherwise(F.col("status")),
        "match_reason": F.when(raised, F.col("b.match_reason")).otherwise(F.coalesce("match_reason", "b_any_reason")),
        "query": F.coalesce("query", "b_query"),
        "match_class": F.when(raised, F.col("b.match_class")).otherwise(F.col("match_class")),
    }
    kept = known.select(*[updates[c].alias(c) if c in updates else F.col(c) for c in stored.columns])
    new = best.join(stored.select(*keys).distinct(), keys, "left_anti")
    top = top if top is not None else stored.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    numbered = numbered_rows(new.withColumn("_at", F.col("b_first.ordinal").cast("long")), "_at", keys).join(F.broadcast(top))
    cls = F.col("b.match_class")
    values = {
        "id": (F.col("top") + F.col("n")).cast("long"), "url": F.col("url"), "ticker": F.col("ticker"), "match_class": cls,
        "match_reason": F.coalesce(F.col("b.match_reason"), F.col("b_any_reason")), "query": F.col("b_query"), "status": F.when(cls == "reject", F.lit("skipped")).otherwise(F.col("b_first.status")),
    }
    fresh = numbered.select(*[(values[c] if c in values else F.col(f"b_first.{c}")).cast(stored.schema[c].dataType).alias(c) for c in stored.columns])
    return kept.unionByName(fresh)


def unfinished(companies: DataFrame, domains: DataFrame, progress: DataFrame) -> DataFrame:
    """(ticker, domain) still to do: all of ``companies`` by ``domains`` without those in ``progress``.

    ``domains`` are a list of sites, sent along as one array; more than ``SITES`` are refused.
    """
    if not small_enough(domains.select("domain").distinct(), SITES):
        raise ValueError(f"more than {SITES} sites")
    sites = domains.agg(F.collect_set("domain").alias("_sites"))
    every = companies.select("ticker").distinct().join(F.broadcast(sites)).select("ticker", F.explode("_sites").alias("domain"))
    return every.join(progress.select("ticker", "domain").distinct(), ["ticker", "domain"], "left_anti")


def replace_rows(stored: DataFrame, new: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """``stored`` with the rows of ``new`` in the place of those with their keys; columns in ``keep`` stay as stored.

    ``new`` has one row per key. Keys without a stored row are added.
    """
    old = stored.select(*keys, *[F.col(c).alias(f"_{c}") for c in keep])
    put = new.join(old, keys, "left").select(*[F.col(f"_{c}").alias(c) if c in keep else F.col(c) for c in stored.columns])
    return stored.join(new.select(*keys), keys, "left_anti").unionByName(put)


def run_summary(runs: DataFrame, shown: int = 3) -> DataFrame:
    """Per domain of (domain, ticker, inserted, error): pairs, rows inserted, distinct errors with how many pairs met them, the commonest ``shown`` as text."""
    errors = runs.filter("error IS NOT NULL").groupBy("domain", "error").agg(F.count("*").alias("n"))
    lines = errors.groupBy("domain").agg(F.count("*").alias("errors"), F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "error"))).alias("e"))
    head = F.array_join(F.transform(F.slice("e", 1, shown), lambda x: F.concat(x["error"], F.lit(" x"), (-x["k"]).cast("string"))), "; ")
    text = F.concat(head, F.when(F.col("errors") > shown, F.concat(F.lit(" and "), (F.col("errors") - shown).cast("string"), F.lit(" more"))).otherwise(F.lit("")))
    sums = runs.groupBy("domain").agg(F.count("*").alias("pairs"), F.coalesce(F.sum("inserted"), F.lit(0)).cast("long").alias("inserted"))
    return sums.join(lines.select("domain", "errors", text.alias("summary")), "domain", "left").select("domain", "pairs", "inserted", F.coalesce("errors", F.lit(0)).cast("long").alias("errors"), F.coalesce("summary", F.lit("")).alias("summary"))


def deletable(queue: DataFrame, articles: DataFrame, crawls_done: DataFrame, protected: DataFrame) -> DataFrame:
    """Rejected, skipped sitemap pairs without an article, of domains (domain, entries) whose latest crawl found entries; never a protected id."""
    filled = crawls_done.filter("entries > 0").select("domain").distinct()
    rows = queue.filter("match_class = 'reject' AND status = 'skipped' AND source = 'sitemap'")
    return rows.join(filled, "domain", "left_semi").join(articles.select("id"), "id", "left_anti").join(protected.select("id"), "id", "left_anti")


def fingerprint(queue: DataFrame, articles: DataFrame) -> DataFrame:
    """One row that changes with the tables: counts, sums and maxima of ids, rows per class, articles without a pair."""
    q = queue.agg(F.count("*").alias("pairs"), F.sum("id").cast("long").alias("id_sum"), F.max("id").alias("id_max"), *[F.count_if(F.col("match_class") == c).alias(c) for c in RANK])
    a = articles.agg(F.count("*").alias("articles"), F.max("id").alias("article_max"))
    o = articles.join(queue, "id", "left_anti").agg(F.count("*").alias("orphans"))
    return q.join(F.broadcast(a)).join(F.broadcast(o))


def delete_conditions(before: DataFrame, after: DataFrame, gone: DataFrame, articles: DataFrame) -> DataFrame:
    """(condition, holds) after ``gone`` (id) was deleted: as many rows left as should be, none of those listed, no other row lost, no accept or review and no pair with an article among them."""
    counts = before.agg(F.count("*").alias("b")).join(F.broadcast(after.agg(F.count("*").alias("a")))).join(F.broadcast(gone.agg(F.count_distinct("id").alias("g"))))
    left = after.join(gone, "id", "left_semi").agg(F.count("*").alias("l"))
    lost = before.join(after, "id", "left_anti").join(gone, "id", "left_anti").agg(F.count("*").alias("o"))
    good = before.join(gone, "id", "left_semi").agg(F.count_if(F.col("match_class") != "reject").alias("r"))
    held = articles.join(gone, "id", "left_semi").agg(F.count("*").alias("h"))
    row = counts.join(F.broadcast(left)).join(F.broadcast(lost)).join(F.broadcast(good)).join(F.broadcast(held))
    tests = {"count": F.col("b") - F.col("g") == F.col("a"), "none listed": F.col("l") == 0, "no other": F.col("o") == 0, "rejects only": F.col("r") == 0, "no article": F.col("h") == 0}
    return row.select(F.inline(F.array(*[F.struct(F.lit(k).alias("condition"), v.alias("holds")) for k, v in tests.items()])))


def progress(queue: DataFrame) -> DataFrame:
    """(ticker, line): of a ticker's pairs that aren't rejects, how many are no longer pending."""
    g = queue.filter("match_class <> 'reject'").groupBy("ticker").agg(F.count("*").alias("n"), F.count_if(F.col("status") != "pending").alias("k"))
    return g.select("ticker", F.concat(F.col("k").cast("string"), F.lit(" of "), F.col("n").cast("string"), F.lit(" processed")).alias("line"))
