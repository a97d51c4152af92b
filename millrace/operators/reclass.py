"""Classing stored pairs anew: what would change, an audit list of it, writing it, taking it back, and checks of each step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import matching
from millrace.operators import holds
from millrace.operators.queue import rank

FEED = "feed"
AUDIT = ("id", "ticker", "url", "old_class", "old_reason", "new_class", "new_reason", "old_status", "new_status")


def _lifted(status="status"):
    return F.when(F.col(status) == "skipped", F.lit("pending")).otherwise(F.col(status))


def promotions(titled: DataFrame) -> DataFrame:
    """The audit list of rejects, other than of feeds keyed by ticker, that the rule now classes higher: ``titled`` is the queue with the best title known."""
    asked = titled.filter("match_class = 'reject' AND source <> 'api'").withColumnsRenamed({"match_class": "old_class", "match_reason": "old_reason", "status": "old_status"})
    rows = matching.classified(matching.with_company(matching.text_columns(asked))).filter("match_class <> 'reject'")
    return rows.withColumnsRenamed({"match_class": "new_class", "match_reason": "new_reason"}).withColumn("new_status", _lifted("old_status")).select(*AUDIT)


def retags(titled: DataFrame) -> DataFrame:
    """(id, new_class, new_reason, new_status) of every pair: feeds are accepted, all others classed; pending ones that come out rejected are skipped."""
    asked = titled.withColumnsRenamed({"match_class": "_old", "match_reason": "_r"})
    ruled = matching.classified(matching.with_company(matching.text_columns(asked.filter("source <> 'api'")))).select("id", "match_class", "match_reason", "status")
    fed = asked.filter("source = 'api'").select("id", F.lit("accept").alias("match_class"), F.lit(FEED).alias("match_reason"), "status")
    status = F.when((F.col("match_class") == "reject") & (F.col("status") == "pending"), F.lit("skipped")).otherwise(F.col("status"))
    return ruled.unionByName(fed).select("id", F.col("match_class").alias("new_class"), F.col("match_reason").alias("new_reason"), status.alias("new_status"))


def applied(queue: DataFrame, audit: DataFrame) -> DataFrame:
    """``queue`` with the listed promotions, on rows that are still rejects only."""
    one = audit.select("id", "new_class", "new_reason", F.lit(True).alias("_hit"))
    hit = F.coalesce(F.col("_hit") & (F.col("match_class") == "reject"), F.lit(False))
    cols = {"match_class": F.when(hit, F.col("new_class")).otherwise(F.col("match_class")), "match_reason": F.when(hit, F.col("new_reason")).otherwise(F.col("match_reason")), "status": F.when(hit, _lifted()).otherwise(F.col("status"))}
    return queue.join(one, "id", "left").select(*[cols[c].alias(c) if c in cols else F.col(c) for c in queue.columns])


def reverted(queue: DataFrame, audit: DataFrame) -> DataFrame:
    """``queue`` with a run taken back: a row that is the listed pair and still holds what the run wrote gets its old class, reason and status."""
    one = audit.select("id", *[F.col(c).alias(f"_{c}") for c in AUDIT if c != "id"])
    same = (F.col("ticker") == F.col("_ticker")) & (F.col("url") == F.col("_url")) & (F.col("match_class") == F.col("_new_class")) & (F.col("match_reason") == F.col("_new_reason"))
    hit = F.coalesce(same, F.lit(False))
    status = F.when(F.col("status") == F.col("_new_status"), F.col("_old_status")).otherwise(F.col("status"))
    cols = {"match_class": F.when(hit, F.col("_old_class")).otherwise(F.col("match_class")), "match_reason": F.when(hit, F.col("_old_reason")).otherwise(F.col("match_reason")), "status": F.when(hit, status).otherwise(F.col("status"))}
    return queue.join(one, "id", "left").select(*[cols[c].alias(c) if c in cols else F.col(c) for c in queue.columns])


def problems(audit: DataFrame, queue: DataFrame) -> DataFrame:
    """(problem, n): rows of an audit list (ids as text) that can't be of this queue's run: an id that is no number or repeats, no promotion, a blank reason or status, an unknown id, another pair."""
    rows = audit.withColumn("_id", F.col("id").cast("string").try_cast("long"))
    old, new = rank(F.col("old_class")), rank(F.col("new_class"))
    blank = F.lit(False)
    for c in ("old_reason", "new_reason", "old_status", "new_status"):
        blank = blank | F.coalesce(F.trim(c) == "", F.lit(True))
    now = queue.select(F.col("id").alias("_id"), F.col("ticker").alias("_t"), F.col("url").alias("_u"), F.lit(True).alias("_known"))
    joined = rows.join(now, "_id", "left").withColumns({
        "not_a_number": F.col("_id").isNull(), "no_promotion": F.coalesce(old >= new, F.lit(True)), "blank": blank, "unknown": F.col("_id").isNotNull() & F.col("_known").isNull(),
        "another_pair": F.coalesce(F.col("_known") & ~((F.col("ticker") == F.col("_t")) & (F.col("url") == F.col("_u"))), F.lit(False)),
    })
    kinds = ("not_a_number", "no_promotion", "blank", "unknown", "another_pair")
    flat = joined.select(F.explode(F.array(*[F.struct(F.lit(k).alias("problem"), F.col(k).alias("is")) for k in kinds])).alias("x")).select("x.*")
    counted = flat.groupBy("problem").agg(F.count_if("is").alias("n"))
    repeats = rows.filter("_id IS NOT NULL").groupBy("_id").count().filter("count > 1").agg(F.count("*").alias("n")).select(F.lit("repeated").alias("problem"), "n")
    return counted.unionByName(repeats)


def report(queue: DataFrame, articles: DataFrame, audit: DataFrame) -> DataFrame:
    """(figure, n) of what writing ``audit`` would do: rows by status, lifted ones, articles held or released afterwards, the change of ok articles, feed rejects left alone."""
    after = applied(queue, audit)
    sync = holds.sync_counts(articles, after)
    by_status = audit.groupBy(F.concat(F.lit("status "), F.coalesce("old_status", F.lit("none"))).alias("figure")).agg(F.count("*").alias("n"))
    lifted = audit.agg(F.count_if(F.col("old_status") == "skipped").alias("n")).select(F.lit("lifted").alias("figure"), "n")
    fed = queue.agg(F.count_if((F.col("match_class") == "reject") & (F.col("source") == "api")).alias("n")).select(F.lit("feed rejects").alias("figure"), "n")
    ok = articles.agg(F.count_if(F.col("fetch_status") == "ok").alias("n")).select(F.lit("ok articles").alias("figure"), "n")
    figures = sync.select(F.inline(F.array(*[F.struct(F.lit(k).alias("figure"), F.col(k).alias("n")) for k in ("held", "released", "ok_change")])))
    return by_status.unionByName(lifted).unionByName(fed).unionByName(ok).unionByName(figures)


def conditions(before: DataFrame, after: DataFrame, audit: DataFrame) -> DataFrame:
    """(condition, holds) after writing: as many rows changed as listed, none of them still a reject, classes moved by the listed number, no other row touched."""
    pair = before.select("id", F.col("match_class").alias("a"), F.col("match_reason").alias("ra")).join(after.select("id", F.col("match_class").alias("b"), F.col("match_reason").alias("rb")), "id", "full_outer")
    rows = pair.join(audit.select("id", "new_class").withColumn("_listed", F.lit(True)), "id", "left")
    changed = ~(F.col("a").eqNullSafe(F.col("b")) & F.col("ra").eqNullSafe(F.col("rb")))
    listed = F.coalesce("_listed", F.lit(False))
    g = rows.agg(
        (F.count_if(changed) == F.count_if(listed)).alias("as many as listed"), (F.count_if(listed & (F.col("b") == "reject")) == 0).alias("none still a reject"), (F.count_if(changed & ~listed) == 0).alias("no other row"),
        ((F.count_if(F.col("b") == "accept") - F.count_if(F.col("a") == "accept")) == F.count_if(listed & (F.col("new_class") == "accept"))).alias("accepts moved"),
    )
    return g.select(F.inline(F.array(*[F.struct(F.lit(c).alias("condition"), F.col(f"`{c}`").alias("holds")) for c in g.columns])))
