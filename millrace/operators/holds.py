"""What a fetch and a change of class do to stored rows: status, promotion by the fetched title, articles held back and released."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import matching
from millrace.operators.queue import rank, replace_rows

HELD = "quarantined"


def is_held(status: Column, before: Column) -> Column:
    """Whether an article is held back, or carries a status from before that is stale."""
    return F.coalesce(status == HELD, F.lit(False)) | before.isNotNull()


def synced(articles: DataFrame, classes: DataFrame) -> DataFrame:
    """``articles`` with status and previous status as the classes of their pairs (id, match_class) ask for.

    An article of a pair that isn't accepted is held, its status kept aside once; one of an accepted pair gets the status back, or
    keeps a fresher one, and nothing stays aside. Articles without a pair, or whose pair has no class, stay as they are. Running it
    twice changes nothing more.
    """
    own = classes.select("id", F.col("match_class").alias("_class")).dropDuplicates(["id"])
    rows = articles.join(own, "id", "left")
    status, before = F.col("fetch_status"), F.col("prev_fetch_status")
    hold = (F.col("_class") != "accept") & (status.isNull() | (status != HELD))
    free = (F.col("_class") == "accept") & is_held(status, before)
    new_status = F.when(hold, F.lit(HELD)).when(free, F.when(status == HELD, before).otherwise(status)).otherwise(status)
    new_before = F.when(hold, status).when(free, F.lit(None)).otherwise(before)
    cols = {"fetch_status": new_status, "prev_fetch_status": new_before}
    return rows.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in articles.columns])


def sync_counts(articles: DataFrame, classes: DataFrame) -> DataFrame:
    """One row of what ``synced`` would do: held, released, and by how much the number of ok articles changes."""
    rows = articles.join(classes.select("id", "match_class").dropDuplicates(["id"]), "id")
    status, before = F.col("fetch_status"), F.col("prev_fetch_status")
    hold = (F.col("match_class") != "accept") & (status.isNull() | (status != HELD))
    free = (F.col("match_class") == "accept") & is_held(status, before)
    return rows.agg(
        F.count_if(hold).alias("held"), F.count_if(free).alias("released"),
        (F.count_if(free & (status == HELD) & (before == "ok")) - F.count_if(hold & (status == "ok"))).alias("ok_change"),
    )


def fetched_status(code: Column) -> Column:
    """``fetched`` for a code of success, else ``failed``."""
    return F.when(code.between(200, 299), "fetched").otherwise("failed")


def marked(queue: DataFrame, results: DataFrame, key: str = "id") -> DataFrame:
    """``queue`` after ``results`` (key, code, reason): by id, or by url for every ticker that has it.

    A code sets status and code; a reason without a code marks the row as skipped and stands in for a missing title. Of several
    results of a key the greatest counts.
    """
    one = results.groupBy(key).agg(F.max("code").alias("_code"), F.max("reason").alias("_reason"), F.lit(True).alias("_hit"))
    rows = queue.join(one.withColumn("_hit", F.lit(True)), key, "left")
    hit, code, reason = F.coalesce("_hit", F.lit(False)), F.col("_code"), F.col("_reason")
    cols = {
        "status": F.when(hit & code.isNotNull(), fetched_status(code)).when(hit, F.lit("skipped")).otherwise(F.col("status")),
        "fetch_status_code": F.when(hit & code.isNotNull(), code).otherwise(F.col("fetch_status_code")),
        "title": F.when(hit & code.isNull(), F.coalesce("title", F.nullif(reason, F.lit("")))).otherwise(F.col("title")),
    }
    return rows.select(*[cols[c].cast(queue.schema[c].dataType).alias(c) if c in cols else F.col(c) for c in queue.columns])


def reevaluated(queue: DataFrame, fetched: DataFrame) -> DataFrame:
    """``queue`` after its fetched pages (id, title): pairs under review are classed with both titles and promoted if that raises them; none is demoted, rejects stay."""
    titles = fetched.select("id", F.col("title").alias("_t")).dropDuplicates(["id"])
    both = F.concat_ws(" ", F.nullif(F.col("title"), F.lit("")), F.nullif(F.col("_t"), F.lit("")))
    asked = queue.filter(F.col("match_class") != "reject").join(titles, "id").select("id", "url", "company", "ticker", both.alias("title"), F.col("match_class").alias("_old"))
    new = matching.classified(matching.with_company(matching.text_columns(asked))).filter(rank(F.col("match_class")) > rank(F.col("_old")))
    new = new.select("id", F.col("match_class").alias("_class"), F.col("match_reason").alias("_reason"))
    cols = {"match_class": F.coalesce("_class", "match_class"), "match_reason": F.when(F.col("_class").isNotNull(), F.col("_reason")).otherwise(F.col("match_reason"))}
    return queue.join(new, "id", "left").select(*[cols[c].alias(c) if c in cols else F.col(c) for c in queue.columns])


def recorded(queue: DataFrame, articles: DataFrame, fetched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queue, articles) after a batch of fetched ``articles`` rows, one per id: saved, the pairs' status set, those that were read classed again, and held or released."""
    saved = replace_rows(articles, fetched, ["id"], ("prev_fetch_status",))
    one = fetched.select("id", F.col("fetch_status").alias("_s"), F.col("http_status_code").alias("_c"), F.lit(True).alias("_hit"))
    cols = {"status": F.when(F.col("_hit"), F.col("_s")).otherwise(F.col("status")), "fetch_status_code": F.when(F.col("_hit"), F.col("_c")).otherwise(F.col("fetch_status_code"))}
    set_ = queue.join(one, "id", "left").select(*[cols[c].alias(c) if c in cols else F.col(c) for c in queue.columns])
    queue_now = reevaluated(set_, fetched.filter("fetch_status <> 'failed'"))
    touched = synced(saved.join(fetched.select("id"), "id", "left_semi"), queue_now)
    return queue_now, saved.join(fetched.select("id"), "id", "left_anti").unionByName(touched)
