"""Figures about the pipeline's tables: rates with intervals, confusion counts, samples, quality of articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import articles as A
from millrace.functions import fields
from millrace.functions import matching as M
from millrace.plans import once

Z = 1.96


def mode(url: Column, title: Column, company: Column, ticker: Column) -> Column:
    """How the first rule, ticker or first long word of the name, takes a pair: both, ticker_only, name_only, unmatched."""
    first = F.split_part(F.trim(company), F.lit(" "), F.lit(1))
    token = F.when(F.length(first) > 3, first).otherwise(company)
    text = F.concat_ws("\n", url, title)
    edge = lambda t: F.concat(F.lit(r"(?i)\b\Q"), t, F.lit(r"\E\b"))
    # a substring test first: a pattern made per row is compiled only where it can match
    has = lambda t: F.when(F.lower(text).contains(F.lower(t)), F.rlike(text, edge(t))).otherwise(F.lit(False))
    by_ticker, by_name = has(ticker), has(token)
    return F.when(by_ticker & by_name, "both").when(by_ticker, "ticker_only").when(by_name, "name_only").otherwise("unmatched")


MODES = ("both", "ticker_only", "name_only", "unmatched")


def mode_audit(queue: DataFrame) -> DataFrame:
    """(domain, source, rows, a count per mode, ticker_only_share, name_only_share), shares to four places."""
    cells = queue.withColumn("mode", mode(F.col("url"), F.col("title"), F.col("company"), F.col("ticker")))
    g = cells.groupBy("domain", "source").agg(F.count("*").alias("rows"), *[F.count_if(F.col("mode") == m).alias(m) for m in MODES])
    share = lambda m: F.bround(F.col(m) / F.col("rows"), 4).alias(f"{m}_share")
    return g.select("domain", "source", "rows", *MODES, share("ticker_only"), share("name_only"))


def quality_audit(articles: DataFrame, floor: int = 80) -> DataFrame:
    """Per domain: rows, ok rows, walls, rows under ``floor`` words and repeated bodies among ok rows, held rows."""
    ok = F.coalesce((F.col("fetch_status") == "ok") | ((F.col("fetch_status") == "quarantined") & (F.col("prev_fetch_status") == "ok")), F.lit(False))
    body = F.coalesce("body_text", F.lit(""))
    rows = articles.select("source_domain", ok.alias("ok"), A.wall_kind(body).isNotNull().alias("wall"), (A.word_count(body) < floor).alias("thin"), F.when(ok, F.md5(body)).alias("h"), (F.col("fetch_status") == "quarantined").alias("held"))
    return rows.groupBy("source_domain").agg(
        F.count("*").alias("rows"), F.count_if("ok").alias("ok"), F.count_if(F.col("ok") & F.col("wall")).alias("walls"), F.count_if(F.col("ok") & F.col("thin")).alias("under_floor"),
        (F.count("h") - F.count_distinct("h")).alias("duplicate_bodies"), F.count_if("held").alias("held"),
    )


def sample(rows: DataFrame, stratum: str, per_stratum: int, seed: int, key: str = "id") -> DataFrame:
    """``per_stratum`` rows of each stratum, the same for one seed, with ``stratum_size``.

    Ranked by a hash of key and seed. Only the least ranks of each task's part of a stratum leave it, so that
    a stratum that holds a third of all rows is no single task.
    """
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    sizes = rows.groupBy(stratum).agg(F.count("*").alias("stratum_size"))
    ranked = rows.withColumn("_o", order).withColumn("_part", F.pmod(F.xxhash64(key), F.lit(64)))
    first = ranked.withColumn("_r", F.row_number().over(Window.partitionBy(stratum, "_part").orderBy("_o", key))).filter(F.col("_r") <= per_stratum)
    best = first.withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy("_o", key))).filter(F.col("_r") <= per_stratum)
    return best.drop("_o", "_r", "_part").join(sizes, stratum)


def wilson(k: Column, n: Column) -> tuple[Column, Column]:
    """Lower and upper end of Wilson's interval; (0, 0) without rows."""
    p = k / n
    base = 1 + Z * Z / n
    centre = (p + Z * Z / (2 * n)) / base
    half = Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n)) / base
    zero = F.lit(0.0)
    return F.when(n > 0, F.greatest(zero, centre - half)).otherwise(zero), F.when(n > 0, F.least(F.lit(1.0), centre + half)).otherwise(zero)


def stratified_rate(labelled: DataFrame, group: str, stratum: str = "stratum", size: str = "stratum_size", wrong: str = "wrong") -> DataFrame:
    """(group, n, n_wrong, rate, low, high): rate weighted by stratum size, with its interval."""
    return rate_of_strata(labelled.groupBy(group, stratum).agg(F.count("*").alias("n"), F.count_if(wrong).alias("k"), F.max(size).alias("size")), group)


def rate_of_strata(s: DataFrame, group: str) -> DataFrame:
    """As ``stratified_rate``, from a row per stratum: (group, n, k, size)."""
    s = s.withColumn("pop", F.sum("size").over(Window.partitionBy(group)))
    w, smooth = F.col("size") / F.col("pop"), (F.col("k") + 0.5) / (F.col("n") + 1)
    g = s.groupBy(group).agg(F.sum("n").alias("n"), F.sum("k").alias("n_wrong"), F.sum(w * F.col("k") / F.col("n")).alias("rate"), F.sum(w * w * smooth * (1 - smooth) / (F.col("n") + 1)).alias("var"))
    half = Z * F.sqrt("var")
    return g.select(group, "n", "n_wrong", F.round("rate", 6).alias("rate"), F.round(F.greatest(F.lit(0.0), F.col("rate") - half), 6).alias("low"), F.round(F.least(F.lit(1.0), F.col("rate") + half), 6).alias("high"))


def rule_verdicts(pairs: DataFrame) -> DataFrame:
    """(rule, predicted, actual) per pair of (url, title, body, company, ticker, actual): what simpler rules would keep.

    ``all`` keeps everything; ``named`` wants the full name in address or title, or an explicit ticker in title or body;
    ``mentioned`` also takes a body with the name twice or more; ``signalled`` also the ticker or first word in the title.
    """
    rows = M.with_company(pairs)
    title, body, c, t = F.coalesce("title", F.lit("")), F.coalesce("body", F.lit("")), F.col("company"), F.col("ticker")
    full = M.full_name(c)
    named = fields.full_name_present(c, F.col("url"), title) | M.explicit_ticker(t, title) | M.explicit_ticker(t, body)
    mentions = F.size(F.split(M.flat(body), F.concat(F.lit("\\Q "), full, F.lit(" \\E")), -1)) - 1
    mentioned = named | ((full != "") & (mentions >= 2))
    edged = M.edges(title)
    upper = F.coalesce(edged.contains(F.concat(F.lit(" "), F.col("m_upper"), F.lit(" "))), F.lit(False))
    first = F.coalesce(F.lower(edged).contains(F.concat(F.lit(" "), F.lower("m_first"), F.lit(" "))), F.lit(False))
    once_each = once(rows, named=named, mentioned=mentioned, signalled=upper | first)
    rules = {"all": F.lit(True), "named": F.col("named"), "mentioned": F.col("mentioned"), "signalled": F.col("mentioned") | F.col("signalled")}
    return once_each.select("actual", F.inline(F.array(*[F.struct(F.lit(k).alias("rule"), p.alias("predicted")) for k, p in rules.items()])))


def confusion(rows: DataFrame, predicted: Column, actual: Column, group: str) -> DataFrame:
    """(group, tp, fp, fn, tn, precision, recall); 0 where there is nothing to divide by. Nulls count as no."""
    p, a = F.coalesce(predicted, F.lit(False)), F.coalesce(actual, F.lit(False))
    g = rows.groupBy(group).agg(F.count_if(p & a).alias("tp"), F.count_if(p & ~a).alias("fp"), F.count_if(~p & a).alias("fn"), F.count_if(~p & ~a).alias("tn"))
    safe = lambda x, y: F.when(y > 0, F.round(x / y, 6)).otherwise(F.lit(0.0))
    return g.select(group, "tp", "fp", "fn", "tn", safe(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), safe(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))
