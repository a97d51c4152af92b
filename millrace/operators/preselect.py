"""Entries against companies without comparing each with each: candidates by rare tokens, then the exact rule.

Every signal of the rule needs some token of the company in the entry's text (or its title). Per spelling the
token that fewest entries have is its anchor; entries are joined to anchors on the token and only
those pairs are classed. The pairs found are those of the full comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import matching as M
from millrace.session import small_enough

#: Companies of at most so many rows are broadcast (about 500 bytes a row).
BROADCAST_ROWS = 100_000


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(M.words(text), " "), lambda t: t != ""))


def _spellings(companies: DataFrame) -> DataFrame:
    """(ticker, company, form_no, token, where): the tokens of each spelling, of which any one is an anchor.

    ``where`` is ``title`` for signals read from the title alone. The plural of a spelling is a spelling of its own.
    """
    one = lambda form, where: F.struct(form.alias("form"), F.lit(where).alias("where"))
    some = F.array(
        one(F.col("m_name"), "text"), one(M.words(F.col("m_weak")), "text"), one(M.words(F.col("m_first")), "text"), one(M.words(F.col("ticker")), "title"),
    )
    many = F.transform(F.concat("m_aliases", "m_forms"), lambda f: one(f, "text"))
    forms = companies.select("ticker", "company", F.posexplode(F.filter(F.concat(some, many), lambda x: x["form"].isNotNull() & (x["form"] != ""))).alias("form_no", "x"))
    return forms.select("ticker", "company", "form_no", F.col("x.where").alias("where"), F.explode(F.array_distinct(F.split("x.form", " "))).alias("token"))


def candidates(entries: DataFrame, companies: DataFrame, key: str = "entry_id") -> DataFrame:
    """(key, ticker, company): pairs that any signal could class above reject. ``companies`` has the ``m_*`` columns."""
    small = small_enough(companies, BROADCAST_ROWS)
    spread = F.broadcast if small else (lambda df: df)
    forms = _spellings(companies)
    wanted = forms.select("token").distinct()
    tokens = entries.select(key, F.explode(_tokens(F.col("x_text"))).alias("token")).join(spread(wanted), "token", "left_semi")
    seen = tokens.groupBy("token").agg(F.count("*").alias("n"))
    # an unseen token has no entry at all: its spelling can match nothing
    rated = forms.join(seen, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    anchors = rated.groupBy("ticker", "company", "form_no", "where").agg(F.min(F.struct("n", "token")).alias("a")).filter("a.n > 0").select("ticker", "company", "where", F.col("a.token").alias("token")).distinct()
    by_text = tokens.join(spread(anchors.filter("where = 'text'").drop("where")), "token")
    title_tokens = entries.filter("x_title <> ''").select(key, F.explode(_tokens(F.col("x_title"))).alias("token"))
    by_title = title_tokens.join(spread(anchors.filter("where = 'title'").drop("where")), "token")
    return by_text.select(key, "ticker", "company").unionByName(by_title.select(key, "ticker", "company")).distinct()


def matches(entries: DataFrame, companies: DataFrame, key: str = "entry_id") -> DataFrame:
    """(key, ticker, company, match_class, match_reason) of all pairs above reject."""
    texts, firms = M.text_columns(entries), M.company_columns(companies)
    pairs = candidates(texts, firms, key)
    firms = F.broadcast(firms) if small_enough(companies, BROADCAST_ROWS) else firms
    rows = pairs.join(texts.select(key, *[c for c in texts.columns if c.startswith("x_")]), key).join(firms, ["ticker", "company"])
    return M.classified(rows.select(key, "ticker", "company", *[c for c in rows.columns if c.startswith(("x_", "m_"))])).filter("match_class <> 'reject'")


def full_scan(entries: DataFrame, companies: DataFrame, key: str = "entry_id") -> DataFrame:
    """The same pairs by classing every entry for every company of a small, checked set: the proof, not the way."""
    if not small_enough(companies, BROADCAST_ROWS):
        raise ValueError("a full scan takes a small set of companies")
    rows = M.text_columns(entries).crossJoin(F.broadcast(M.company_columns(companies)))
    return M.classified(rows.select(key, "ticker", "company", *[c for c in rows.columns if c.startswith(("x_", "m_"))])).filter("match_class <> 'reject'")
