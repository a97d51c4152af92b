"""Problem 2: attributes of an entity as they were known at the time of an event.

Each attribute has a change history of its own. An event is matched to the last value of each
history that was in force and already known at its instant; the matches are then set side
by side again. The histories are kept as one array per symbol and attribute, so that matching
costs the events no shuffle where the histories are small, and one skew-tolerant join where not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import timestamps as ts
from millrace.operators import moments
from millrace.plans import once
from millrace.session import small_enough

ATTRIBUTES = ("security", "gics_sector", "gics_sub_industry")
#: Histories of at most so many rows may be broadcast (about 200 bytes a row).
BROADCAST_ROWS = 200_000
#: Copies of each history where they are too many to broadcast.
SALT = 16


def symbol_key(symbol: Column) -> Column:
    """Blanks at the ends and case ignored; null stays null."""
    return F.upper(F.trim(symbol))


def known_us(text: Column, parts: Column) -> Column:
    """The moment in a revision timestamp (UTC where no zone is written): null for null or unreadable text."""
    p = ts.parts(parts)
    local = ts._days(ts._num(p["y"]), ts._month(p["m"]), ts._num(p["d"])) * F.lit(ts.DAY_US) + ts.clock_us(p)
    offset = F.when(p["zone"] == "", F.lit(0)).otherwise(ts.offset_minutes(p["zone"], F.lit(None).cast("map<string,int>")))
    return F.when(text.isNotNull(), local - offset.cast("long") * F.lit(60_000_000))


def histories(membership: DataFrame, attributes: tuple[str, ...] = ATTRIBUTES) -> DataFrame:
    """One independent change history per symbol and attribute: (sym, attribute, value, valid_from, valid_to, known).

    ``known`` is null for what was always known. A row whose revision timestamp can't be read was
    never known and is left out, as are rows without ``symbol`` or ``valid_from``. Repeats are dropped.
    """
    stamp = F.col("gics_revision_timestamp")
    rows = once(membership, _parts=F.split(ts.canon(stamp), r"\|"))
    rows = once(rows, known=known_us(stamp, F.col("_parts")))
    rows = rows.select(
        symbol_key(F.col("symbol")).alias("sym"), "valid_from", "valid_to", "known", (stamp.isNull() | F.col("known").isNotNull()).alias("_ok"),
        F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes])).alias("x"),
    ).filter("_ok AND sym IS NOT NULL AND valid_from IS NOT NULL")
    return rows.select("sym", "x.attribute", "x.value", "valid_from", "valid_to", "known").distinct()


def match(events: DataFrame, history: DataFrame, attributes: tuple[str, ...] = ATTRIBUTES, symbol: str = "ticker", us: str = "us") -> DataFrame:
    """``events`` with, per attribute, ``<attribute>`` and ``<attribute>_from`` of its last known value.

    A candidate is in force on the event's UTC date (both ends included, null is open) and known
    by its instant; the latest ``valid_from`` wins, then the latest known, then the greatest value.
    Events without a candidate keep nulls; so do those with a null symbol or instant.
    """
    entry = F.struct("valid_from", F.coalesce("known", F.lit(-(1 << 62))).alias("known"), "value", "valid_to")
    wide = history.groupBy("sym").pivot("attribute", list(attributes)).agg(F.sort_array(F.collect_list(entry), asc=False))
    wide = wide.select(F.col("sym").alias("_sym"), *[F.col(a).alias(f"_h_{a}") for a in attributes])
    keyed = events.withColumn("_key", symbol_key(F.col(symbol)))
    if small_enough(history, BROADCAST_ROWS):
        joined = keyed.join(F.broadcast(wide), F.col("_key") == F.col("_sym"), "left")
    else:  # one symbol may hold a third of the events: they are spread over copies of its history
        salted = keyed.withColumn("_salt", F.pmod(F.xxhash64(symbol, us, F.spark_partition_id()), F.lit(SALT)).cast("int"))
        copies = wide.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        joined = salted.join(copies, (F.col("_key") == F.col("_sym")) & (F.col("_salt") == F.col("_copy")), "left")
    day = F.date_from_unix_date(F.floor(F.col(us) / F.lit(float(ts.DAY_US))).cast("int"))
    joined = joined.withColumn("_day", day)

    def last(name: str) -> Column:
        fits = F.filter(F.col(f"_h_{name}"), lambda x: (x["valid_from"] <= F.col("_day")) & (x["valid_to"].isNull() | (x["valid_to"] >= F.col("_day"))) & (x["known"] <= F.col(us)))
        return F.get(fits, F.lit(0))

    picked = once(joined, **{f"_m_{a}": last(a) for a in attributes})
    cols = [c for a in attributes for c in (F.col(f"_m_{a}")["value"].alias(a), F.col(f"_m_{a}")["valid_from"].alias(f"{a}_from"))]
    return picked.select(*events.columns, *cols)


def article_moments(articles: DataFrame, sites: DataFrame) -> DataFrame:
    """(id, ticker, us): articles with a readable ``pub_date``, read as in problem 7."""
    rows = articles.select("id", "ticker", F.col("pub_date").alias("value"), F.col("source_domain").alias("domain"), F.col("id").alias("ord_key"))
    return moments.resolve(rows.filter(F.col("value").isNotNull()), sites, source=["domain"]).select("id", "ticker", "us")


def attributes_at_publication(articles: DataFrame, membership: DataFrame, sites: DataFrame) -> DataFrame:
    """(id, security, gics_sector, gics_sub_industry, valid_from) of each article that has a version in force."""
    out = match(article_moments(articles, sites), histories(membership))
    return out.filter(F.col("gics_sub_industry_from").isNotNull()).select("id", *ATTRIBUTES, F.col("gics_sub_industry_from").cast("string").alias("valid_from")).distinct()


def found(articles: DataFrame, membership: DataFrame, sites: DataFrame) -> DataFrame:
    """(id, valid_from): the version in force and known at each article's ``pub_date``."""
    out = match(article_moments(articles, sites), histories(membership))
    return out.filter(F.col("gics_sub_industry_from").isNotNull()).select("id", F.col("gics_sub_industry_from").cast("string").alias("valid_from")).distinct()
