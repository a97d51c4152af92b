"""Daily price rows: adjustment for splits, rows that are no trades, split events, vendors in order, distributions, missing sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.series import later_product

#: fixed values: share of the median volume below which a repeated close was carried over; factors of plain splits
CARRIED, PLAIN_SPLITS = 0.10, (0.1, 0.2, 0.25, 0.5, 2.0, 3.0, 4.0, 5.0, 10.0, 15.0, 20.0)


def adjusted(rows: DataFrame, start: str, end: str) -> DataFrame:
    """(symbol, day, adj_open, adj_high, adj_low, adj_close, adj_volume, raw_close) in the range: prices divided, volumes multiplied by
    the product of all later split factors, also of those beyond ``end``; volumes are rounded half to even."""
    f = rows.withColumn("_f", F.round(later_product(F.col("split_factor"), "symbol", "day"), 9))
    kept = f.filter(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return kept.select("symbol", "day", *[(F.col(c) / F.col("_f")).alias(f"adj_{c}") for c in ("open", "high", "low", "close")], F.bround(F.col("volume") * F.col("_f")).cast("long").alias("adj_volume"), F.col("close").alias("raw_close"))


def no_trades(rows: DataFrame, delisted: DataFrame) -> DataFrame:
    """(symbol, day, reason) of rows that are no exchange trades, in this order: ``carried`` if the close repeats without volume; from
    the day of delisting (symbol, delisted_on) on ``otc``, that day itself ``halt`` if its close repeats and changes later; ``carried`` if the close
    repeats on less than a share of the line's median volume."""
    line = Window.partitionBy("symbol").orderBy("day")
    later = line.rowsBetween(1, Window.unboundedFollowing)
    r = rows.join(F.broadcast(delisted), "symbol", "left")
    median = rows.groupBy("symbol").agg(F.median("volume").alias("_median"))
    r = r.join(median, "symbol").withColumns({"_same": F.coalesce(F.lag("close").over(line) == F.col("close"), F.lit(False)), "_lo": F.min("close").over(later), "_hi": F.max("close").over(later)})
    same, gone = F.col("_same"), F.col("day") >= F.col("delisted_on")
    moves = (F.col("_lo") != F.col("close")) | (F.col("_hi") != F.col("close"))
    reason = (
        F.when(same & (F.col("volume") == 0), "carried").when(gone & (F.col("day") > F.col("delisted_on")), "otc")
        .when(gone, F.when(same & F.coalesce(moves, F.lit(False)), "halt").otherwise("otc")).when(same & (F.col("_median") > 0) & (F.col("volume") < CARRIED * F.col("_median")), "carried")
    )
    return r.select("symbol", "day", reason.alias("reason")).filter("reason IS NOT NULL")


def split_events(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(symbol, day, factor, kind) of rows with a factor: its ``known`` (symbol, day, kind) one, a plain split, or another action written as a factor."""
    f = F.col("split_factor")
    events = rows.filter(f.isNotNull() & ~f.isin(0.0, 1.0)).select("symbol", "day", f.alias("factor"))
    kind = F.coalesce("kind", F.when(F.round("factor", 6).isin(*PLAIN_SPLITS), F.lit("split")).otherwise(F.lit("other action")))
    return events.join(F.broadcast(known), ["symbol", "day"], "left").select("symbol", "day", "factor", kind.alias("kind"))


def from_arrays(answers: DataFrame) -> DataFrame:
    """(symbol, day, open, high, low, close, volume, source) of answers that hold a row's fields in arrays side by side (symbol, source, t, o, h, l, c, v)."""
    rows = answers.select("symbol", "source", F.inline(F.arrays_zip("t", "o", "h", "l", "c", "v")))
    return rows.select("symbol", F.to_date(F.timestamp_seconds("t")).alias("day"), F.col("o").alias("open"), F.col("h").alias("high"), F.col("l").alias("low"), F.col("c").alias("close"), F.col("v").alias("volume"), "source")


def first_vendor(candles: DataFrame, vendors: tuple[str, ...], start: str, end: str) -> DataFrame:
    """All candles of a symbol, in the range, from the first of ``vendors`` that has any; ``fallback`` says that it wasn't the first asked."""
    order = F.array_position(F.array(*map(F.lit, vendors)), F.col("source"))
    rows = candles.filter(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).withColumn("_o", order).filter("_o > 0")
    best = rows.groupBy("symbol").agg(F.min("_o").alias("_best"))
    return rows.join(best, "symbol").filter("_o = _best").withColumn("fallback", F.col("_o") > 1).drop("_o", "_best")


def actions(series: DataFrame, start: str, end: str, zone: str) -> DataFrame:
    """(symbol, day, kind, value) of dividends and splits (symbol, ts, kind, value) whose local date is in the range; zero values are none."""
    day = F.to_date(F.from_utc_timestamp("ts", zone))
    return series.select("symbol", day.alias("day"), "kind", "value").filter(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")) & (F.col("value") != 0))


def missing_sessions(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    """(symbol, expected, got, first_day, last_day, missing, reason): sessions (day, n) of the calendar without a row; all after the last row is a ``tail``, else ``inside``."""
    own = rows.join(sessions, "day").select("symbol", "day", "n").distinct()
    top = sessions.agg(F.max("n").alias("_all"))
    g = own.groupBy("symbol").agg(F.count("*").alias("got"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.min("n").alias("_a"), F.max("n").alias("_b")).join(F.broadcast(top))
    expected = F.col("_all") - F.col("_a") + 1
    tail = F.col("got") == F.col("_b") - F.col("_a") + 1
    return g.select("symbol", expected.alias("expected"), "got", "first_day", "last_day", (expected - F.col("got")).alias("missing"), F.when(expected == F.col("got"), F.lit(None)).when(tail, "tail").otherwise("inside").alias("reason"))


def exit_reason(got: Column, expected: Column, trimmed: Column) -> Column:
    """Why a line ends before its span: its tail was trimmed, or trading had ended; null if it doesn't."""
    return F.when(got >= expected, F.lit(None)).when(trimmed > 0, F.concat(trimmed.cast("string"), F.lit(" rows at the end were no trades"))).otherwise(F.lit("trading ended"))


def distribution_form(ours: DataFrame, other: DataFrame) -> DataFrame:
    """(symbol, shared, raw_gap, adjusted_gap, form) of distributions (symbol, day, cash, factor) against another source's (symbol, day, amount): which of the raw and the split-adjusted amount is nearer, ``raw`` where both are."""
    x = ours.join(other, ["symbol", "day"])
    g = x.groupBy("symbol").agg(F.count("*").alias("shared"), F.round(F.max(F.abs(F.col("cash") - F.col("amount"))), 6).alias("raw_gap"), F.round(F.max(F.abs(F.col("cash") / F.col("factor") - F.col("amount"))), 6).alias("adjusted_gap"))
    return g.withColumn("form", F.when(F.col("raw_gap") <= F.col("adjusted_gap"), "raw").otherwise("adjusted"))


def identified(lines: DataFrame) -> DataFrame:
    """(symbol, name, identified): whether a case-folded ``name`` holds one of the accepted ``patterns``."""
    return lines.select("symbol", "name", F.coalesce(F.exists("patterns", lambda p: F.lower("name").contains(F.lower(p))), F.lit(False)).alias("identified"))
