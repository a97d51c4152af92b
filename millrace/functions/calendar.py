"""The trading calendar as a dimension: holidays by rule, sessions, and steps between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: fixed values: days closed outside the rules
SPECIAL_CLOSURES = ("2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14", "2004-06-11", "2007-01-02", "2012-10-29", "2012-10-30", "2018-12-05", "2025-01-09")


def easter(year: Column) -> Column:
    """Easter Sunday (Gregorian) of a year."""
    div = lambda a, b: F.floor(a / b).cast("int")
    golden, century = year % 19, div(year, F.lit(100))
    skipped = div(century, F.lit(4))
    correction = div(century - div(century + 8, F.lit(25)) + 1, F.lit(3))
    epact = (19 * golden + century - skipped - correction + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * div(year % 100, F.lit(4)) - epact - (year % 100) % 4) % 7
    late = div(golden + 11 * epact + 22 * weekday, F.lit(451))
    days = epact + weekday - 7 * late + 114
    return F.make_date(year, div(days, F.lit(31)), days % 31 + 1)


def _nth(year: Column, month: int, weekday: str, n: int) -> Column:
    """The n-th ``weekday`` of a month; the last for n = -1."""
    if n < 0:
        return F.date_sub(F.next_day(F.last_day(F.make_date(year, F.lit(month), F.lit(1))), weekday), 7)
    return F.date_add(F.next_day(F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1), weekday), 7 * (n - 1))


def _observed(day: Column) -> Column:
    """Saturday's holiday is kept on Friday, Sunday's on Monday."""
    w = F.weekday(day)
    return F.when(w == 5, F.date_sub(day, 1)).when(w == 6, F.date_add(day, 1)).otherwise(day)


def holidays(spark: SparkSession, first: int, last: int) -> DataFrame:
    """(day, holiday) of all years ``first``..``last``."""
    y = F.col("y")
    fixed = lambda m, d: _observed(F.make_date(y, F.lit(m), F.lit(d)))
    new_year = F.make_date(y, F.lit(1), F.lit(1))
    rules = {
        "new_year": F.when(F.weekday(new_year) != 5, _observed(new_year)), "king": _nth(y, 1, "Mon", 3), "washington": _nth(y, 2, "Mon", 3), "good_friday": F.date_sub(easter(y), 2),
        "memorial": _nth(y, 5, "Mon", -1), "juneteenth": F.when(y >= 2022, fixed(6, 19)), "independence": fixed(7, 4), "labor": _nth(y, 9, "Mon", 1), "thanksgiving": _nth(y, 11, "Thu", 4), "christmas": fixed(12, 25),
    }
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("y"))
    ruled = years.select(F.inline(F.array(*[F.struct(c.alias("day"), F.lit(k).alias("holiday")) for k, c in rules.items()])))
    special = spark.range(1).select(F.explode(F.array(*[F.lit(d).cast("date") for d in SPECIAL_CLOSURES])).alias("day"), F.lit("special").alias("holiday")).filter(F.year("day").between(first, last))
    return ruled.unionByName(special).filter("day IS NOT NULL")


def sessions(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(day, n): trading days of a range, numbered from 1."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day")).filter(F.weekday("day") < 5)
    closed = holidays(spark, int(start[:4]) - 1, int(end[:4]) + 1).select("day")
    return days.join(F.broadcast(closed), "day", "left_anti").withColumn("n", F.row_number().over(Window.orderBy("day")).cast("long"))


def windows(spark: SparkSession, start: str, end: str, days: int) -> DataFrame:
    """(first, last): stretches of ``days`` days from ``start``, the last cut at ``end``."""
    first = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(f"interval {days} days"))).alias("first")
    return spark.range(1).select(first).select("first", F.least(F.date_add("first", days - 1), F.lit(end).cast("date")).alias("last"))


def stepped(days: DataFrame, calendar: DataFrame, steps: int = 1) -> DataFrame:
    """(day, last, next): for each of ``days`` (day) the last session on or before it and the ``steps``-th after it, null where ``calendar`` (day, n) ends.

    One window over the dates of both, of which there are some hundreds a year.
    """
    both = days.select("day").distinct().withColumn("_asked", F.lit(True)).join(calendar.select("day", "n"), "day", "full_outer")
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = both.withColumns({"_n": F.coalesce(F.max("n").over(upto), F.lit(0)), "last": F.max(F.when(F.col("n").isNotNull(), F.col("day"))).over(upto)}).filter("_asked")
    later = calendar.select((F.col("n") - steps).alias("_n"), F.col("day").alias("next"))
    return at.join(F.broadcast(later), "_n", "left").select("day", "last", "next")


def off_calendar(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """(day): those of ``days`` (day) that are no session: none where a series is in order."""
    return days.select("day").distinct().join(F.broadcast(calendar.select("day")), "day", "left_anti")
