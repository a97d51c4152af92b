"""Ordered analytics over time series, per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def later_product(factor: Column, key: str, day: str) -> Column:
    """Product of ``factor`` over the rows of ``key`` strictly after each row's day; null, 0 and 1 count for nothing."""
    later = Window.partitionBy(key).orderBy(F.col(day).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.when(factor.isNotNull() & (factor != 0), F.abs(factor)).otherwise(F.lit(1.0))
    log_all = F.sum(F.log(own)).over(later)
    log_same = F.sum(F.log(own)).over(Window.partitionBy(key, day))
    return F.exp(log_all - log_same)


def change_ratio(value: Column, key: str, day: str) -> Column:
    """Value over the row before, minus one; null for the first row and after a zero."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(day))
    return F.when(before != 0, value / before - 1)


def busiest(events: DataFrame, key: str, at: str, micros: int) -> DataFrame:
    """(key, most): the most events of a key in any stretch of ``micros`` that ends at an event, its start left out.

    Events of one instant are counted first. Each block of ``micros`` is a partition of its own, with the block before as
    what its stretches reach back to, so that a key of any size is many tasks.
    """
    us = F.unix_micros(F.col(at))
    each = events.filter(F.col(at).isNotNull()).groupBy(key, us.alias("_us")).agg(F.count("*").alias("_c")).withColumn("_b", F.floor(F.col("_us") / micros).cast("long"))
    both = each.select(key, "_us", "_c", F.inline(F.array(F.struct(F.col("_b").alias("_block"), F.lit(True).alias("_own")), F.struct((F.col("_b") + 1).alias("_block"), F.lit(False).alias("_own")))))
    w = Window.partitionBy(key, "_block").orderBy("_us").rangeBetween(-(micros - 1), Window.currentRow)
    return both.select(key, "_own", F.sum("_c").over(w).alias("n")).filter("_own").groupBy(key).agg(F.max("n").alias("most"))


def sessionize(events: DataFrame, key: str, at: str, gap_seconds: int) -> DataFrame:
    """(key, started, ended, n): runs of events with no gap over ``gap_seconds``."""
    line = Window.partitionBy(key).orderBy(at)
    fresh = (F.unix_micros(at) - F.unix_micros(F.lag(at).over(line)) > gap_seconds * 1_000_000) | F.lag(at).over(line).isNull()
    runs = events.filter(F.col(at).isNotNull()).withColumn("_s", F.sum(fresh.cast("int")).over(line))
    return runs.groupBy(key, "_s").agg(F.min(at).alias("started"), F.max(at).alias("ended"), F.count("*").alias("n")).drop("_s")


def compare(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """One row: keys in both, only in either, and the greatest absolute difference of ``value``."""
    x = a.select(key, F.col(value).alias("_a")).join(b.select(key, F.col(value).alias("_b")), key, "full_outer")
    return x.agg(
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("shared"), F.count_if(F.col("_b").isNull()).alias("only_a"),
        F.count_if(F.col("_a").isNull()).alias("only_b"), F.round(F.max(F.abs(F.col("_a") - F.col("_b"))), 6).alias("max_difference"),
    )
