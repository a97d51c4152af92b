"""Rendered statements against filed facts: wide rows made long, candidates by period, one verdict per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.fields import period_column

#: fixed values: days of a period by its kind; greatest difference of equal values; longest duration of an untagged column
DAYS = {"Q": (80, 100), "YTD": (175, 285), "FY": (351, 10**6)}
TOLERANCE, UNTAGGED_DAYS = 1.0, 371


def cells(wide: DataFrame, keys: list[str]) -> DataFrame:
    """A row per period cell of ``wide``: keys, column, end_date, kind, value. Period columns are told by their names."""
    spans = [c for c in wide.columns if c not in keys and c[:4].isdigit() and c[4:5] == "-"]
    long = wide.unpivot(keys, spans, "column", "value")
    end, kind = period_column(F.col("column"))
    return long.select(*keys, "column", end.alias("end_date"), kind.alias("kind"), F.col("value").try_cast("double").alias("value")).filter("end_date IS NOT NULL AND value IS NOT NULL")


def filed(facts: DataFrame) -> DataFrame:
    """Facts without dimensions that have a unit and a number: (concept, end_date, days, fact); days is null for an instant."""
    ok = facts.filter((F.coalesce(F.size("dims"), F.lit(0)) <= 0) & F.col("unit_ref").isNotNull() & F.col("value").isNotNull())
    return ok.select("concept", F.coalesce("period_end", "period_instant").alias("end_date"), F.datediff("period_end", "period_start").alias("days"), F.col("value").alias("fact"))


def _fits(kind: Column, days: Column) -> Column:
    short = F.substring(kind, 1, 1)
    q, ytd, fy = (days.between(*DAYS[k]) for k in ("Q", "YTD", "FY"))
    return F.when(kind == "YTD", ytd).when(kind == "FY", fy).when(short == "Q", q).otherwise(days.isNull() | days.between(1, UNTAGGED_DAYS))


def reconcile(statement: DataFrame, facts: DataFrame) -> DataFrame:
    """(row_no, concept, column, rendered, corrected, verdict) per cell of (row_no, concept, column, end_date, kind, value).

    One filed candidate of another size gives its size with the rendered sign (``corrected``); none gives null
    (``unfiled``); several distinct ones leave the cell (``ambiguous``), as does an equal one (``equal``).
    A column without a kind is only checked for having any candidate.
    """
    own = filed(facts).distinct()
    joined = statement.join(own, ["concept", "end_date"], "left").withColumn("_ok", F.col("fact").isNotNull() & F.coalesce(_fits(F.col("kind"), F.col("days")), F.lit(False)))
    g = joined.groupBy("row_no", "concept", "column", "kind", F.col("value").alias("rendered")).agg(F.count_distinct(F.when(F.col("_ok"), F.col("fact"))).alias("n"), F.max(F.when(F.col("_ok"), F.col("fact"))).alias("fact"))
    equal = F.abs(F.abs(F.col("fact")) - F.abs(F.col("rendered"))) <= TOLERANCE
    verdict = F.when(F.col("n") == 0, "unfiled").when(F.col("n") > 1, "ambiguous").when(F.col("kind").isNull() | equal, "equal").otherwise("corrected")
    g = g.withColumn("verdict", verdict)
    fixed = F.when(F.col("verdict") == "corrected", F.abs("fact") * F.when(F.col("rendered") < 0, -1.0).otherwise(1.0)).when(F.col("verdict") != "unfiled", F.col("rendered"))
    return g.select("row_no", "concept", "column", "rendered", fixed.alias("corrected"), "verdict")


def cover_shares(facts: DataFrame, class_axis: str = "class_of_stock") -> DataFrame:
    """(share_class, day, shares): the last fact of each class and day with no other dimension; the total has a null class and comes first."""
    other = F.size(F.filter(F.map_keys(F.coalesce("dims", F.create_map().cast("map<string,string>"))), lambda k: k != class_axis))
    ok = facts.filter((other == 0) & (F.col("value") >= 0) & ~F.isnan("value") & F.col("period_instant").isNotNull())
    rows = ok.select(F.try_element_at("dims", F.lit(class_axis)).alias("share_class"), F.col("period_instant").alias("day"), "value", "ordinal")
    return rows.groupBy("share_class", "day").agg(F.max_by("value", "ordinal").alias("shares")).orderBy(F.col("share_class").asc_nulls_first(), "day")
