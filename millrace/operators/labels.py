"""Labelled samples: drawing, refreshing and merging them, and the figures they give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_labels(sample: DataFrame, manual: DataFrame) -> DataFrame:
    """``sample`` (id, assistant_label) with ``label``: a person's label before an assistant's; and whether the two agree."""
    clean = lambda c: F.nullif(F.lower(F.trim(c)), F.lit(""))
    own = manual.select("id", clean(F.col("label")).alias("_m")).filter("_m IS NOT NULL").dropDuplicates(["id"])
    rows = sample.join(own, "id", "left")
    return rows.withColumns({"label": F.coalesce("_m", clean(F.col("assistant_label"))), "agrees": F.col("_m") == clean(F.col("assistant_label"))}).drop("_m")


def refresh(sample: DataFrame, population: DataFrame, stratum: str, seed: int) -> DataFrame:
    """``sample`` (id, stratum) with rows that left their stratum replaced, place by place, by new ones of it.

    ``population`` is (id, stratum). Where a stratum has no more rows, places stay empty and are left out.
    """
    kept = sample.join(population, ["id", stratum], "left_semi")
    gone = sample.join(population, ["id", stratum], "left_anti").groupBy(stratum).agg(F.count("*").alias("_n"))
    fresh = population.join(sample.select("id"), "id", "left_anti").join(gone, stratum)
    from pyspark.sql import Window

    order = F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{seed}")))
    ranked = fresh.withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy(order, "id"))).filter(F.col("_r") <= F.col("_n"))
    return kept.select("id", stratum).unionByName(ranked.select("id", stratum))


def weighted(labelled: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, n, weight): labelled rows of each class, each standing for size / rows of its class."""
    n = labelled.groupBy(*keys).agg(F.count("*").alias("_n"))
    rows = labelled.join(n, keys).join(sizes, keys)
    return rows.groupBy(*keys, "label").agg(F.count("*").alias("n"), F.sum(F.col("size") / F.col("_n")).alias("weight"))


def sheet_problems(sheet: DataFrame, earlier: DataFrame, allowed: tuple[str, ...] = ("yes", "no", "unclear")) -> DataFrame:
    """One row: ids that repeat, ids used in an earlier sheet, rows with no label or another than allowed."""
    repeats = sheet.groupBy("id").count().filter("count > 1").agg(F.count("*").alias("repeated"))
    reused = sheet.select("id").distinct().join(earlier.select("id"), "id", "left_semi").agg(F.count("*").alias("reused"))
    odd = sheet.agg(F.count_if(~F.coalesce(F.lower(F.trim("label")).isin(*allowed), F.lit(False))).alias("unlabelled"))
    return repeats.join(F.broadcast(reused)).join(F.broadcast(odd))


def differences(actual: DataFrame, expected: DataFrame, key: str, value: str, tolerance: float = 0.0) -> DataFrame:
    """(key, actual, expected) where two sets of figures differ, or only one has the key."""
    x = actual.select(key, F.col(value).alias("actual")).join(expected.select(key, F.col(value).alias("expected")), key, "full_outer")
    far = F.coalesce(F.abs(F.col("actual") - F.col("expected")) > tolerance, F.lit(True))
    return x.filter(far & ~(F.col("actual").isNull() & F.col("expected").isNull()))


def excerpt(body: Column, length: int = 400) -> Column:
    """The head of a text on one line."""
    return F.substring(F.regexp_replace(F.trim(body), r"\s+", " "), 1, length)


def spliced(sample: DataFrame, old: DataFrame) -> DataFrame:
    """A new labelling sheet: each row of ``sample`` (id, ordinal) in its place, with the label and notes that ``old`` has for its id, else blank."""
    kept = old.filter(F.trim(F.coalesce("label", F.lit(""))) != "").select("id", F.col("label").alias("_l"), F.col("notes").alias("_n")).dropDuplicates(["id"])
    return sample.join(kept, "id", "left").select("id", "ordinal", F.coalesce("_l", F.lit("")).alias("label"), F.coalesce("_n", F.lit("")).alias("notes"))


def verdict(labelled: DataFrame, most_wrong: int = 5, most_missed: int = 1) -> DataFrame:
    """One row (wrong, missed, unlabelled, passed) of (match_class, label): accepts that are wrong, rejects that are right, rows without yes or no."""
    wrong, missed = F.count_if((F.col("match_class") == "accept") & (F.col("label") == "no")), F.count_if((F.col("match_class") == "reject") & (F.col("label") == "yes"))
    none = F.count_if(~F.coalesce(F.col("label").isin("yes", "no"), F.lit(False)))
    return labelled.agg(wrong.alias("wrong"), missed.alias("missed"), none.alias("unlabelled")).withColumn("passed", (F.col("wrong") <= most_wrong) & (F.col("missed") <= most_missed) & (F.col("unlabelled") == 0))
