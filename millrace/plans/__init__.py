"""Helpers that shape a plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with ``cols``, each computed exactly once per row.

    Projections are merged and filters pushed through them by copying expressions, which makes costly
    ones run many times; a generator of one row stops both.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in cols.items()]))))
