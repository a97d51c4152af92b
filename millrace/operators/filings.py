"""Lists of filings, text search in them, and totals that their own statement contradicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fixed values: concepts of a revenue total, labels that read like one or only seem to, and how far a later total may fall short
TOTAL_CONCEPTS = ("us-gaap_Revenues", "us-gaap_RevenuesNetOfInterestExpense", "us-gaap_RegulatedAndUnregulatedOperatingRevenue")
TOTAL_LABEL, NOT_TOTAL_LABEL = r"(?i)\btotal\b.{0,40}\brevenues?\b", r"(?i)\bcost\b"
CONTRADICTED, BETWEEN = 0.75, 0.25


def listed(filings: DataFrame, form: str | None = None, most: int = 10) -> DataFrame:
    """The newest ``most`` filings, of one form if given."""
    rows = filings if form is None else filings.filter(F.col("form") == form)
    return rows.orderBy(F.desc("filing_date"), F.desc("accession_number")).limit(most)


def latest(filings: DataFrame, form: str) -> DataFrame:
    """Per cik the newest filing of a form."""
    rest = [c for c in filings.columns if c not in ("cik", "filing_date", "accession_number")]
    g = filings.filter(F.col("form") == form).groupBy("cik").agg(F.max(F.struct("filing_date", "accession_number", *rest)).alias("r"))
    return g.select("cik", "r.*").select(*filings.columns)


def years(filings: DataFrame, form: str | None = None) -> DataFrame:
    """(cik, year) of all filings."""
    rows = filings if form is None else filings.filter(F.col("form") == form)
    return rows.select("cik", F.year("filing_date").alias("year")).distinct()


def of_year(filings: DataFrame, form: str, year: int) -> DataFrame:
    return filings.filter((F.col("form") == form) & (F.year("filing_date") == year))


def picked(filings: DataFrame, spans: DataFrame, forms: tuple[str, ...]) -> DataFrame:
    """(cik, start, end, form, filing_date): per span a filing of ``forms``, one filed within it before any filed by its end,
    then by the order of ``forms``, then the newest."""
    order = F.array_position(F.array(*map(F.lit, forms)), F.col("form"))
    rows = spans.join(filings.filter(F.col("form").isin(*forms)).select("cik", "form", "filing_date"), "cik").filter(F.col("filing_date") <= F.col("end"))
    g = rows.groupBy("cik", "start", "end").agg(F.max(F.struct((F.col("filing_date") >= F.col("start")).alias("own"), (-order).alias("o"), "filing_date", "form")).alias("b"))
    return g.select("cik", "start", "end", "b.form", "b.filing_date")


def mentioning(texts: DataFrame, keyword: str) -> DataFrame:
    """Filings whose text has the keyword, without regard to case."""
    return texts.filter(F.lower("text").contains(keyword.lower()))


def contradicted_totals(cells: DataFrame) -> DataFrame:
    """(column, concept, rendered, corrected) where a later row that reads as the total is far below the first total concept.

    ``cells`` is (row_no, concept, label, column, value) without headings and dimensions. The later total less the
    rows between stands in if each of those is small beside it, else the value is null.
    """
    first = cells.filter(F.col("concept").isin(*TOTAL_CONCEPTS)).agg(F.min("row_no").alias("first_no"))
    own = cells.join(F.broadcast(first), F.col("row_no") == F.col("first_no")).select("column", "first_no", F.col("concept").alias("t_concept"), F.col("value").alias("total"))
    later = cells.join(own, "column").filter((F.col("row_no") > F.col("first_no")) & F.col("label").rlike(TOTAL_LABEL) & ~F.col("label").rlike(NOT_TOTAL_LABEL) & (F.col("value") > 0) & (F.col("value") < CONTRADICTED * F.col("total")))
    found = later.groupBy("column", "first_no", "t_concept", "total").agg(F.min(F.struct("row_no", "value")).alias("l"))
    inside = found.join(cells.select("column", F.col("row_no").alias("b_no"), F.col("value").alias("b")), "column", "left").withColumn("b", F.when((F.col("b_no") > F.col("first_no")) & (F.col("b_no") < F.col("l.row_no")), F.col("b")))
    g = inside.groupBy("column", "t_concept", "total", "l").agg(F.coalesce(F.sum("b"), F.lit(0.0)).alias("between"), F.coalesce(F.max(F.abs("b")), F.lit(0.0)).alias("most"))
    safe = F.when(F.col("most") <= BETWEEN * F.col("l.value"), F.col("l.value") - F.col("between"))
    return g.select("column", F.col("t_concept").alias("concept"), F.col("total").alias("rendered"), safe.alias("corrected"))
