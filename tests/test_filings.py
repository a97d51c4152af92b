from millrace.operators import filings
from tests_shared import day

ROWS = [("1", "10-K", "2023-02-01", "a"), ("1", "10-K", "2024-02-01", "b"), ("1", "10-Q", "2024-05-01", "c"), ("2", "10-K", "2022-01-01", "d")]


def table(spark):
    return spark.createDataFrame([(c, f, day(d), a) for c, f, d, a in ROWS], "cik string, form string, filing_date date, accession_number string")


def test_lists(spark):
    t = table(spark)
    assert [r.accession_number for r in filings.listed(t, "10-K", 2).collect()] == ["b", "a"]
    assert {r.cik: r.accession_number for r in filings.latest(t, "10-K").collect()} == {"1": "b", "2": "d"}
    assert sorted(map(tuple, filings.years(t).collect())) == [("1", 2023), ("1", 2024), ("2", 2022)]
    assert [r.accession_number for r in filings.of_year(t, "10-K", 2023).collect()] == ["a"]
    texts = spark.createDataFrame([(1, "A Merger plan"), (2, None), (3, "none")], "id int, text string")
    assert [r.id for r in filings.mentioning(texts, "mERGER").collect()] == [1]


def test_filing_of_a_span(spark):
    spans = spark.createDataFrame([("1", day("2024-01-01"), day("2024-12-31")), ("1", day("2023-03-01"), day("2023-12-31")), ("2", day("2020-01-01"), day("2021-12-31"))], "cik string, start date, end date")
    got = sorted((str(r.start), r.form, str(r.filing_date)) for r in filings.picked(table(spark), spans, ("10-K", "10-Q")).collect())
    assert got == [("2023-03-01", "10-K", "2023-02-01"), ("2024-01-01", "10-K", "2024-02-01")]


def test_contradicted_totals(spark):
    total, name = filings.TOTAL_CONCEPTS[0], "Total revenues"
    rows = [(1, total, "Revenues", "2024", 1000.0), (2, "x", "Small", "2024", 20.0), (3, "y", name, "2024", 600.0), (1, total, "Revenues", "2023", 1000.0), (2, "x", "Large", "2023", 400.0), (3, "y", name, "2023", 600.0), (1, total, "Revenues", "2022", 1000.0), (3, "y", name, "2022", 990.0), (4, "z", "Total cost of revenues", "2022", 10.0)]
    got = {r.column: (r.rendered, r.corrected) for r in filings.contradicted_totals(spark.createDataFrame(rows, "row_no int, concept string, label string, column string, value double")).collect()}
    assert got == {"2024": (1000.0, 580.0), "2023": (1000.0, None)}
