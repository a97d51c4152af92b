import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import fields
from millrace.operators import facts, labels
from millrace.sources import schema, sinks
from tests_shared import day


def values(spark, rows, kind, col):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], f"v {kind}").select(col(F.col("v"))).collect()]


def test_ciks_dates_durations(spark):
    assert values(spark, ["12", " 0000000012", "12345678901", "x1", "", None], "string", fields.cik) == ["0000000012", "0000000012", "12345678901", None, None, None]
    assert values(spark, ["2020-01-02 (x)", "March 5, 2021", "Mar 5, 2021", "soon", None], "string", fields.written_date) == [day("2020-01-02"), day("2021-03-05"), day("2021-03-05"), None, None]
    assert values(spark, [3.9, 63.0, 3723.0, 0.0], "double", fields.duration) == ["3s", "1m03s", "1h02m03s", "0s"]


def test_spans_periods_signatures(spark):
    df = spark.createDataFrame([(day("2024-01-01"), day(e)) for e in ("2024-01-02", "2024-01-08", "2024-02-01", "2025-01-01", "2026-01-01")], "a date, b date")
    assert [r[0] for r in df.select(fields.span_class(F.col("a"), F.col("b"))).collect()] == ["d", "w", "m", "y", None]
    end, kind = fields.period_column(F.col("v"))
    got = spark.createDataFrame([("2024-03-31 (Q1)",), ("2024-12-31",), ("label",)], "v string").select(end, kind).collect()
    assert [tuple(r) for r in got] == [(day("2024-03-31"), "Q1"), (day("2024-12-31"), None), (None, None)]
    assert fields.signature(["b", "a"], 1) == fields.signature(["a", "b"], 1) != fields.signature(["a", "b"], 2) and len(fields.signature([], 0)) == 16


def test_symbol_on_cover(spark):
    assert values(spark, ["<b>Trading Symbol</b>&nbsp;(s) ABC on NYSE", "Trading Symbol ABCD", "ABC", None], "string", lambda c: fields.symbol_on_cover(c, F.lit("ABC"))) == [True, False, None, None]


def test_labels(spark):
    sample = spark.createDataFrame([(1, "yes"), (2, " No "), (3, "")], "id long, assistant_label string")
    manual = spark.createDataFrame([(1, "NO"), (2, "no"), (3, " ")], "id long, label string")
    got = {r.id: (r.label, r.agrees) for r in labels.merge_labels(sample, manual).collect()}
    assert got == {1: ("no", False), 2: ("no", True), 3: (None, None)}
    sheet = spark.createDataFrame([(1, "yes"), (1, "no"), (2, ""), (3, "maybe")], "id long, label string")
    assert tuple(labels.sheet_problems(sheet, spark.createDataFrame([(3,), (9,)], "id long")).first()) == (1, 1, 2)
    a, b = (spark.createDataFrame(r, "k string, v double") for r in ([("x", 1.0), ("y", 2.0)], [("x", 1.0), ("z", 3.0)]))
    assert sorted(r.k for r in labels.differences(a, b, "k", "v").collect()) == ["y", "z"]
    assert values(spark, ["  a \n b  c", None], "string", lambda c: labels.excerpt(c, 5)) == ["a b c", None]


def test_refresh_fills_places(spark):
    population = spark.createDataFrame([(i, "s" if i < 10 else "t") for i in range(20)], "id long, stratum string")
    sample = spark.createDataFrame([(1, "s"), (12, "s"), (99, "s"), (13, "t")], "id long, stratum string")
    got = labels.refresh(sample, population, "stratum", 3).collect()
    assert {1, 13} <= {r.id for r in got} and sum(r.stratum == "s" for r in got) == 3 and len({r.id for r in got}) == 4


FACT = "concept string, value double, unit_ref string, period_start date, period_end date, period_instant date, dims map<string,string>, ordinal int"


def fact(concept, value, start=None, end=None, at=None, unit="usd", dims=None, n=0):
    return (concept, value, unit, day(start), day(end), day(at), dims or {}, n)


def test_statement_cells_against_facts(spark):
    wide = spark.createDataFrame([(1, "Rev", 100.0, -7.0, 5.0), (2, "Cost", 50.0, None, 5.0)], "row_no int, concept string, `2024-03-31 (Q1)` double, `2024-12-31 (FY)` double, `2024-06-30` double")
    cells = facts.cells(wide, ["row_no", "concept"])
    filed = spark.createDataFrame(
        [fact("Rev", 120.0, "2024-01-01", "2024-03-31"), fact("Rev", 999.0, "2023-04-01", "2024-03-31"), fact("Rev", 7.5, "2024-01-01", "2024-12-31"), fact("Rev", 5.0, at="2024-06-30"), fact("Rev", 1.0, "2024-01-01", "2024-03-31", dims={"x": "y"}),
         fact("Cost", 1.0, "2024-01-01", "2024-03-31"), fact("Cost", 2.0, "2024-01-02", "2024-03-31"), fact("Cost", 5.0, at="2024-06-30", unit=None)], FACT)
    got = {(r.concept, r.column): (r.corrected, r.verdict) for r in facts.reconcile(cells, filed).collect()}
    assert got == {
        ("Rev", "2024-03-31 (Q1)"): (120.0, "corrected"), ("Rev", "2024-12-31 (FY)"): (-7.0, "equal"), ("Rev", "2024-06-30"): (5.0, "equal"),
        ("Cost", "2024-03-31 (Q1)"): (50.0, "ambiguous"), ("Cost", "2024-06-30"): (None, "unfiled"),
    }


def test_cover_shares(spark):
    rows = [fact("s", 10.0, at="2024-01-01", n=1), fact("s", 11.0, at="2024-01-01", n=2), fact("s", 4.0, at="2024-01-01", dims={"class_of_stock": "A"}), fact("s", 9.0, at="2024-01-01", dims={"other": "x"}), fact("s", -1.0, at="2024-01-02"), fact("s", 1.0)]
    got = [tuple(r) for r in facts.cover_shares(spark.createDataFrame(rows, FACT)).collect()]
    assert got == [(None, day("2024-01-01"), 11.0), ("A", day("2024-01-01"), 4.0)]


def test_schemas(spark, tmp_path):
    assert schema.table_or_empty(spark, str(tmp_path), "articles").columns == [c.split()[0] for c in schema.TABLES["articles"].split(", ")]
    spark.createDataFrame([(1, "u", "old")], "id int, url string, own string").write.parquet(f"{tmp_path}/discovered_urls.parquet")
    got = schema.table_or_empty(spark, str(tmp_path), "discovered_urls")
    row = got.first()
    assert row.match_class == "accept" and row.ticker is None and row.own == "old" and dict(got.dtypes)["id"] == "bigint"
    assert {r.problem: r.n for r in schema.violations(got).collect()} == {"match_class": 0, "no url": 0, "no ticker": 1}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1)), (2, None, None)], "i int, s string, d date")
    assert sinks.write_with_manifest(df, f"{tmp_path}/m")["rows"] == 2
    assert sinks.digest(df).first() == sinks.digest(df.orderBy(F.desc("i"))).first() != sinks.digest(df.limit(1)).first()
    queue = schema.evolve(spark.createDataFrame([(1, "u", "b"), (2, "v", "a")], "id long, url string, ticker string"), "discovered_urls")
    sinks.export_pending(queue, f"{tmp_path}/csv")
    assert [r.ticker for r in spark.read.option("header", True).csv(f"{tmp_path}/csv").collect()] == ["a", "b"]


def test_bounded_sets_are_checked(spark, monkeypatch):
    from millrace.operators import membership

    monkeypatch.setattr(membership, "SEARCHED_ROWS", 1)
    stints = spark.createDataFrame([("A", "1", None, None)], "symbol string, cik string, valid_from date, valid_to date")
    revisions = spark.createDataFrame([("1", "2024-01-01"), ("2", "2024-01-02")], "revid string, ts string").select("revid", F.to_timestamp("ts").alias("ts"), F.lit("A").alias("symbol"), F.lit("1").alias("cik"))
    with pytest.raises(ValueError):
        membership.last_revision(stints, revisions)


def test_parts_of_names_of_any_number(spark):
    from millrace.operators import membership

    names = spark.createDataFrame([("A", "Acme Co"), ("BAC", "acme"), ("C", None), ("D", "")], "symbol string, security string")
    asked = spark.createDataFrame([("a",), ("ac",), ("ACME",), ("me c",), ("bac",), ("zzz",), ("",), (None,)], "query string")
    assert {tuple(r) for r in membership.resolve(names, asked).collect()} == {("a", "A"), ("ac", "A"), ("ACME", "A"), ("me c", "A"), ("bac", "BAC")}
