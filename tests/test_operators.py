import math

from pyspark.sql import functions as F

from millrace.functions import articles as A
from millrace.functions import calendar
from millrace.operators import audit, crawls, membership, queue, series
from tests_shared import day

QUEUE = "id long, url string, domain string, company string, ticker string, source string, discovered_at string, pub_date string, title string, status string, fetch_status_code int, match_class string, match_reason string, query string"


def pair(i, url, cls, reason=None, query=None, status="pending", ticker="T"):
    return (i, url, "d", "c", ticker, "s", None, None, None, status, None, cls, reason, query)


def merged(spark, stored, batch):
    s = spark.createDataFrame(stored, QUEUE)
    b = spark.createDataFrame(batch, QUEUE).withColumn("ordinal", F.col("id"))
    return {(r.url, r.ticker): (r.id, r.status, r.match_class, r.match_reason, r.query) for r in queue.merge(s, b).collect()}


def test_merge_promotes_only(spark):
    stored = [pair(1, "a", "review", "r1"), pair(2, "b", "accept", None), pair(3, "c", "reject", "none", status="skipped"), pair(4, "d", "reject", "none", status="failed")]
    batch = [
        pair(10, "a", "accept", "new"), pair(11, "a", "accept", "second", "q"), pair(12, "b", "reject", "low", "q2"), pair(13, "c", "review", "up"), pair(14, "d", "accept", "up"),
        pair(15, "n", "reject", "x"), pair(16, "n", "review", "y"), pair(17, "m", "reject", "x"), pair(18, "a", "accept", "other", ticker="U"), pair(19, "bad", "odd"), pair(20, None, "accept"),
    ]
    got = merged(spark, stored, batch)
    assert got[("a", "T")] == (1, "pending", "accept", "new", "q")
    assert got[("b", "T")] == (2, "pending", "accept", "low", "q2")
    assert got[("c", "T")] == (3, "pending", "review", "up", None)
    assert got[("d", "T")] == (4, "failed", "accept", "up", None)
    assert got[("n", "T")] == (5, "pending", "review", "y", None)
    assert got[("m", "T")] == (6, "skipped", "reject", "x", None)
    assert got[("a", "U")][:3] == (7, "pending", "accept")
    assert len(got) == 7


def test_merge_is_idempotent_and_takes_empty(spark):
    stored = [pair(1, "a", "review", "r1")]
    once = merged(spark, stored, [pair(5, "a", "accept", "n"), pair(6, "z", "accept", "n")])
    again = merged(spark, [pair(i, u, c, r, q, s) for (u, _), (i, s, c, r, q) in once.items()], [pair(5, "a", "accept", "n"), pair(6, "z", "accept", "n")])
    assert once == again
    assert merged(spark, [], []) == {} and set(merged(spark, stored, [])) == {("a", "T")}


def test_page(spark):
    q = spark.createDataFrame([pair(i, f"u{i}", "accept", query="x") for i in range(10)], QUEUE)
    rows, total = queue.page(q, match_class="accept", url_part="U", order_by="id", descending=True, limit=3, offset=2)
    assert [r.id for r in rows.collect()] == [7, 6, 5] and total.first().total == 10


def test_upsert_never_sets_back(spark):
    schema = "domain string, url string, lastmod string, title string, first_seen timestamp, last_seen timestamp"
    import datetime as dt

    t = lambda d: dt.datetime(2024, 1, d)
    a = spark.createDataFrame([("d", "u", "new", None, t(2), t(9))], schema)
    b = spark.createDataFrame([("d", "u", "old", "x", t(1), t(5)), ("d", "v", None, None, t(5), t(5))], schema)
    got = {r.url: (r.lastmod, r.first_seen.day, r.last_seen.day) for r in crawls.upsert(a, b).collect()}
    assert got == {"u": ("new", 1, 9), "v": (None, 5, 5)}


def test_stints_from_changes(spark):
    log = [(0, "2024-03-01", "A", "add"), (0, "2024-03-01", "B", "remove"), (1, "2023-05-01", "B", "add"), (2, "2022-01-01", "A", "remove"), (3, "2021-01-01", "A", "remove"), (4, "2020-01-01", "C", "remove"), (5, "2019-06-01", "D", "add")]
    changes = spark.createDataFrame([(o, day(d), s, k) for o, d, s, k in log], "ordinal int, effective_date date, symbol string, kind string")
    roster = spark.createDataFrame([("A", None), ("E", day("2021-07-01"))], "symbol string, date_added date")
    got = sorted((r.symbol, str(r.valid_from), str(r.valid_to)) for r in membership.stints_from_changes(changes, roster, "2019-06-01").collect())
    assert got == [("A", "2019-06-01", "2021-12-31"), ("A", "2024-03-01", "None"), ("B", "2023-05-01", "2024-02-29"), ("C", "2019-06-01", "2019-12-31"), ("E", "2021-07-01", "None")]


def test_last_revision(spark):
    import datetime as dt

    stints = spark.createDataFrame([("A", "1", day("2022-01-01"), day("2022-06-30")), ("B", "2", day("2022-01-01"), day("2022-06-30"))], "symbol string, cik string, valid_from date, valid_to date")
    revs = [(1, dt.datetime(2022, 3, 1), "A", "1", "x"), (2, dt.datetime(2022, 6, 30, 23), "Z", "9", "x"), (3, dt.datetime(2022, 7, 2), "A", "1", "x")]
    got = {r.symbol: (r.revid, r.depth) for r in membership.last_revision(stints, spark.createDataFrame(revs, "revid int, ts timestamp, symbol string, cik string, gics_sector string")).collect()}
    assert got == {"A": (1, 1), "B": (None, None)}


def test_wilson_and_rates(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 10.0), (5.0, 10.0), (10.0, 10.0)], "k double, n double")
    low, high = audit.wilson(F.col("k"), F.col("n"))
    got = [tuple(r) for r in df.select(low, high).collect()]
    assert got[0] == (0.0, 0.0) and math.isclose(got[2][0], 0.2366, abs_tol=1e-4) and math.isclose(got[2][1], 0.7634, abs_tol=1e-4)
    assert got[1][0] == 0.0 and got[3][1] == 1.0


def test_sample_is_stable_and_complete(spark):
    df = spark.range(1000).withColumn("stratum", F.when(F.col("id") < 900, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 30)))
    a, b = (sorted(map(tuple, audit.sample(df, "stratum", 5, 7).select("stratum", "id", "stratum_size").collect())) for _ in range(2))
    assert a == b and sum(s == "big" for s, _, _ in a) == 5 and {n for s, _, n in a if s == "big"} == {900}


def test_walls(spark):
    df = spark.createDataFrame([("Just a moment...",), ("It was just a moment",), ("Please verify you are human now",), ("Subscribe to continue",), (" x " * 200 + "subscribe to continue",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(A.wall_kind(F.col("t"))).collect()] == ["failed", None, "failed", "paywalled", None, None, None]


def test_page_fields():
    graph = '<script type="application/ld+json">{"@graph":[{"@type":["Article"],"headline":"H","datePublished":"D","author":[{"name":"N"}]}]}</script>'
    assert A.page_fields(graph) == ("H", "D", "N")
    assert A.page_fields('<script type="application/ld+json">{bad</script><title> T </title><meta name="author" content="X">') == ("T", None, "X")
    assert A.page_fields('<meta property="og:title" content="O"><title>T</title>') == ("O", None, None)
    assert A.page_fields(None) == (None, None, None)


def test_holidays(spark):
    got = {r.day for r in calendar.holidays(spark, 2021, 2025).collect()}
    assert {day(d) for d in ("2021-04-02", "2022-06-20", "2021-12-24", "2023-01-02", "2024-03-29", "2025-01-09", "2024-11-28", "2022-05-30")} <= got
    assert not {day(d) for d in ("2021-06-18", "2021-12-31", "2022-01-01")} & got


def test_later_product(spark):
    df = spark.createDataFrame([("a", day("2024-01-01"), None), ("a", day("2024-01-02"), 2.0), ("a", day("2024-01-03"), 5.0), ("a", day("2024-01-04"), 0.0)], "k string, d date, f double")
    got = df.withColumn("p", series.later_product(F.col("f"), "k", "d")).orderBy("d").collect()
    assert [round(r.p, 9) for r in got] == [10.0, 5.0, 1.0, 1.0]


def test_compare(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    b = spark.createDataFrame([(2, 2.5), (3, 1.0)], "k int, v double")
    assert tuple(series.compare(a, b, "k", "v").first()) == (1, 1, 1, 0.5)


def test_replace_rows(spark):
    old = spark.createDataFrame([(1, "a", "kept"), (2, "b", None)], "id int, v string, prev string")
    new = spark.createDataFrame([(1, "x", "lost"), (3, "y", "z")], "id int, v string, prev string")
    got = {r.id: (r.v, r.prev) for r in queue.replace_rows(old, new, ["id"], keep=("prev",)).collect()}
    assert got == {1: ("x", "kept"), 2: ("b", None), 3: ("y", None)}


def test_run_summary(spark):
    rows = [("d", "t", 1, None), ("d", "u", 2, "e1"), ("d", "v", None, "e2"), ("d", "w", 0, "e2"), ("x", "t", None, None)]
    got = {r.domain: tuple(r)[1:] for r in queue.run_summary(spark.createDataFrame(rows, "domain string, ticker string, inserted int, error string"), 1).collect()}
    assert got == {"d": (4, 3, 2, "e2 x2 and 1 more"), "x": (1, 0, 0, "")}


def test_label_stability(spark):
    import datetime as dt

    rows = [(dt.datetime(2024, 1, 1), "A", "1", "x"), (dt.datetime(2024, 1, 31), "A", "1", "x"), (dt.datetime(2024, 2, 15), "A", "1", "y"), (dt.datetime(2024, 1, 1), "A", "2", None)]
    got = sorted((r.cik, str(r.ts)[:10], r.same) for r in membership.label_stability(spark.createDataFrame(rows, "ts timestamp, symbol string, cik string, label string")).collect())
    assert got == [("1", "2024-01-01", None), ("1", "2024-01-31", True), ("1", "2024-02-15", False), ("2", "2024-01-01", None)]
