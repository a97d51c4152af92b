import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import crawls, holds, membership, prices, reclass


def test_held_articles_keep_their_status_once_and_get_it_back(spark):
    a = spark.createDataFrame([(1, "ok", None), (2, "review", None), (3, "quarantined", "ok"), (4, "quarantined", "ok"), (5, "ok", "paywalled"), (6, None, None), (7, "ok", None), (8, "ok", None)], "id long, fetch_status string, prev_fetch_status string")
    c = spark.createDataFrame([(1, "reject"), (2, "review"), (3, "review"), (4, "accept"), (5, "accept"), (6, "reject"), (7, "accept"), (7, "accept"), (9, None)], "id long, match_class string")
    once = holds.synced(a, c)
    want = {1: ("quarantined", "ok"), 2: ("quarantined", "review"), 3: ("quarantined", "ok"), 4: ("ok", None), 5: ("ok", None), 6: ("quarantined", None), 7: ("ok", None), 8: ("ok", None)}
    assert {r.id: (r.fetch_status, r.prev_fetch_status) for r in once.collect()} == want
    assert {r.id: (r.fetch_status, r.prev_fetch_status) for r in holds.synced(once, c).collect()} == want
    assert tuple(holds.sync_counts(a, c).first()) == (3, 2, 0)
    assert holds.synced(a.limit(0), c).count() == 0


def pairs(spark, rows):
    schema = "id long, url string, company string, ticker string, title string, source string, status string, match_class string, match_reason string, fetch_status_code int"
    return spark.createDataFrame([(i, u, "Acme Widgets Inc.", "ACMW", t, "ddg", s, c, r, None) for i, u, t, s, c, r in rows], schema)


def test_fetched_titles_promote_and_never_demote(spark):
    q = pairs(spark, [(1, "https://h.test/a", None, "done", "review", "weak_ticker"), (2, "https://h.test/b", "x", "done", "accept", "alias"), (3, "https://h.test/c", "x", "skipped", "reject", "none"), (4, "https://h.test/d", "", "done", "review", None)])
    t = spark.createDataFrame([(1, "Acme Widgets rise"), (2, "nothing"), (3, "Acme Widgets rise"), (4, None), (77, "Acme Widgets")], "id long, title string")
    got = {r.id: (r.match_class, r.match_reason) for r in holds.reevaluated(q, t).collect()}
    assert got == {1: ("accept", "name"), 2: ("accept", "alias"), 3: ("reject", "none"), 4: ("review", None)}


def test_promotions_are_written_and_taken_back(spark):
    q = pairs(spark, [(1, "https://h.test/acme-widgets", "", "skipped", "reject", "none"), (2, "https://h.test/other", "", "skipped", "reject", "none"), (3, "https://h.test/acme-widgets-2", "", "done", "review", "x")])
    audit = reclass.promotions(q)
    assert [(r.id, r.new_class, r.new_status) for r in audit.collect()] == [(1, "accept", "pending")]
    after = reclass.applied(q, audit)
    assert {r.holds for r in reclass.conditions(q, after, audit).collect()} == {True}
    moved = after.withColumn("match_reason", F.when(F.col("id") == 1, "by hand").otherwise(F.col("match_reason")))
    assert {r.id: r.status for r in reclass.reverted(moved, audit).collect()}[1] == "pending"  # changed since: left alone
    key = lambda df: sorted(map(tuple, df.select("id", "match_class", "match_reason", "status").collect()))
    assert key(reclass.reverted(after, audit)) == key(q)
    assert {r.problem: r.n for r in reclass.problems(audit.withColumn("id", F.lit("x")), q).collect()}["not_a_number"] == 1


def bars(spark, rows):
    return spark.createDataFrame([("S", dt.date(2024, 1, d), c, c, c, c, float(v), f) for d, c, v, f in rows], "symbol string, day date, open double, high double, low double, close double, volume double, split_factor double")


def test_price_rows(spark):
    rows = bars(spark, [(2, 500.0, 10, 1.0), (3, 600.0, 5, 1.0), (4, 60.0, 7, 10.0), (5, 31.0, 0, 2.0), (8, 31.0, 0, None)])
    got = [(r.day.day, r.adj_close, r.adj_volume) for r in prices.adjusted(rows, "2024-01-02", "2024-01-05").orderBy("day").collect()]
    assert got == [(2, 25.0, 200), (3, 30.0, 100), (4, 30.0, 14), (5, 31.0, 0)]
    gone = spark.createDataFrame([("S", dt.date(2024, 1, 4))], "symbol string, delisted_on date")
    still = bars(spark, [(2, 5.0, 100, 1.0), (3, 5.0, 0, 1.0), (4, 5.0, 50, 1.0), (5, 3.0, 50, 1.0), (8, 3.0, 0, 1.0)])
    assert {r.day.day: r.reason for r in prices.no_trades(still, gone).collect()} == {3: "carried", 4: "halt", 5: "otc", 8: "carried"}
    none = gone.limit(0)
    assert {r.day.day: r.reason for r in prices.no_trades(bars(spark, [(2, 5.0, 100, 1.0), (3, 5.0, 9, 1.0), (4, 5.0, 100, 1.0)]), none).collect()} == {3: "carried"}
    assert prices.no_trades(still.limit(0), gone).count() == 0
    kinds = prices.split_events(rows, spark.createDataFrame([("S", dt.date(2024, 1, 5), "spin-off")], "symbol string, day date, kind string"))
    assert {r.day.day: r.kind for r in kinds.collect()} == {4: "split", 5: "spin-off"}
    named = spark.createDataFrame([("S", "ACME Inc", ["acme"]), ("T", "Zeta", ["acme"]), ("U", None, None)], "symbol string, name string, patterns array<string>")
    assert {r.symbol: r.identified for r in prices.identified(named).collect()} == {"S": True, "T": False, "U": False}


def test_a_snapshot_recorded_twice_changes_nothing(spark):
    stored = spark.createDataFrame([("A", dt.date(2020, 1, 1), None, "x"), ("B", dt.date(2020, 1, 1), None, "x"), ("C", dt.date(2020, 1, 1), dt.date(2021, 1, 1), "x")], "symbol string, valid_from date, valid_to date, source string")
    roster = spark.createDataFrame([("A", "a"), ("C", "c"), ("C", "c"), (None, "n")], "symbol string, security string")
    once = membership.record_snapshot(stored, roster, "2024-05-02")
    key = lambda df: sorted((r.symbol, str(r.valid_from), str(r.valid_to), r.source) for r in df.collect())
    assert key(once) == [("A", "2020-01-01", "None", "x"), ("B", "2020-01-01", "2024-05-01", "x"), ("C", "2020-01-01", "2021-01-01", "x"), ("C", "2024-05-02", "None", "snapshot")]
    assert key(membership.record_snapshot(once, roster, "2024-05-02")) == key(once)
    assert {r.symbol: str(r.valid_to) for r in membership.close_intervals(stored, roster, "2024-05-01").collect()} == {"A": "2024-05-01", "B": "None", "C": "2021-01-01"}


def test_crawl_policy(spark):
    at = lambda d, h=0: dt.datetime(2024, 5, d, h)
    rows = [("a", at(1), at(1, 1), True, dt.date(2023, 1, 1), "s"), ("a", at(9, 23), None, False, dt.date(2023, 1, 1), "s"), ("b", at(9), at(9, 1), True, dt.date(2023, 1, 1), "s"), ("c", at(9), at(9, 1), True, dt.date(2024, 1, 1), "s"), ("d", at(9), at(9, 1), True, dt.date(2023, 1, 1), "old")]
    log = spark.createDataFrame(rows, "domain string, started_at timestamp, finished_at timestamp, complete boolean, range_start date, signature string")
    asked = spark.createDataFrame([(x, "s", dt.date(2023, 6, 1)) for x in "abcde"], "domain string, signature string, start date")
    now = int(dt.datetime(2024, 5, 9, 23, 20, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    got = {r.domain: (r.usable, r.refresh, str(r.crawl_start), r.busy) for r in crawls.policy(log, asked, now).collect()}
    assert got == {"a": (True, True, "2023-01-01", True), "b": (True, False, "2023-01-01", False), "c": (False, True, "2023-06-01", False), "d": (False, True, "2023-06-01", False), "e": (False, True, "2023-06-01", False)}
