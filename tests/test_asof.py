import datetime as dt

from millrace.operators import asof
from tests_shared import membership

SITES = [("a.test", "America/New_York", "mdy")]


def run(spark, articles, rows):
    sites = spark.createDataFrame(SITES, "domain string, time_zone string, date_order string")
    a = spark.createDataFrame(articles, "id long, ticker string, pub_date string, source_domain string, us string, gics_sector string")
    return sorted(map(tuple, asof.found(a, membership(spark, rows), sites).collect()))


def test_known_and_in_force(spark):
    rows = [
        ("ABC", "A", "s1", "x", "2020-01-01", "2021-12-31", None),
        ("ABC", "A", "s2", "y", "2020-06-01", "2021-12-31", "2020-09-01T00:00:00Z"),
        ("abc ", "A", "s3", "z", "2022-01-01", None, None),
        ("ABC", "A", "s3", "z", "2022-01-01", None, None),
        ("ABC", "A", "s4", "w", "2023-01-01", None, "not a time"),
    ]
    made = lambda i, t, p: (i, t, p, "a.test", "clash", "stored later")
    articles = [
        made(1, "abc", "2020-07-01T00:00:00Z"), made(2, " ABC", "2020-09-01T00:00:00Z"), made(3, "ABC", "2020-08-31 19:59:59"), made(4, "ABC", "2021-12-31"), made(5, "ABC", "2021-12-31 20:00:00"),
        made(6, None, "2022-01-01"), made(7, "ZZZ", "2022-01-01"), made(8, "ABC", "yesterday"), made(9, "ABC", None), made(10, "ABC", "2019-12-31"), made(11, "ABC", "2024-01-01T00:00:00.000000Z"),
    ]
    assert run(spark, articles, rows) == [(1, "2020-01-01"), (2, "2020-06-01"), (3, "2020-01-01"), (4, "2020-06-01"), (5, "2022-01-01"), (11, "2022-01-01")]


def test_empty(spark):
    assert run(spark, [], []) == []
    assert run(spark, [(1, "ABC", "2024-01-01", "a.test", "", "")], []) == []


def test_equals_brute_force(spark, small):
    from millrace.functions import timestamps as ts
    from millrace.sources.tables import table

    a, u, s = (table(spark, small, n) for n in ("articles", "universe_membership", "sites"))
    got = {r.id: r.valid_from for r in asof.found(a, u, s).collect()}
    want = {}
    rows = [r for r in u.collect()]
    for r in asof.article_moments(a, s).collect():
        at = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=r.us)
        fits = [
            m.valid_from for m in rows
            if r.ticker and m.symbol.strip().upper() == r.ticker.strip().upper() and m.valid_from <= at.date() <= (m.valid_to or dt.date(9999, 12, 31))
            and (m.gics_revision_timestamp is None or dt.datetime.strptime(m.gics_revision_timestamp, "%Y-%m-%dT%H:%M:%SZ") <= at)
        ]
        if fits:
            want[r.id] = str(max(fits))
    assert got == want and len(got) > 50
    assert ts.DAY_US == 86_400_000_000


def test_histories_too_many_to_broadcast(spark, monkeypatch):
    rows = [("A", "a", "s", "i1", "2020-01-01", "2020-12-31", None), ("A", "a", "s", "i2", "2021-01-01", None, None), ("B", "b", "s", "j", "2020-01-01", None, None)]
    events = spark.createDataFrame([(i, x, us) for i, (x, us) in enumerate([("A", 1_590_000_000_000_000), (" a ", 1_650_000_000_000_000), ("B", 1_650_000_000_000_000), ("Z", 1), (None, 1)] * 9)], "id long, ticker string, us long")
    got = []
    for most in (200_000, 0):
        monkeypatch.setattr(asof, "BROADCAST_ROWS", most)
        got.append(sorted(map(str, asof.match(events, asof.histories(membership(spark, rows))).collect())))
    assert got[0] == got[1] and len(got[0]) == 45
