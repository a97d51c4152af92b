import itertools

from pyspark.sql import functions as F

from millrace.functions import timestamps as ts
from millrace.operators import moments

SITES = [("ny.test", "America/New_York", "mdy"), ("ln.test", "Europe/London", "dmy"), ("in.test", "Asia/Kolkata", "dmy"), ("free.test", "UTC", None)]


def sites(spark):
    return spark.createDataFrame(SITES, "domain string, time_zone string, date_order string")


def read(spark, values):
    df = spark.createDataFrame([(i, v, d) for i, (v, d) in enumerate(values)], "ord_key long, value string, domain string")
    out = moments.resolve(df, sites(spark), source=["domain"]).select("ord_key", ts.format_us(F.col("us")).alias("utc")).collect()
    got = {r.ord_key: r.utc for r in out}
    return [got.get(i) for i in range(len(values))]


def test_notations(spark):
    cases = [
        ("2024-12-18T15:06:55Z", "ny.test", "2024-12-18T15:06:55.000000Z"),
        ("2024-12-18t15:06:55z", "ny.test", "2024-12-18T15:06:55.000000Z"),
        (" 2024-12-18 15:06:55 UTC  ", "ny.test", "2024-12-18T15:06:55.000000Z"),
        ("2024-04-16T06:54:55+05:30", "ny.test", "2024-04-16T01:24:55.000000Z"),
        ("2024-04-16T06:54:55-05", "ny.test", "2024-04-16T11:54:55.000000Z"),
        ("2025-08-21T21:57:54.553419836Z", "ny.test", "2025-08-21T21:57:54.553419Z"),
        ("2024-07-04", "ny.test", "2024-07-04T04:00:00.000000Z"),
        ("20240710", "in.test", "2024-07-09T18:30:00.000000Z"),
        ("20231225T130901Z", "ny.test", "2023-12-25T13:09:01.000000Z"),
        ("1712460707", "ny.test", "2024-04-07T03:31:47.000000Z"),
        ("1705173896514", "ny.test", "2024-01-13T19:24:56.514000Z"),
        ("1705173896514123", "ny.test", "2024-01-13T19:24:56.514123Z"),
        ("Fri, 05 Jan 2024 06:31:35 +0900", "ny.test", "2024-01-04T21:31:35.000000Z"),
        ("05 Mar 2025 21:06:24 GMT", "ny.test", "2025-03-05T21:06:24.000000Z"),
        ("18 November 2021", "ln.test", "2021-11-18T00:00:00.000000Z"),
        ("May 31, 2021", "ln.test", "2021-05-30T23:00:00.000000Z"),
        ("Oct 15, 2021 7:16 AM EDT", "ny.test", "2021-10-15T11:16:00.000000Z"),
        ("Oct 15, 2021 12:16 AM IST", "in.test", "2021-10-14T18:46:00.000000Z"),
        ("Oct 15, 2021 12:16 PM BST", "ln.test", "2021-10-15T11:16:00.000000Z"),
        ("03/04/2024 10:00", "ny.test", "2024-03-04T15:00:00.000000Z"),
        ("03/04/2024 10:00", "ln.test", "2024-04-03T09:00:00.000000Z"),
    ]
    assert read(spark, [(v, d) for v, d, _ in cases]) == [u for _, _, u in cases]


def test_clock_changes(spark):
    # repeated hour: first pass; skipped hour: moved on by the gap
    assert read(spark, [("2024-11-03 01:30:00", "ny.test"), ("2024-03-10 02:30:00", "ny.test"), ("2024-10-27T01:30", "ln.test"), ("2024-03-31T01:30", "ln.test")]) == [
        "2024-11-03T05:30:00.000000Z", "2024-03-10T07:30:00.000000Z", "2024-10-27T00:30:00.000000Z", "2024-03-31T01:30:00.000000Z",
    ]


def test_unreadable(spark):
    bad = ["", " ", "yesterday", "last Tuesday", "3 hours ago", "TBA", "-", "0000-00-00", "31/31/2024", "2024-02-30", "2024-01-01T25:00:00Z", "25/12/2024 10:00", "Oct 15, 2021 7:16 AM XXT", "x\ny", "\u0001i|2024", None, "9" * 5000]
    assert read(spark, [(v, "ny.test") for v in bad]) == [None] * len(bad)


def test_undeclared_order_is_chosen_by_the_chain(spark):
    # 25/03 says day first; the ambiguous neighbours follow it rather than jump back in time
    assert read(spark, [("25/03/2024 10:00", "free.test"), ("04/05/2024 10:00", "free.test"), ("06/05/2024 10:00", "free.test")]) == [
        "2024-03-25T10:00:00.000000Z", "2024-05-04T10:00:00.000000Z", "2024-05-06T10:00:00.000000Z",
    ]


def test_viterbi_equals_brute_force():
    def cost(us, order, picked, costs):
        total, conv, last = 0.0, 0, None
        for u, o, c, k in zip(us, order, costs, picked):
            total += c[k]
            if o[k] and conv and o[k] != conv:
                total += moments.SWITCH
            conv = o[k] or conv
            if last is not None and u[k] < last:
                total += min(moments.BACK_MOST, (last - u[k]) / ts.DAY_US * moments.BACK_DAY)
            last = u[k]
        return total

    d = ts.DAY_US
    us = [[10 * d, 300 * d], [20 * d], [40 * d, 5 * d], [41 * d, 200 * d], [30 * d]]
    order, costs = [[1, 2], [0], [1, 2], [2, 1], [0]], [[0.0, 0.0], [0.0], [0.0, 1.0], [0.0, 0.5], [0.0]]
    best = min(cost(us, order, p, costs) for p in itertools.product(*[range(len(u)) for u in us]))
    assert abs(cost(us, order, moments._viterbi(us, order, costs), costs) - best) < 1e-9


def _records(rng, n):
    d = ts.DAY_US
    us, order, cost = [], [], []
    for at in range(n):
        k = rng.choice([1, 1, 1, 2, 2, 4])
        us.append([(at + rng.randrange(-90, 90)) * d for _ in range(k)])
        order.append([1 + i % 2 for i in range(k)] if k > 1 else [rng.choice([0] * 5 + [1, 2])])
        cost.append([rng.choice([0.0, 0.0, 1.5]) for _ in range(k)])
    return us, order, cost


def _total(us, order, cost, picked):
    total, conv, last = 0.0, 0, None
    for u, o, c, k in zip(us, order, cost, picked):
        total += c[k] + (moments.SWITCH if o[k] and conv and o[k] != conv else 0.0)
        conv = o[k] or conv
        if last is not None and u[k] < last:
            total += min(moments.BACK_MOST, (last - u[k]) / ts.DAY_US * moments.BACK_DAY)
        last = u[k]
    return total


def test_blocks_put_together_are_the_whole_chain():
    import random

    rng = random.Random(4)
    for n, size in ((1, 1), (7, 3), (60, 1), (60, 7), (200, 50), (200, 300)):
        us, order, cost = _records(rng, n)
        parts = [slice(i, i + size) for i in range(0, n, size)]
        ends = moments._stitch([(us[p][0], moments._through(us[p], order[p], cost[p])) for p in parts])
        picked = [k for p, (conv, first, end) in zip(parts, ends) for k in moments._between(us[p], order[p], cost[p], conv, first, end)]
        assert abs(_total(us, order, cost, picked) - _total(us, order, cost, moments._viterbi(us, order, cost))) < 1e-9


def test_blocks_of_a_table_are_the_whole_chain(spark, monkeypatch):
    import random

    rng = random.Random(9)
    values = []
    for k in range(400):
        day, month = rng.randrange(1, 29), rng.randrange(1, 13)
        values.append((rng.choice([f"{month:02}/{day:02}/2024 10:00", f"2024-{month:02}-{day:02}T10:00:00Z", f"2024-{month:02}-{day:02}T10:00:00.000000Z"]), "free.test"))
    df = spark.createDataFrame([(i, v, d) for i, (v, d) in enumerate(values)], "ord_key long, value string, domain string").withColumn("fixed", F.col("value").rlike(ts.CANONICAL))
    many, sizes = [], (1 << 16, 16)
    for size in sizes:
        monkeypatch.setattr(moments, "BLOCK", size)
        many.append({r.ord_key: r.us for r in moments.resolve(df.repartition(5), sites(spark), source=["domain"], fixed="fixed").collect()})
    assert many[0] == many[1] and len(many[0]) == 400
    assert {k: u for k, u in many[0].items() if "T" in values[k][0]} == {r.ord_key: r.us for r in df.filter("value LIKE '%T%'").select("ord_key", F.unix_micros(F.to_timestamp("value")).alias("us")).collect()}


def test_one_crawl_is_one_chain(spark):
    import datetime as dt

    # month first throughout: one in ten dates can be read both ways, alone between entries that tell nothing
    seen, rows, want = dt.datetime(2024, 6, 1), [], {}
    for k in range(300):
        day, month = (k % 12 + 1, (k + 4) % 12 + 1) if k % 10 == 0 else (k % 15 + 13, k % 12 + 1)
        rows.append(("free.test", f"u{k}", f"{month:02}/{day:02}/2024 10:00", seen))
        want[f"u{k}"] = f"2024-{month:02}-{day:02}T10:00:00.000000Z"
    entries = spark.createDataFrame(rows, "domain string, url string, lastmod string, first_seen timestamp")
    urls = spark.createDataFrame([], "id long, domain string, pub_date string, discovered_at string")
    assert {r.row_key: r.utc for r in moments.found(urls, entries, sites(spark)).collect()} == want


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([], "ord_key long, value string, domain string")
    assert moments.resolve(df, sites(spark), source=["domain"]).count() == 0
    assert read(spark, [("2024-01-01", None), ("2024-01-01", "unknown.test")]) == ["2024-01-01T00:00:00.000000Z"] * 2


def test_found_leaves_out_canonical(spark):
    urls = spark.createDataFrame([(1, "u", "ny.test", "2024-01-01T00:00:00.000000Z", "2024-01-01T00:00:00", "x")] * 2, "id long, url string, domain string, pub_date string, discovered_at string, value string")
    entries = spark.createDataFrame([("ny.test", "u", "2024-01-02", None), ("ny.test", "u", "2024-01-03", None), ("ny.test", None, None, None)], "domain string, url string, lastmod string, first_seen timestamp")
    got = sorted(map(tuple, moments.found(urls, entries, sites(spark)).collect()))
    assert got == [("discovered_urls.discovered_at", "1", "2024-01-01T00:00:00.000000Z"), ("sitemap_entries.lastmod", "u", "2024-01-02T05:00:00.000000Z"), ("sitemap_entries.lastmod", "u", "2024-01-03T05:00:00.000000Z")]


def plain_reading(value, zone, order):
    """An independent reading of one value with the standard library."""
    import re
    from datetime import datetime, timedelta, timezone
    from zoneinfo import ZoneInfo

    v, z = value.strip(), ZoneInfo(zone)
    for f in ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M", "%Y-%m-%dT%H:%M:%S.%f", "%B %d, %Y", "%d %B %Y", "%Y%m%d", "%d/%m/%Y %H:%M" if order == "dmy" else "%m/%d/%Y %H:%M"):
        try:
            return datetime.strptime(v, f).replace(tzinfo=z).astimezone(timezone.utc)
        except ValueError:
            pass
    for f in ("%a, %d %b %Y %H:%M:%S %z", "%d %b %Y %H:%M:%S %z", "%Y-%m-%d %H:%M:%S%z"):
        try:
            return datetime.strptime(v.replace("GMT", "+0000"), f).astimezone(timezone.utc)
        except ValueError:
            pass
    if re.fullmatch(r"\d{10}|\d{13}", v):
        return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=int(v) * (1000 if len(v) == 10 else 1))
    if m := re.fullmatch(r"(\w{3} \d+, \d{4} \d+:\d+ [AP]M) ([A-Z]+)", v):
        t = datetime.strptime(m[1], "%b %d, %Y %I:%M %p")
        if m[2] in ("UTC", "GMT"):
            return t.replace(tzinfo=timezone.utc)
        for month in (1, 7):
            x = datetime(2022, month, 1, tzinfo=timezone.utc).astimezone(z)
            if x.tzname() == m[2]:
                return (t - x.utcoffset()).replace(tzinfo=timezone.utc)
    try:
        return datetime.fromisoformat(re.sub(r"(\.\d{6})\d+", r"\1", v.upper().replace(" UTC", "Z"))).astimezone(timezone.utc)
    except ValueError:
        return None


def test_whole_tables_against_an_independent_reading(spark, small):
    from millrace.sources.tables import table

    urls, entries, declared = (table(spark, small, n) for n in ("discovered_urls", "sitemap_entries", "sites"))
    got = {tuple(r) for r in moments.found(urls, entries, declared).collect()}
    known = {r.domain: (r.time_zone, r.date_order) for r in declared.collect()}
    import re

    want = set()
    for field, rows in (
        ("discovered_urls.pub_date", [(str(r.id), r.pub_date, known[r.domain]) for r in urls.collect()]),
        ("discovered_urls.discovered_at", [(str(r.id), r.discovered_at, ("UTC", known[r.domain][1])) for r in urls.collect()]),
        ("sitemap_entries.lastmod", [(r.url, r.lastmod, known[r.domain]) for r in entries.collect()]),
    ):
        for key, value, (zone, order) in rows:
            if value and not re.fullmatch(ts.CANONICAL, value) and (t := plain_reading(value, zone, order)):
                want.add((field, key, t.strftime("%Y-%m-%dT%H:%M:%S.%fZ")))
    assert got == want
