import pytest
from hypothesis import given
from hypothesis import strategies as st

from millrace.functions import matching, urls
from millrace.operators import preselect
from pyspark.sql import functions as F

CASES = [
    ("https://h.test/2024/acme-widgets-rise", None, "Acme Widgets Inc.", "ACMW", "accept", "name"),
    ("https://h.test/a", "Facebook pays", "Meta Platforms", "META", "accept", "alias"),
    ("https://h.test/a", "Deal (NYSE: ZQX)", "Zeta Quux", "ZQX", "accept", "explicit_ticker"),
    ("https://h.test/a", "NASDAQ: BRK.C rises", "Zeta Quux", "BRK.C", "accept", "explicit_ticker"),
    ("https://h.test/a", "Buy $ON now", "Zeta Quux", "ON", "review", "cashtag"),
    ("https://h.test/a", "ZQX cuts jobs", "Zeta Quux", "ZQX", "accept", "upper_ticker"),
    ("https://h.test/zqx-update", None, "Zeta Quux", "ZQX", "review", "weak_ticker"),
    ("https://h.test/acme-shares", None, "Acme Widgets Inc.", "ACMW", "review", "weak_first_word"),
    ("https://h.test/global-corp-q3", None, "Global Corp", "GLB", "review", "loose_name"),
    ("https://h.test/acme-widgetss-ceo", None, "Acme Widgets Inc.", "ACMW", "review", "loose_name"),
    ("https://h.test/drink-sales", None, "DrinkCo", "DRK", "review", "loose_name"),
    ("https://h.test/a", "Country PM speaks", "Zeta Quux", "PM", "review", "abbreviation"),
    ("https://acme-widgets.test/a", "nothing here", "Acme Widgets Inc.", "ACMW", "reject", "none"),
    ("https://h.test/a?q=acme-widgets", None, "Acme Widgets Inc.", "ACMW", "accept", "name"),
    ("https://h.test/best-buys-for-spring", None, "Best Buy", "BBY", "reject", "none"),
    (None, None, "Acme Widgets Inc.", "ACMW", "reject", "none"),
]


def test_rule(spark):
    df = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(CASES)], "i int, url string, title string, company string, ticker string")
    got = matching.classified(matching.company_columns(matching.text_columns(df))).orderBy("i").collect()
    assert [(r.match_class, r.match_reason) for r in got] == [c[4:] for c in CASES]


def test_preselect_equals_full_scan(spark, small):
    from millrace import queries

    entries, firms = queries._entries(spark, small), queries._companies(spark, small).limit(150)
    extra = spark.createDataFrame([(u or "", t, u or f"n{i}") for i, (u, t, *_) in enumerate(CASES)], "url string, title string, entry_id string")
    firms = firms.unionByName(spark.createDataFrame([(c[3], c[2]) for c in CASES], "ticker string, company string")).dropDuplicates(["ticker", "company"]).cache()
    entries = entries.unionByName(extra).dropDuplicates(["entry_id"]).cache()
    a = sorted(map(str, preselect.matches(entries, firms).collect()))
    assert a == sorted(map(str, preselect.full_scan(entries, firms).select("entry_id", "ticker", "company", "match_class", "match_reason").collect())) and len(a) > 20


def test_preselect_of_nothing(spark):
    none = spark.createDataFrame([], "url string, title string, entry_id string")
    assert preselect.matches(none, spark.createDataFrame([("A", "Acme Widgets")], "ticker string, company string")).count() == 0


URLS = [
    ("HTTPS://WWW.Site.TEST/a/b/?utm_source=x&b=2&a=1&a=0#frag", "https://www.site.test/a/b?a=1&a=0&b=2", "site.test", True),
    ("https://h.test", "https://h.test/", "h.test", True),
    ("https://h.test:8080/x//", "https://h.test:8080/x", "h.test", True),
    ("https://h.test/p;v=1?empty=&k=a+b%21", "https://h.test/p?k=a+b%21", "h.test", True),
    ("ftp://h.test/x", "ftp://h.test/x", "h.test", False),
]


def test_urls(spark):
    df = spark.createDataFrame([(u[0],) for u in URLS] + [(None,)], "u string")
    c = F.col("u")
    got = df.select(urls.normalize(c), urls.host(c), urls.is_http(c)).collect()
    assert [tuple(r) for r in got[:-1]] == [u[1:] for u in URLS]
    assert tuple(got[-1]) == (None, None, None)


@pytest.fixture(scope="module")
def normal(spark):
    def run(texts):
        df = spark.createDataFrame([(t,) for t in texts], "u string")
        once = df.select(urls.normalize(F.col("u")).alias("u"))
        return once.select("u", urls.normalize(F.col("u")).alias("v")).collect()

    return run


def test_normalise_twice_is_once(normal):
    texts = []
    part = st.text(alphabet="abcXYZ019-_.~*!%/&=?#;+ ", max_size=25)

    @given(part)
    def gather(t):
        texts.append("https://H.test/" + t)

    gather()
    assert [(r.u, r.v) for r in normal(texts) if r.u != r.v] == []


def test_article_addresses(spark):
    rows = [("https://www.cnbc.com/2024/01/02/a-b.html", True), ("https://www.cnbc.com/2024/01/02/a-b.html?x", False), ("https://finance.yahoo.com/news/x-1?y", True), ("https://h.test/a", None)]
    got = spark.createDataFrame(rows, "u string, w boolean").select(urls.is_article(F.col("u")).alias("g"), "w").collect()
    assert all(r.g == r.w for r in got)
