import datetime as dt

from millrace.sources import pages

INDEX = "<sitemapindex xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'><sitemap><loc>b.xml</loc><lastmod>2024-05-01</lastmod></sitemap><sitemap><loc>old.xml</loc><lastmod>2019-01-01</lastmod></sitemap><sitemap><loc>a.xml</loc><lastmod>odd</lastmod></sitemap></sitemapindex>"
LEAF = "<urlset xmlns:n='x'><url><loc> https://h.test/1 </loc><lastmod>2024-03-02T10:00:00+02:00</lastmod><n:news><n:title>T</n:title></n:news></url><url><loc>https://h.test/2</loc></url><url><loc>https://h.test/3</loc><lastmod>2020-01-01</lastmod></url><url><lastmod>2024-01-01</lastmod></url></urlset>"


def test_sitemap_tree(spark):
    files = spark.createDataFrame([("a.xml", INDEX), ("b.xml", LEAF), ("old.xml", LEAF), ("bad.xml", "<x"), (None, None)], "path string, value string")
    got = sorted((r.loc, r.lastmod, r.title) for r in pages.crawl(["a.xml"], files, "2024-01-01", "2024-12-31").collect())
    assert got == [("https://h.test/1", dt.date(2024, 3, 2), "T"), ("https://h.test/2", None, None)]


def test_feed(spark):
    rss = "<rss><channel><item><title>A</title><link>u1</link><pubDate>x</pubDate></item><item><title>no link</title></item></channel></rss>"
    atom = "<feed xmlns='http://www.w3.org/2005/Atom'><entry><title>B</title><link href='u2'/><updated>y</updated></entry></feed>"
    got = sorted(tuple(r)[1:] for r in pages.feed(spark.createDataFrame([("p", rss), ("q", atom), ("r", None)], "path string, value string")).collect())
    assert got == [("u1", "x", "A"), ("u2", "y", "B")]


def test_archive_index(spark):
    text = '[["timestamp","original"],["20240102030405","u1"],["2024"],["bad","u2"]]'
    got = [tuple(r) for r in pages.archive_index(spark.createDataFrame([(text,), ("[]",), (None,), ("x",)], "value string")).collect()]
    assert got == [("u1", dt.date(2024, 1, 2)), ("u2", None)]


def test_tables_of_pages(spark):
    cells = "".join(f"<td>{c}</td>" for c in ("abc|", "Abc Inc", "S", "I", "HQ", "2020-01-01", "0001", "1990"))
    html = f"<table id='other'><tr><td>x</td></tr></table><table id='constituents'><tr><th>Symbol</th></tr><tr>{cells}</tr><tr><td>short</td></tr></table>"
    got = [tuple(r)[1:4] for r in pages.constituents(spark.createDataFrame([("p", html), ("q", None)], "path string, value string")).collect()]
    assert got == [("ABC", "Abc Inc", "S")]
    head = "<tr><th>a</th></tr><tr><th>b</th></tr>"
    log = "<table id='changes'>" + head + "<tr><td>March 5, 2024</td><td>new</td><td>New Inc</td><td></td><td></td></tr><tr><td>never</td><td>x</td><td></td><td></td><td></td></tr></table>"
    got = [(r.ordinal, r.effective_date, r.added_ticker, r.removed_ticker, r.reason) for r in pages.change_log(spark.createDataFrame([("p", log)], "path string, value string")).collect()]
    assert got == [(0, dt.date(2024, 3, 5), "NEW", "", "")]


def test_wiki_table():
    text = "{| class=x\n! Symbol !! Name\n|-\n| {{sym|AB}} || [[Abc Inc|Abc]]<ref>r</ref>\n|-\n| C || D || E\n|}"
    assert pages.wiki_table(text) == ([{"Symbol": "AB", "Name": "Abc"}], 1)
    assert pages.wiki_table(None) == ([], 0)


def test_companies_and_lines(spark):
    csv = spark.createDataFrame([("abc", " Abc ", "S"), ("", "x", ""), ("d", None, "")], "`Symbol` string, `Security` string, `GICS Sector` string")
    assert [tuple(r) for r in pages.companies(csv).collect()] == [("ABC", "Abc", "S")]
    lines = spark.createDataFrame([('["u","2024-01-01",null]',), ("x",), ("[]",)], "value string")
    assert [tuple(r) for r in pages.raw_entries(lines).collect()] == [("u", "2024-01-01", None)]


def test_messages_before_the_first_older(spark):
    rows = [("k", 1, dt.date(2024, 5, 2)), ("k", 2, dt.date(2024, 7, 1)), ("k", 3, dt.date(2023, 1, 1)), ("k", 4, dt.date(2024, 5, 3))]
    m = spark.createDataFrame(rows, "k string, i int, d date")
    assert [r.i for r in pages.before_first_older(m, "k", "i", "d", "2024-01-01", "2024-06-30").collect()] == [1]
