import pytest

from millrace.llm import lines as L
from millrace.llm import mainbody, quality, residue

SITE = "dailyledger"
HEADS = L.learn_headlines([(f"{a} {b} split over {c} prices", 1) for a in ("Acme", "Zeta", "Quux") for b in ("Mining", "Foods") for c in ("lower", "higher")])

RESIDUE = [
    "{{ article.headline }}\n{{ body_html }}", "Dear [INSERT FIRST NAME], hello.", "Shares of {company_name} ended the day {direction}.", "<%= author.full_name %>", "#{body_html}", "__article.headline__", "[[body_html]]", "${user.name} wrote",
    "TKTK", "TK: add quote here.", "Text to come, prices steady.", "Sales rose undefined% to NaN in May, while costs fell null%.", "Traceback: KeyError 'x' while rendering block 3", "Lorem ipsum dolor sit amet",
    "404\nSorry, Dailyledger could not find the page you asked for.", "Internal server error\nThe server was unable to complete your request.", "Gateway time-out", "Please enable JavaScript to read Dailyledger.",
    "Dailyledger needs scripts to be switched on.\nYour browser blocks them, so nothing can be shown here.", "HTTP status: 410 Gone", "OOPS! SOMETHING BROKE ON DAILYLEDGER.",
    "Fertu velum loquan obrim korvet feril mandro dictun gravim ebrit inarto sotur fertu gravim ebrit fertu proxun.",
]
PROSE = [
    "Customers of Acme Health saw an error page when the upgrades went live in Mardev, operations head Ann Lee noted.", "Acme sells JavaScript tooling to filings in Mardev and must enable partners before May.",
    "Acme groups its units as {North, South, Coast} and said each has costs of $300 million.", "Subscribe to continue with this report on prices.", "The filing leaves the price blank until May, which the chair called a template for loans.", "", " ",
    "Revenue rose 40.4% to 404 million, and the server business of Acme was unable to match it.", "Her score of 5 [out of 10] was the best of the day, and 50 people saw it.",
]


@pytest.mark.parametrize("body", RESIDUE)
def test_residue(body):
    assert residue.residue_kind(body, SITE)
    assert residue.residue_kind("The council met on Monday to vote on the plan, and the vote was close.\n" + body, SITE)


@pytest.mark.parametrize("body", PROSE)
def test_no_residue(body):
    assert residue.residue_kind(body, SITE) == ""


def articles(spark, rows):
    return spark.createDataFrame([(i, b, "dailyledger.test", w, "t", "x", "y") for i, b, w in rows], "id long, body_text string, source_domain string, word_count int, title string, kind string, line_no string")


def test_label_spreads_to_near_copies_of_whole_pages(spark):
    page = "Dailyledger needs scripts to be switched on. " + " ".join(f"{{{{ field_{k} }}}}" for k in range(60))
    near = page.replace("{{ field_30 }}", "field")
    unlike = "The council met on Monday to vote on the plan, and the vote was close in the end after all."
    holds = unlike + "\n{{ body_html }}"
    rows = [(1, page, 1), (2, near, 1), (3, unlike, 1), (4, holds, 1), (5, None, 1), (6, "", 1), (7, page, 1), (7, page, 1)]
    assert sorted(r.id for r in residue.found(articles(spark, rows)).collect()) == [1, 2, 4, 7]
    assert residue.found(articles(spark, [])).count() == 0


def test_label_reaches_every_text_at_the_required_similarity(spark):
    import random

    from millrace.llm import kernels as K

    rng = random.Random(7)
    # whole pages of placeholders, and copies of them that the wording no longer shows, with 0.8 to 0.9 of the shingles
    rows, near = [], []
    for f in range(40):
        letters = lambda n: "".join(chr(97 + int(c)) for c in str(n))
        names = [f"f{letters(f)}x{letters(k)}" for k in range(300)]
        page = " ".join(f"{{{{ {n} }}}}" for n in names)
        words = names[:]
        for k in rng.sample(range(5, 295), 3 + f % 7):
            words[k] = f"other{letters(f)}x{letters(k)}"
        copy = " ".join(words)
        rows += [(2 * f, page, 1), (2 * f + 1, copy, 1)]
        near.append(K.shared_shingles(page, copy, residue.SHINGLE, False))
    want = {2 * f for f in range(40)} | {2 * f + 1 for f in range(40) if near[f] >= residue.SIMILAR}
    assert 0.8 > min(near) and sum(0.8 <= x < 0.9 for x in near) > 15
    assert {r.id for r in residue.found(articles(spark, rows)).collect()} == want


def test_labels_run_through_components_and_sites(spark):
    # server pages of other sites, other figures, worded a little otherwise at each step: only the first has wording of the list
    first = "Gateway time-out\nThe upstream host of {s} serves this page.\nIt has not given an answer for {n} seconds.\nPlease come back to us later today to read the story.\nOur staff are at work on the fault that we found.\nYou can call the desk of {s} at any hour of the day.\nAll of your saved stories are still where you left them."
    steps = [first, first.replace("Gateway time-out", "Gateway gave up"), first.replace("Gateway time-out", "Portal gave up") + "!\nThank you all"]
    rows = [(10 * k + j, t.format(s=site.title(), n=30 + k), f"{site}.test") for j, t in enumerate(steps) for k, site in enumerate(["dailyledger", "cityherald", "portbrief"])]
    story = "The council met on Monday to vote on the plan for the gateway, and the host of the site did not answer within a day so the readers will come back later."
    a = spark.createDataFrame([*rows, (99, story, "dailyledger.test")], "id long, body_text string, source_domain string")
    assert [bool(residue.residue_kind(t.format(s="x", n=1))) for t in steps] == [True, False, False]
    kinds = {r.id: r.by for r in residue.excluded(residue.labels(a), a).collect()}
    assert kinds == {i: "wording" if i % 10 == 0 else "link" for i, _, _ in rows}


@pytest.mark.parametrize("body", ["Traceback of the money led police to the bank.", "The form asks for [your name] and [your date of birth], lawyers said."])
def test_reports_are_no_residue(body):
    assert residue.residue_kind(body, SITE) == ""


@pytest.mark.parametrize(
    "body",
    ["The requested URL was not found on this server.", "You must have JS turned on to view the story.", "We are performing maintenance. Check back soon.", "Error code: ERR_CONNECTION_RESET", "PHP Warning: include(): failed opening",
     "@@TITLE@@ by @@AUTHOR@@", "<#if user>Hello</#if>", "Your session has expired", "Please enable JavaScript " + "to go on reading, " * 20 + "thank you"],
)
def test_usual_residue_of_any_length(body):
    assert residue.residue_kind(body, SITE)


def test_tables_meet_pairs_at_the_required_similarity(spark):
    import random

    from millrace.llm import kernels as K

    rng = random.Random(11)
    texts = []
    for f in range(400):
        words = [f"w{chr(97 + f % 26)}{chr(97 + f // 26)}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(250)]
        copy = words[:]
        for k in rng.sample(range(5, 245), 5):
            copy[k] = "other" + copy[k]
        texts += [" ".join(words), " ".join(copy)]
    alike = [f for f in range(400) if K.shared_shingles(texts[2 * f], texts[2 * f + 1], residue.SHINGLE, False) >= residue.SIMILAR]
    rows = residue.labels(spark.createDataFrame([(i, t, "x.test") for i, t in enumerate(texts)], "id long, body_text string, source_domain string"))
    even = rows.filter("id % 2 = 0")
    odd = rows.filter("id % 2 = 1")
    want = {(2 * f + 1, 2 * f) for f in alike}
    near = {(r.a, r.b) for r in residue.table_pairs(odd, even).select("a", "b").distinct().collect()}
    assert len(want) > 200 and len(want & near) >= 0.9 * len(want)
    assert want <= {(r.a, r.b) for r in residue.least_pairs(odd, even).collect()}


def test_a_crowded_family_is_reached_as_a_whole(spark, monkeypatch):
    import random

    rng = random.Random(5)
    base = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
    rows = [(0, "Gateway time-out\n" + " ".join(base), "x.test")]
    for i in range(1, 300):  # each differs from the first in one or two words
        words = base[:]
        for k in rng.sample(range(120), rng.randrange(1, 3)):
            words[k] = f"other{chr(97 + i % 26)}{chr(97 + i // 26)}"
        rows.append((i, " ".join(words), "x.test"))
    a = spark.createDataFrame(rows, "id long, body_text string, source_domain string")
    for most in (residue.BROADCAST_TEXTS, 0):  # keys broadcast, and both sides shuffled
        monkeypatch.setattr(residue, "BROADCAST_TEXTS", most)
        monkeypatch.setattr(residue, "VERIFIED_PAIRS", most)
        assert residue.found(a).count() == 300


GRIDS = [
    "Date | Last\n" + "\n".join(f"2024-01-{d:02d} | {d}.5 | 10.25 | 99" for d in range(1, 20)), "\n".join(f"2024-01-{d:02d}\t{d}.5\t10.25" for d in range(1, 20)), "\n".join(f"* ABC{d} softer prices {d}" for d in range(12)),
    "Acme Corp., Zeta Foods, Quux, ABC, Mining Ltd., Health, Logistics, Energy, Bancorp, Materials, Networks.", "freight revenues payments private disputes staffing spreads contracts shorter delayed insurance longer record",
    "\n".join(["XvMylv57kgDpw/OAdL6dfeSRxS5QRly6MQl4irWbd6funwdNM3CAovUPaCTQ1F5f95pP"] * 6), "*>*\\/ /+>=.\\>^__ #./ /.<*-*-^*-_<=+ <=+\\~_+> -### :*_<", "au¢§ðÃ§ouÃŒÂ iiÂu€ŒØtâÂ¢tâÃ™a»âaŒØ™§™ŸâÂie€tee»™»€aÂßÂØŸ¶ßÂ§ðußŸ",
]
TEXTS = [
    "THE COUNCIL MET ON MONDAY TO VOTE ON THE PLAN, AND THE VOTE WAS CLOSE.", "- The council met on Monday to vote.\n- The mayor said that it was a good day for the town.\n- The plan is to start in May.",
    "Der Konzern meldete den Ausbau der Anlage nach langer Prüfung. Die Bank verschob weitere Zinsen im dritten Quartal.", "The council met on Monday to vote on the plan.\nLow\t1.5\nMid\t2.5\nHigh\t3.5\nThe mayor said that it was a good day for the town.", "", "ok",
]


@pytest.mark.parametrize("body", GRIDS)
def test_grids(body):
    assert not quality.is_prose(body)
    assert not quality.is_prose("Home | Markets | Sign in | Opinion\nMore from Dailyledger\n" + body + "\nNothing published by Dailyledger should be read as advice; see our house rules.")


@pytest.mark.parametrize("body", TEXTS)
def test_texts(body):
    assert quality.is_prose(body)


@pytest.mark.parametrize("mark", [" | ", "\t"])
def test_a_table_whose_rows_have_function_words_is_no_prose(mark):
    table = [("Cost of sales", "120", "98"), ("Interest on the loans to other companies in the group and its partners", "14", "9"), ("Profit before tax and before the items of the year", "31", "28"), ("Tax on profit", "8", "7")]
    assert not quality.is_prose("\n".join(mark.join(r) for r in table))
    story = "The council met on Monday to vote on the plan, and the vote was close in the end after all."
    assert quality.is_prose("\n".join([story + " " + story] * 8 + [mark.join(r) for r in table]))


def test_quality_cases(spark):
    rows = [(1, "two words", 2), (2, "two words", 3), (3, GRIDS[0], 1), (4, None, 5), (5, "x", None), (6, "", 0), (7, "", 1), (2, "two words", 3), (8, RESIDUE[0], 6)]
    a = articles(spark, rows)
    def cases(a):
        return quality.found(a, residue.labels(a, quality.reader, "prose boolean"), residue.found(a)).collect()

    assert sorted(map(tuple, cases(a))) == [(2, "word_count"), (3, "not_prose"), (3, "word_count"), (7, "word_count")]
    stats = {r.id: r for r in quality.text_statistics(a).collect()}
    assert stats[4].n_words is None and stats[6].n_words == 0 and stats[1].mean_word_length == 4.0 and stats[3].aligned > 0.9 and stats[3].stored_words == 1
    assert cases(articles(spark, [])) == []


def test_layout_decides_tables_that_words_and_ends_do_not():
    import random

    rng = random.Random(2)
    story = "The council met on Monday to vote on the plan. The mayor said that it was a good day for the town, and that the work is to start in May."
    labels = ["Cost of sales", "Interest on the loans to other companies", "Profit before tax and the items of the year", "Tax on the profit of the group", "Share of the result of its partners"]
    tables = ["\n".join(d.join([rng.choice(labels), str(rng.randrange(999)), f"{rng.random() * 99:.1f}"]) for _ in range(n)) for d in (" | ", "\t", "    ") for n in range(4, 24)]
    mixed = [story + "\n" + story + "\n" + "\n".join(f"Low{d}{rng.randrange(99)}" for _ in range(3)) for d in (" | ", "\t")]
    assert sum(not quality.is_prose(t) for t in tables) >= 0.95 * len(tables) and all(map(quality.is_prose, mixed))
    weights, constant = quality.fit([*tables[::2], *([story] * 9), *mixed], [False] * len(tables[::2]) + [True] * 11)
    score = lambda t: sum(w * v for w, v in zip(weights, quality.features(t))) + constant
    assert all(score(t) > 0 for t in tables[1::2]) and score(story) < 0


PAGE = """Home | Markets | Opinion | Sign in

Dailyledger stores small files on your device to measure visits. Accept all or manage.
By Ann Lee for Dailyledger
Reading time: 4 minutes
The council met on Monday to vote on the plan, and the mayor said that it was a good day for the town.
What the plan means for roads in Mardev
- The plan is to start in May, and the roads will be closed for a week.
Low | 1.5
Story continues below this Dailyledger message
Regulators asked the town to rewrite its cookie notice and privacy policy after the vote, a clerk said.
Subscribers to the newsletter of Acme read about the plan before the council did.
Related: Zeta Foods split over lower prices
Quux Mining split over lower prices (4 min read)
12 comments
Sign in
(c) 2024 Dailyledger Media. All rights kept."""
OTHER = [1, 3, 4, 5, 10, 13, 14, 15, 16, 17]


def test_main_lines():
    got = mainbody.main_lines(PAGE, SITE, HEADS)
    assert [n for n, m in enumerate(got, 1) if m is False] == OTHER and got[1] is None


def test_main_lines_in_capitals_and_with_line_ends():
    for page in (PAGE.upper(), PAGE.replace("\n", "\r\n"), PAGE.replace(" ", "  ")):
        assert [n for n, m in enumerate(mainbody.main_lines(page, SITE, HEADS), 1) if m is False] == OTHER


def test_text_and_tags_by_line():
    assert mainbody.page_lines("<p>a &amp; b</p>\nb\n<br/><span>x") == (["a & b", "b", "x"], {2: 1}, set())
    assert mainbody.page_lines("plain & simple\n< 5") == (["plain & simple", "< 5"], {}, set())
    assert mainbody.page_lines("<script>\nvar a = '<b>';\n</script>\nend") == (["", "", "", "end"], {0: 1, 2: 1}, set())
    long = "<a title='" + "x" * 10_000
    assert mainbody.page_lines(long + "\nafter <i>it</i>")[0][1] == "after it"  # a tag that is never closed is text, and what follows stays


STORY = "The council met on Monday to vote on the plan for the harbour, and the vote was close in the end after all."
HTML = f"""<html><head><title>Harbour vote</title><script>var x = 1;</script></head>
<nav><a href="/">Home</a> <a href="/b">Business</a> <a href="/s">Sport</a></nav>
<article><h1>Council votes on the harbour</h1>
<p>{STORY}</p>
<p>{STORY} {STORY}</p>
<aside>More of the day: <a href="/1">Council votes on the bridge</a> and <a href="/2">Mayor opens the school</a></aside>
<h2>What comes next</h2>
<p>{STORY}</p></article>
<div class="promo"><a href="/j">Our letter brings the best of the week to all of our readers</a></div>
<footer>The pages of this paper are made by the staff of the paper in the town</footer>"""


def test_markup_tells_furniture_that_no_list_has():
    got = mainbody.main_lines(HTML, SITE, HEADS)
    assert [n for n, m in enumerate(got, 1) if m] == [3, 4, 5, 7, 8]
    bare = [n for n in (9, 10) if not mainbody.main_lines(mainbody.page_lines(HTML)[0][n - 1], SITE, HEADS)[0]]
    assert bare == []  # the same lines without markup would pass for text


def test_a_long_line_outweighs_a_sign_of_furniture():
    notice = "We use cookies on your device to store your consent"
    assert mainbody.main_lines(notice, SITE, HEADS) == [False]
    assert mainbody.main_lines(STORY + " " + STORY + " The town said that the cookies on your device were not for sale. " + STORY * 2, SITE, HEADS) == [True]


def test_other_lines_of_table(spark):
    rows = [(1, PAGE, 1), (1, PAGE, 1), (2, None, 1), (3, "", 1), (4, GRIDS[0], 1), (5, RESIDUE[0], 1), (6, PAGE + "\nTKTK", 1)]
    a = articles(spark, rows)
    rows_read = residue.labels(a, mainbody.reader(HEADS), "other array<int>")
    assert sorted(map(tuple, mainbody.found(rows_read, residue.found(a)).collect())) == [(1, n) for n in OTHER]
    bodies = {r.id: r.main_text for r in mainbody.main_bodies(a, HEADS).collect()}
    assert bodies[2] is None and bodies[3] == "" and "Home" not in bodies[1] and bodies[1].count("\n") == 5


def test_headlines_of_all_titles(spark):
    # 40,000 titles: a shape needs 16 of them; half of the rare shapes have just that, half have one less
    rare = [(f"Acme wins {'and ' * k}again", 16 - k % 2) for k in range(1, 41)]
    titles = [t for t, c in rare for _ in range(c)]
    titles += ["Acme wins and again from Zeta"] * (40_000 - len(titles))
    rows = spark.createDataFrame(list(enumerate(titles)), "id long, title string")
    want = L.learn_headlines([(t, 1) for t in titles])
    got = L.headlines_of(rows)
    assert got == want and [got.fits(L.plain(t)) for t, _ in rare] == [c >= 16 for _, c in rare]


def test_headlines_of_a_bounded_sample(spark):
    a = articles(spark, [(i, "", 1) for i in range(50)])
    assert isinstance(L.headlines_of(a, most=10), L.Headlines)
    assert L.headlines_of(articles(spark, [])) == L.Headlines()


HOSTILE = ["<!-- " * 60_000, "<a " * 60_000, "{a " * 60_000, "[insert " * 40_000, "__a" * 80_000, "nan " * 80_000, "a\n" * 150_000, " " * 300_000, "x" * 500_000, "The mine sold the wood in May. " * 40_000, "<%" * 90_000, "\"'#* " * 60_000]


@pytest.mark.parametrize("body", HOSTILE, ids=range(len(HOSTILE)))
def test_long_and_hostile_bodies_take_little_time(body):
    import time

    began = time.perf_counter()
    residue.residue_kind(body, SITE)
    quality.statistics(body)
    mainbody.main_lines(body, SITE, HEADS)
    assert time.perf_counter() - began < 10
