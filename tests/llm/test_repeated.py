import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import kernels as K
from millrace.llm import repeated

LINE = "This site stores small files on your device"


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, "id long, body_text string, source_domain string, chunk string, line int")
    return sorted(map(tuple, repeated.repeated_lines(df, **kw).collect()))


def test_counts_articles_of_one_source(spark):
    rows = [(i, f"own text number {'x' * i} here\r\n\n{LINE.upper() if i % 2 else LINE}!", "a", "z", 1) for i in range(5)]
    rows += [(10 + i, f"{LINE}\n{LINE}", "b", "z", 1) for i in range(4)]
    rows += [(20, None, "a", "z", 1), (21, "", "a", "z", 1), (22, LINE, None, "z", 1)]
    assert found(spark, rows) == [(i, 3) for i in range(5)]
    # repeated rows of an id count once
    assert found(spark, rows + rows[5:9]) == [(i, 3) for i in range(5)]


def test_short_lines_are_no_case(spark):
    assert found(spark, [(i, "read more: 12\nabcdefghijk\nabcdefghijkl", "a", "", 0) for i in range(6)]) == [(i, 3) for i in range(6)]


def test_empty(spark):
    assert found(spark, []) == []


def test_very_long_line(spark):
    long = "word " * 60_000
    assert found(spark, [(i, f"{long}\nend of {'y' * 20}{'z' * i}", "a", "", 0) for i in range(5)]) == [(i, 1) for i in range(5)]


def test_other_alphabets(spark):
    assert found(spark, [(i, f"isn{q}t über die Straße\n{'q' * (20 + i)}", "a", "", 0) for i, q in enumerate("'’'’'")]) == [(i, 1) for i in range(5)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abcdeé’ \nXYZ.9", max_size=400), min_size=1, max_size=6))
def test_lines_and_chunks_cover_all(texts):
    got = repeated.cut(texts)
    want, lengths = set(), {}
    for d, t in enumerate(texts):
        lengths[d] = sum(c.isalpha() for c in t.lower())
        for n, line in enumerate(t.split("\n"), 1):
            letters = "".join(c for c in line.lower() if c.isalpha())
            if len(letters) >= repeated.LETTERS:
                want.add((d, n, len(letters)))
    assert {(int(a), int(b), int(c)) for a, b, c in zip(got["doc"], got["line_no"], got["letters"]) if b} == want
    for d, n in lengths.items():  # chunks cover every letter once
        assert got["size"][got["doc"] == d].sum() == n
    by_line = {}
    for d, n, h in zip(got["doc"], got["line_no"], got["line"]):
        if n:
            by_line.setdefault(("".join(c for c in texts[d].split("\n")[n - 1].lower() if c.isalpha())), set()).add(int(h))
    assert all(len(h) == 1 for h in by_line.values()) and len({next(iter(h)) for h in by_line.values()}) == len(by_line)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcdeéß’ \nXYZ.9", max_size=400), max_size=5), st.text(alphabet="abé", min_size=12, max_size=300))
def test_every_line_has_chunks_that_its_letters_alone_determine(texts, line):
    for same in (line, "a" * len(line)):
        got = repeated.cut([*texts, *(f"{t}\n{same.upper()}!\n{t}" for t in texts), same])
        own = {}
        for d, n, h, parts, chunk in zip(got["doc"], got["line_no"], got["line"], got["parts"], got["chunk"]):
            if n:
                own.setdefault((int(h), int(parts)), {}).setdefault((int(d), int(n)), []).append(int(chunk))
        assert len({h for h, _ in own}) == len(own)
        for (_, parts), lines in own.items():
            assert {len(c) for c in lines.values()} == {parts} and len({tuple(sorted(c)) for c in lines.values()}) == 1
        pairs = list(zip(got["doc"][got["first"]].tolist(), got["chunk"][got["first"]].tolist()))
        assert len(pairs) == len(set(pairs)) and set(pairs) == set(zip(got["doc"].tolist(), got["chunk"].tolist()))


def test_lines_come_in_by_their_chunks_alone(spark, monkeypatch):
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 8))
    line = lambda n: " ".join(word() for _ in range(n))
    often, seldom = [line(n) for n in (2, 5, 12, 60)], [line(n) for n in (2, 5, 12, 60)]
    rows = [(i, "\n".join([*often, *(seldom if i < 4 else []), *(line(n) for n in (2, 5, 12, 60))]), "a") for i in range(6)]
    df = spark.createDataFrame(rows, "id long, body_text string, source_domain string")
    want = [(i, k) for i in range(6) for k in range(1, 5)]
    whole = repeated.chunk_rows(df, "id", "body_text", "source_domain")
    assert sorted(map(tuple, repeated.repeated_lines(df).collect())) == want
    # were no two chunks alike, no line would come in, short or long
    monkeypatch.setattr(repeated, "chunk_rows", lambda *_: whole.withColumn("chunk", F.monotonically_increasing_id()))
    assert repeated.repeated_lines(df).count() == 0
    assert sorted(map(tuple, repeated.candidates(whole).select("id", "line_no").distinct().collect())) == want


def test_a_notice_wrapped_otherwise_is_found(spark):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 8))
    notice = [word() for _ in range(300)]
    rows = []
    for i in range(6):
        at = list(range(7 + 3 * i, 300, 11 + i))
        wrapped = " ".join(w + ("\n" if k in at else "") for k, w in enumerate(notice))
        rows.append((i, " ".join(word() for _ in range(100)) + "\n" + wrapped, "a"))
    rows.append((9, " ".join(word() for _ in range(200)), "a"))
    df = spark.createDataFrame(rows, "id long, body_text string, source_domain string")
    assert repeated.repeated_lines(df).count() == 0  # no line is the same
    share = {r.id: r.repeated / r.letters for r in repeated.stretches(df).collect()}
    assert all(0.55 < share[i] < 0.8 for i in range(6)) and share[9] == 0
    assert {r.repeated for r in repeated.stretches(df.unionByName(df.filter("id = 9"))).filter("id = 9").collect()} == {0}


def test_chunks_are_content_defined():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefgh"), 7)) for _ in range(600)]
    a, b = " ".join(words), " ".join(["changed", "start", *words])
    x, y = (set(repeated.cut([t])["chunk"].tolist()) for t in (a, b))
    assert len(x) > 10 and len(x & y) >= len(x) - 2


def test_clean_bodies(spark):
    rows = [(i, f"keep {i}\n{LINE}\nkeep too", "a", "", 0) for i in range(5)] + [(9, None, "a", "", 0), (8, "alone", "a", "", 0)]
    df = spark.createDataFrame(rows, "id long, body_text string, source_domain string, chunk string, line int")
    got = dict(map(tuple, repeated.clean_bodies(df, repeated.repeated_lines(df)).collect()))
    assert got[0] == "keep 0\nkeep too" and got[9] is None and got[8] == "alone"


def test_simhash_of_equal_and_near_texts():
    a = "one two three four five six seven eight nine ten " * 30
    sims, counts, whole = (K.prints([a, a.upper(), a + "eleven", "", "two words"], 5, 0.8)[k] for k in ("sim", "n_words", "text"))
    assert sims[0] == sims[1] and whole[0] == whole[1] and whole[0] != whole[2]
    assert bin((int(sims[0]) ^ int(sims[2])) & (2**64 - 1)).count("1") < 20 and list(counts) == [300, 300, 301, 0, 2]


def test_shared_shingles():
    a = "a b c d e f g h i j"
    assert K.shared_shingles(a, a, 5) == 1.0 and K.shared_shingles(a, "x y z", 5) == 0.0 and K.shared_shingles("", "", 5) == 1.0
    assert abs(K.shared_shingles(a, a + " k", 5) - 6 / 7) < 1e-9
