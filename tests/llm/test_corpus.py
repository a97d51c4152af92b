import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import leakage, packing, reading


def table(spark, name, small):
    from millrace.sources.tables import table as t

    return t(spark, small, name)


def leaks(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string, words int, item_id string")
    i = spark.createDataFrame(items, "item_id long, item_text string")
    return sorted(map(tuple, leakage.found(d, i).collect()))


WORDS = [f"w{k}" for k in range(40)]
ITEM = " ".join(WORDS)


def test_thirteen_words_leak_and_twelve_do_not(spark):
    docs = [(k, "x " + " ".join(WORDS[k : k + 13]) + " y", 0, "") for k in range(28)] + [(100 + k, "x " + " ".join(WORDS[k : k + 12]) + " y", 0, "") for k in range(28)]
    assert leaks(spark, docs, [(1, ITEM)]) == [(k, 1) for k in range(28)]


def test_not_letter_by_letter(spark):
    text = "Intro. W0, w1 (w2); “w3” w-4\tw5\nw6 w7... W8! w9: w10 w11, w12?"
    assert leaks(spark, [(1, text, 0, ""), (1, text, 0, ""), (2, None, 0, ""), (3, "", 0, "")], [(1, ITEM), (2, ITEM), (3, "too short"), (4, None)]) == [(1, 1), (1, 2)]
    assert leaks(spark, [], [(1, ITEM)]) == [] and leaks(spark, [(1, ITEM, 0, "")], []) == []


def test_more_items_than_one_automaton_holds(spark, monkeypatch):
    monkeypatch.setattr(leakage, "MOST_CHARS", 200)
    items = [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(12)]
    docs = [(i, "before " + t + " after", 0, "") for i, t in items]
    assert leaks(spark, docs, items) == [(i, i) for i in range(12)]


def test_offsets_lead_back_to_the_text(spark):
    text = "Before.  " + ITEM.upper().replace(" ", ",  ") + " - after"
    r = leakage.passages(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(9, ITEM)], "item_id long, item_text string")).first()
    assert leakage.normal_words(text[r.start : r.stop]) == WORDS and r.words == 40


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_scan_equals_brute_force(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choices("abc", k=rng.randrange(5, 60)))) for i in range(4)]
    text = " ".join(rng.choices("abc", k=30)) + " " + " ".join(items[0][1].split()[3:30])
    w = leakage.normal_words(text)
    runs = {tuple(w[k : k + 13]) for k in range(len(w) - 12)}
    want = {i for i, t in items if any(tuple(t.split()[k : k + 13]) in runs for k in range(len(t.split()) - 12))}
    assert {i for i, _, _ in leakage.Automaton(items).scan(text)} == want


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25), st.integers(10, 60))
def test_plan_places_every_item_once(histogram, capacity):
    histogram = {n: c for n, c in histogram.items() if n <= capacity}
    groups, _ = packing.plan(histogram, capacity)
    used = {}
    for g in groups:
        assert g.repeats > 0 and sum(n * m for n, m in g.lengths.items()) == capacity - g.room and g.room >= 0
        for n, m in g.lengths.items():
            used[n] = used.get(n, 0) + m * g.repeats
    assert used == histogram
    bins = []  # first fit, largest first
    for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        k = next((k for k, room in enumerate(bins) if room >= n), None)
        if k is None:
            bins.append(capacity - n)
        else:
            bins[k] -= n
    assert sum(g.repeats for g in groups) <= 1.15 * len(bins) + 1


def test_fitted_patterns_fill_a_smooth_histogram():
    rng = np.random.default_rng(3)
    sizes, counts = np.unique(np.clip(rng.lognormal(5.2, 0.7, 60_000).astype(int), 1, 512), return_counts=True)
    histogram = dict(zip(sizes.tolist(), counts.tolist()))
    groups, fitted = packing.plan(histogram, 512)
    bound = -(-sum(n * c for n, c in histogram.items()) // 512)
    assert fitted and sum(g.repeats for g in groups) <= 1.001 * bound


def test_fit_is_non_negative_least_squares():
    patterns = [(2, 3), (1, 4), (1, 1, 3)]
    counts = np.array([0, 30.0, 20.0, 25.0, 10.0, 0])
    x = packing.fit_repeats(counts, patterns, 500, 0.0)
    a = np.array([[sum(u == k for u in p) for p in patterns] for k in range(6)], float)
    slope = a.T @ (a @ x - counts)
    assert (x >= 0).all() and (slope >= -1.0).all() and np.abs(slope[x > 1e-6]).max() < 1.0


def packed(spark, sizes, caps, blocks=None):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id long, n_tokens int")
    targets = spark.createDataFrame(list(enumerate(caps, 1)), "target_id int, capacity_tokens int")
    return packing.pack(counts, targets).toPandas()


def test_pack(spark, monkeypatch):
    rng = random.Random(2)
    sizes = [0, 0, 10, 100, 101, 350, 5] + [rng.randrange(1, 90) for _ in range(500)] + [40] * 300
    for most in (packing.RANK_ROWS, 100):
        monkeypatch.setattr(packing, "RANK_ROWS", most)
        got = packed(spark, sizes, [100, 64])
        for target, cap in ((1, 100), (2, 64)):
            own = got[got.target_id == target]
            assert (own.groupby("container").tokens.sum() <= cap).all()
            whole = own.groupby("doc_id").tokens.sum()
            assert [int(whole[i]) for i in range(len(sizes))] == sizes
            assert (own.groupby("doc_id").size() == [max(1, -(-n // cap)) for n in sizes]).all()
            used = own[own.tokens > 0].container
            large = (2 * own.tokens > cap).sum()  # no two of these share a container
            assert used.nunique() == used.max() + 1 and used.nunique() <= 1.12 * max(-(-sum(sizes) // cap), large) + 1


def test_pack_nothing(spark):
    assert len(packed(spark, [], [100])) == 0 and len(packed(spark, [0, 0], [100])) == 2
    with_none = spark.createDataFrame([(1, None), (1, None)], "doc_id long, text string")
    assert [r.n_tokens for r in packing.token_counts(with_none).collect()] == [0, 0]


def test_pack_documents_of_all_sizes(spark, small):
    docs, targets = table(spark, "documents", small), table(spark, "pack_targets", small)
    got = packing.pack(packing.token_counts(docs), targets)
    caps = {r.target_id: r.capacity_tokens for r in targets.collect()}
    over = got.groupBy("target_id", "container").agg(F.sum("tokens").alias("n")).collect()
    assert all(r.n <= caps[r.target_id] for r in over)
    assert got.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def graded(spark, seed=1):
    rng = random.Random(seed)
    vocabulary = {g: [f"{'abcde'[g - 1] * 2}{w}" + "x" * g for w in range(30)] for g in range(1, 6)}
    docs, grades = [], []
    for i in range(600):
        g = rng.randrange(1, 6)
        docs.append((i, " ".join(f"The {rng.choice(vocabulary[g])} of the {rng.choice(vocabulary[g])} was in {rng.choice(vocabulary[g])}." for _ in range(8)), g))
        if i % 4 == 0:
            grades.append((i, "r", min(5, max(1, g + (rng.random() < 0.05)))))
    return docs, grades


def level_of(spark, docs, grades):
    d = spark.createDataFrame([(i, t) for i, t, *_ in docs], "doc_id long, text string")
    return d, spark.createDataFrame(grades, "doc_id long, rater string, grade_level int")


def test_levels_of_held_out_documents(spark):
    docs, grades = graded(spark)
    d, labels = level_of(spark, docs, grades)
    got = {r.doc_id: r.level for r in reading.levels(d, labels).collect()}
    held = [(i, g) for i, _, g in docs if i % 4]
    assert sum(got[i] == g for i, g in held) / len(held) > 0.93


def test_words_apart_give_the_levels_of_buckets(spark):
    docs, grades = graded(spark)
    d, labels = level_of(spark, [*docs, (9001, ""), (9002, None)], grades)
    one, other = ({r.doc_id: r.level for r in reading.levels(d, labels, every=True, exact=x).collect()} for x in (False, True))
    assert set(one) == set(other) and sum(one[i] == other[i] for i in one) >= 0.99 * len(one) and other[9001] == other[9002] == 1


def test_levels_leave_out_other_languages_and_blanks(spark):
    docs, grades = graded(spark)
    extra = [(9001, None), (9002, ""), (9003, "ABC 12"), (9004, "Der Konzern meldete den Ausbau der Anlage und die Bank verschob das Werk im Quartal."), (9005, docs[1][1]), (9005, docs[1][1])]
    d, labels = level_of(spark, docs + extra, [*grades, (9004, "r", 5), (None, "r", 1), (77777, "r", 3), (9005, "r", None)])
    got = {r.doc_id: r.level for r in reading.levels(d, labels).collect()}
    assert not {9001, 9002, 9003, 9004} & set(got) and got[9005] == got[1]


def test_every_document_has_a_level(spark, tmp_path):
    from millrace.llm.queries import queries

    docs, grades = graded(spark)
    extra = [(9001, None), (9002, ""), (9003, "ABC 12"), (9004, "Der Konzern meldete den Ausbau der Anlage und die Bank verschob das Werk im Quartal.")]
    d, labels = level_of(spark, docs + extra, [*grades, (9004, "r", 5)])
    d.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/reading_labels.parquet")
    got = {r.doc_id: r.level for r in queries()["p10_levels"](spark, str(tmp_path)).collect()}
    assert set(got) == {i for i, *_ in docs + extra} and set(got.values()) <= {1, 2, 3, 4, 5} and got[9001] == got[9002] == 1
    assert {i: n for i, n in got.items() if i < 9000} == {r.doc_id: r.level for r in reading.levels(d, labels).collect()}
    assert not {9001, 9002, 9003, 9004} & {r.doc_id for r in reading.found(d, labels).collect()}


def test_no_grades_no_levels(spark):
    docs, _ = graded(spark)
    d, labels = level_of(spark, docs[:5], [])
    assert reading.levels(d, labels).count() == 0 and reading.found(d, labels).count() == 0


@pytest.mark.parametrize("name", ["p1_clean_bodies", "p1_found", "p5_word_counts", "p9_found"])
def test_query_equals_sql(spark, small, name):
    from sqlcheck import assert_same, connect

    from millrace.llm.queries import oracle_sql, queries

    assert_same(spark, connect(small), small, queries()[name], oracle_sql()[name])
