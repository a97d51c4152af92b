"""The readers of bodies leave out work that cannot change what they find."""

import random

import numpy as np
import pytest

from millrace.llm import kernels as K
from millrace.llm import lines as L
from millrace.llm import mainbody, quality, residue

STORY = "The council met on Monday to vote on the plan, and the vote was close. The mayor said that it was a good day for the town."
TABLE = "\n".join(f"{d} | Acme | {d}.5 | 10.25" for d in range(20))
HEADS = L.learn_headlines([(f"{a} {b} split over {c} prices", 1) for a in ("Acme", "Zeta", "Quux") for b in ("Mining", "Foods") for c in ("lower", "higher")])
PIECES = [
    "The council met on Monday.", "the", "and of", "Low\t1.5", "a | b | c", "By Ann Lee", "Acme Foods split over lower prices.", "“the plan”", "1) the plan", "* the plan", "x" * 29, "x" * 30, "y" * 41, "10.25 99", "naïve Σ ΑΣ İ", "§»", "\t", "    ", "\xa0", "\r", "\x1c", "\n", "\n", "\n\n",
    "dailyledger", "<b>a</b>", "<", "error", "KeyError: 'x'", "fatal error:", "ſyntaxError(", "tk", "{a_b}", "x{a}", "{ a }", "dear [x]", "Dear [x]", "dears [x]", "__a__", "x__a__", "___a__", "%a_b%", "5%", "@@@a@@", "#{a}", "[1]", "[insert x]", "$5", "<%= a %>", "404",
]


def bodies(n=3000):
    rng = random.Random(13)
    return ["".join(rng.choice(PIECES) + rng.choice(" \n ") for _ in range(rng.randrange(1, 25))) for _ in range(n)]


def score(body):
    return sum(w * v for w, v in zip(quality.WEIGHTS, quality.features(body))) + quality.CONSTANT


def test_lines_are_compared_only_where_that_can_turn_the_score(monkeypatch):
    seen, layout = [], quality.layout
    monkeypatch.setattr(quality, "layout", lambda rows: seen.append(rows) or layout(rows))
    assert quality.is_prose(STORY) and quality.is_prose("\n".join([STORY] * 5)) and not quality.is_prose("*>*\\/ /+>=.\\>^__ #./ /.<*-*-^*-_<=+ <=+\\~_+> -### :*_<")
    assert seen == []
    some = [b for b in [*bodies(), STORY, TABLE, STORY + "\n" + TABLE] if len("".join(b.split())) >= quality.LEAST]
    assert [quality.is_prose(b) for b in some] == [score(b) <= 0 for b in some]
    assert len({quality.is_prose(b) for b in some}) == 2


def test_stand_ins_are_looked_for_only_where_their_wording_is(monkeypatch):
    class Never:
        def search(self, body):
            raise AssertionError(body)

    want = [bool(residue._STAND_IN.search(b)) for b in bodies()]
    assert [residue.residue_kind(b) == "stand_in" for b in bodies() if not residue._PLACEHOLDER.search(b)] == [w for b, w in zip(bodies(), want) if not residue._PLACEHOLDER.search(b)]
    monkeypatch.setattr(residue, "_STAND_IN", Never())
    assert residue.residue_kind("Customers saw an error page when the upgrades went live, and the error was mended by Monday.") == ""


@pytest.mark.parametrize("body", ["The keyerror was mended.", "An IndexError ('x')", "ATTRIBUTEERROR\n: x", "ſyntaxError: x", "Fatal error: x", "NameError(", "ReferenceError [x]"])
def test_errors_of_programs_as_before(body):
    assert (residue.residue_kind(body) == "stand_in") == bool(residue._STAND_IN.search(body))


def test_placeholders_are_those_of_the_pattern():
    assert [residue.residue_kind(b) == "placeholder" for b in bodies()] == [bool(residue._PLACEHOLDER.search(b)) for b in bodies()]


def test_a_body_is_split_once_for_verdict_and_lines(monkeypatch):
    calls, row_words = [], L.row_words
    monkeypatch.setattr(L, "row_words", lambda body: calls.append(body) or row_words(body))
    some = bodies(300)
    got = mainbody.reader(HEADS)(some, ["dailyledger"] * 300)["other"]
    assert calls == some
    assert got == [[k for k, m in enumerate(mainbody.main_lines(b, "dailyledger", HEADS), 1) if m is False] if quality.is_prose(b) else [] for b in some]


def test_words_of_the_body_give_the_lines_that_each_line_gives():
    for b in bodies(1000):
        code, parts = L.has_run(b, L.CODE), L.parts_in(b)
        assert [L.read_line(r, "dailyledger", HEADS, parts, w, code) for r, w in zip(b.split("\n"), L.row_words(b))] == [L.read_line(r, "dailyledger", HEADS, parts) for r in b.split("\n")]
        assert L.has_run(b, 30) == any(len(w) >= 30 for w in b.split())


def test_a_line_fits_if_its_shape_is_kept():
    lines = ["", "Acme Foods split over lower prices", "Acme, Foods split over", "split over prices", "Acme split over", "( 5 ) over", *(L.plain(b) for b in bodies())]
    assert [HEADS.fits(x) for x in lines] == [HEADS.shape(x) in HEADS.shapes for x in lines]
    assert any(map(HEADS.fits, lines)) and not L.Headlines().fits("")


def test_least_hashes_without_hashing_them_again(monkeypatch):
    some = [*bodies(200), "", "one", " "]
    h, doc = K.words(some, False)
    s, at = K.shingles(h, doc, len(some), residue.SHINGLE)
    halves = [np.unique(s[at == k] >> np.uint64(20)) for k in range(len(some))]
    monkeypatch.setattr(np, "unique", None)  # several times as slow as sorting
    got = K.prints(some, residue.SHINGLE, residue.SIMILAR, False)
    assert got["n_shingles"].tolist() == [len(x) for x in halves]
    for x, least in zip(halves, got["least"]):
        assert least.tolist() == (x[: len(x) - int(np.ceil(residue.SIMILAR * len(x) - 1e-9)) + 1] >> np.uint64(12)).astype(np.uint32).view(np.int32).tolist() if len(x) else len(least) == 0
