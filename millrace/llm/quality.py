"""Problem 5: text statistics of a body, and whether it is natural prose.

Tables and lists show in how lines follow one another: columns that align from line to line, a
period in marks and indentation, line lengths that repeat. These and ratios of words, symbols and
sentence ends go into one score for every body, weighed by a logistic model; above zero a body is no prose.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import lines as L

_DELIMITERS = ("|", "\t", ";", ",", "    ")
_ENDS = '.!?"”…:'
_TYPESET = "’‘“”„–—…•·«·»°€£©"
#: Characters, without blanks, below which a body shows too little to be called anything but prose.
LEAST = 20
#: What the score is made of, in order.
FEATURES = ("common", "symbols", "digits", "worded", "ended", "aligned", "period", "autocorrelation", "long_runs", "stops", "separators", "word_length", "unusual")


def _autocorrelation(x: list[int]) -> float:
    """Lag-one autocorrelation of line lengths; 1.0 for lines of one length."""
    n = len(x)
    if n < 3:
        return 0.0
    mean = sum(x) / n
    var = sum((v - mean) ** 2 for v in x)
    if var < 1e-9:
        return 1.0
    return sum((x[i] - mean) * (x[i + 1] - mean) for i in range(n - 1)) / var


def layout(rows: list[str]) -> tuple[float, float, float]:
    """(alignment, period, autocorrelation) of non-blank lines.

    ``alignment``: share of neighbouring lines with the same number, at least one, of some delimiter;
    ``period``: share of neighbouring lines that start with the same kind of mark and indentation.
    """
    if len(rows) < 3:
        return 0.0, 0.0, 0.0
    pairs = len(rows) - 1
    aligned = 0.0
    for d in _DELIMITERS:
        counts = [r.count(d) for r in rows]
        if not any(counts):
            continue
        aligned = max(aligned, sum(a == b and a >= (1 if d in "|\t" else 2) for a, b in zip(counts, counts[1:])) / pairs)
    heads = []
    for r in rows:
        bare = r.lstrip()
        mark = bare[:1]
        heads.append(None if mark.isalpha() else (len(r) - len(bare), "9" if mark.isdigit() else mark))
    period = sum(a == b and a is not None for a, b in zip(heads, heads[1:])) / pairs
    return aligned, period, _autocorrelation([len(r) for r in rows])


def _aligned(rows: list[str]) -> list[bool]:
    """Which of the non-blank lines are rows of a table: as many column marks as a neighbour, in a table of three rows or more."""
    marked = [False] * len(rows)
    for d, least in (("|", 1), ("\t", 1), ("    ", 2)):
        counts = [r.strip().count(d) for r in rows]
        same = [a == b and a >= least for a, b in zip(counts, counts[1:])]
        own = [x or y for x, y in zip([False, *same], [*same, False])]
        if sum(own) >= 3:
            marked = [x or y for x, y in zip(marked, own)]
    return marked


def features(body: str, words: list[list[str]] | None = None, whole: bool = True) -> list[float | None]:
    """The ``FEATURES`` of a body with at least one non-blank character; ``words`` are its ``row_words``.

    Without ``whole``, those that compare lines or look at their ends, all between 0 and 1, are None.

    Shares of words: function words, words that end in a full stop in lines with a function word, separators a word. Shares of characters: symbols,
    digits, lines with two function words out of columns, lines with a sentence end, rows of aligned columns (cubed, as half a page of them is still a story with a table), runs of thirty and more, signs that neither words nor typesetting use.
    """
    words = words or L.row_words(body)
    rows = [r for r, w in zip(body.split("\n"), words) if w]
    n = sum(map(len, words))
    size = sum(map(len, rows))
    own = [sum(map(L.FUNCTION.__contains__, w)) for w in words if w]
    if body.isascii():
        run = body.encode().translate(None, L.BLANKS)
        symbols = len(run.translate(None, L.ALNUM))
        digits = len(run) - len(run.translate(None, b"0123456789"))
    else:
        run = "".join(body.split())
        symbols = len(run) - sum(map(str.isalnum, run))
        digits = sum(map(body.count, "0123456789"))
    solid = len(run)
    columns = _aligned(rows) if "|" in body or "\t" in body or "    " in body else [False] * len(rows)
    marked = sum(len(r) for r, x in zip(rows, columns) if x)
    aligned, period, auto = layout(rows) if whole else (0.0, None, None)
    unusual = 0 if body.isascii() else sum(c > "\x7f" and not c.isalpha() and c not in _TYPESET for c in run)
    long = sum(len(w) for w in body.split() if len(w) >= 30) if L.has_run(body, 30) else 0
    ended = sum(len(r) for r in rows if r.rstrip()[-1] in _ENDS) / size if whole else None
    stops = sum(r.count(". ") + r.count("! ") + r.count("? ") + (r[-1] in ".!?") for r, k in zip(rows, own) if k)
    common = sum(own) / n
    columned = (marked / size) ** 3 if common else max(marked / size, aligned) ** 3 if whole else None
    return [
        common, symbols / solid, digits / solid, sum(len(r) for r, k, x in zip(rows, own, columns) if k > 1 and not x) / size, ended,
        columned, period, max(auto, 0.0) if whole else None, long / solid, stops / n, sum(map(body.count, ",;|\t")) / n, abs(solid / n - 6) / 6, unusual / solid,
    ]


def fit(bodies: list[str], prose: list[bool], ridge: float = 1e-3) -> tuple[list[float], float]:
    """(weights, constant) of the score, by logistic regression on labelled bodies: Newton steps on standardised features."""
    x, y = np.array([features(b) for b in bodies]), 1.0 - np.array(prose, float)
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.hstack([(x - mean) / spread, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w -= np.linalg.solve((z.T * (p * (1 - p))) @ z / len(y) + ridge * np.eye(len(w)), z.T @ (p - y) / len(y) + ridge * w)
    weights = w[:-1] / spread
    return weights.round(3).tolist(), round(float(w[-1] - weights @ mean), 3)


#: Fitted by ``fit`` on 11,034 bodies of the largest test tables and 3,400 made from them (tables with labels from sentences, lists of names,
#: grids between page furniture, stories with a small table or without full stops). Labels of the former are the verdicts of the line rules used before, which an
#: outside listing had found right for all its 9,479 cases.
WEIGHTS = [-5.024, 10.173, -4.428, -4.999, 0.017, 3.451, 0.478, -3.158, 4.458, -66.651, 4.535, 0.824, 20.071]
CONSTANT = 4.898


def is_prose(body: str, words: list[list[str]] | None = None) -> bool:
    """Whether a body is natural prose: every body is judged by its score alone; one of too few characters, or none, is prose.

    What compares lines, and the ends of lines, is left out where no value of it can turn the score. ``words`` are ``row_words`` of the body."""
    if len(body) < LEAST:
        return True
    words = words or L.row_words(body)
    if sum(map(len, words)) < LEAST and len("".join(body.split())) < LEAST:
        return True
    least = most = CONSTANT
    for w, v in zip(WEIGHTS, features(body, words, whole=False)):
        least += min(w, 0.0) if v is None else w * v
        most += max(w, 0.0) if v is None else w * v
    if most < -1e-6 or least > 1e-6:  # beyond what rounding can do
        return most < 0
    return sum(w * v for w, v in zip(WEIGHTS, features(body, words))) + CONSTANT <= 0


STATISTICS = "n_words int, mean_word_length double, symbol_ratio double, ended_share double, common_share double, aligned double, period double, autocorrelation double, is_prose boolean"


def statistics(body: str) -> tuple:
    """All statistics of one body, in the order of ``STATISTICS``; words are runs of non-blank characters."""
    words = body.split()
    n = len(words)
    rows = [r for r in body.split("\n") if r.strip()]
    solid = sum(map(len, words))
    symbols = solid - sum(map(str.isalnum, "".join(words)))
    common = sum(w.lower().strip(".,;:\"'()") in L.FUNCTION for w in words)
    aligned, period, auto = layout(rows)
    return (
        n, solid / n if n else 0.0, symbols / solid if solid else 0.0, sum(r.rstrip()[-1:] in '.!?"”…' for r in rows) / len(rows) if rows else 0.0,
        common / n if n else 0.0, aligned, period, auto, is_prose(body),
    )


def text_statistics(articles: DataFrame) -> DataFrame:
    """(id, stored_words, statistics..) per row of ``articles``.

    A null body has null statistics; an empty one zeros and counts as prose; repeated rows stay repeated.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in STATISTICS.split(", ")]
        for pdf in batches:
            got = [statistics(b) if b is not None else (None,) * len(names) for b in pdf["body_text"]]
            out = pd.DataFrame(got, columns=names)
            out["n_words"] = out["n_words"].astype("Int32")
            out["is_prose"] = out["is_prose"].astype("boolean")
            out.insert(0, "stored_words", pdf["word_count"].astype("Int32").to_numpy())
            out.insert(0, "id", pdf["id"].to_numpy())
            yield out

    return articles.select("id", "word_count", "body_text").mapInPandas(run, f"id long, stored_words int, {STATISTICS}")


def reader(bodies: list[str], sites: list[str]) -> dict[str, list]:
    """Whether each body is prose, for ``residue.labels``, which reads bodies once."""
    return {"prose": [is_prose(b) for b in bodies]}


def found(articles: DataFrame, rows: DataFrame, residue_ids: DataFrame) -> DataFrame:
    """(id, case_kind): ``word_count`` where the stored number isn't the number of words, ``not_prose``.

    ``rows`` (id, prose) are stored labels of the bodies. Ids of ``residue_ids`` (problem 3) are never ``not_prose``; null
    bodies and null stored numbers give no case.
    """
    grids = rows.filter("NOT prose").select("id").join(residue_ids, "id", "left_anti")
    return wrong_counts(articles).select("id", F.lit("word_count").alias("case_kind")).unionByName(grids.select("id", F.lit("not_prose").alias("case_kind"))).distinct()


def wrong_counts(articles: DataFrame) -> DataFrame:
    """(id, n_words) of articles whose stored number isn't the number of runs of non-blank characters; nulls on either side are no case."""
    n = F.regexp_count("body_text", F.lit(r"(?U)[^\s\x1c-\x1f]+"))
    return articles.select("id", "word_count", n.alias("n_words")).filter("word_count IS NOT NULL AND n_words <> word_count").select("id", "n_words")
