"""Problem 4: the main body of each page, line by line.

The standard library's parser streams over the body; its events give each line its text and a number of tags: each tag that
isn't one of running text, and each word of a link, menu, side box or footer. Text that has lost its tags still shows
signs of them (separators, wording of page furniture, headlines of other stories), which count as tags too. The ratio of text
to tags, smoothed over neighbouring lines by a Gaussian, is split by a two-cluster threshold, which decides every line.
"""

from __future__ import annotations

import math
from html.parser import HTMLParser

import pandas as pd
from collections.abc import Iterator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import lines as L
from millrace.llm.quality import is_prose

SIGMA, RADIUS = 0.45, 2
_KERNEL = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(-RADIUS, RADIUS + 1)]
#: Ratios of text to tags (logarithms) around which the two clusters form, how many lines each counts for, and where between the clusters the cut lies.
LOW, HIGH, ANCHOR, CUT = math.log1p(5), math.log1p(120), 5, 0.4
#: Characters that a heading, or the row of a table, counts for at least.
HEADING = 40
#: Characters that the parser is fed at a time; a tag that is longer, or never closed, is text.
PIECE = 4096

#: fixed values: elements of running text, whose tags count for nothing; headings among them; elements whose words count as tags; elements without text
_RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol blockquote table thead tbody tr td th b i em strong br q sup sub figure figcaption article main section".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_ASIDE = frozenset("a nav aside footer header form button select menu label".split())
_NO_TEXT = frozenset("script style noscript template svg".split())


class _TagLines(HTMLParser):
    """The text of each line of a page, and its tags."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags: dict[int, int] = {}
        self.text: dict[int, list[str]] = {}
        self.line = 0
        self.open: list[str] = []
        self.heads: set[int] = set()

    def _tag(self, n: int = 1) -> None:
        self.tags[self.line] = self.tags.get(self.line, 0) + n

    def handle_starttag(self, tag, attrs) -> None:
        if tag not in _RUNNING:
            self._tag()
        if tag in _ASIDE or tag in _NO_TEXT:
            self.open.append(tag)
        elif tag in _HEADING:
            self.heads.add(self.line)

    def handle_endtag(self, tag) -> None:
        if tag not in _RUNNING:
            self._tag()
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_startendtag(self, tag, attrs) -> None:
        if tag not in _RUNNING:
            self._tag()

    def handle_data(self, data) -> None:
        if any(x in _NO_TEXT for x in self.open):
            return
        self.text.setdefault(self.line, []).append(data)
        if self.open:
            self._tag(2 * len(data.split()))


def page_lines(body: str) -> tuple[list[str], dict[int, int], set[int]]:
    """(text, tags, headings) of the lines of a body, tags and headings by number from 0; each line keeps its place."""
    rows = body.split("\n")
    if "<" not in body:  # the parser would pass over it without an event
        return rows, {}, set()
    parser = _TagLines()

    def flush() -> None:
        left = parser.rawdata
        parser.reset()
        parser.handle_data(left)

    for n, row in enumerate(rows):
        parser.line = n
        if "<" not in row and not parser.rawdata and not parser.cdata_elem:
            parser.handle_data(row)
            continue
        for at in range(0, len(row) + 1, PIECE):
            try:
                parser.feed(row[at : at + PIECE] + ("\n" if at + PIECE > len(row) else ""))
            except (AssertionError, ValueError):
                flush()  # a malformed declaration
            if len(parser.rawdata) > PIECE:
                flush()
    flush()
    return ["".join(parser.text.get(n, ())).strip() for n in range(len(rows))], parser.tags, parser.heads


def smooth(x: list[float]) -> list[float]:
    out = []
    n = len(x)
    far, near, own = _KERNEL[: RADIUS + 1]
    whole = far + near + own + near + far
    for i in range(n):
        if 2 <= i < n - 2:
            out.append((far * x[i - 2] + near * x[i - 1] + own * x[i] + near * x[i + 1] + far * x[i + 2]) / whole)
            continue
        top = low = 0.0
        for k in range(max(0, i - RADIUS), min(n, i + RADIUS + 1)):
            w = _KERNEL[k - i + RADIUS]
            top += w * x[k]
            low += w
        out.append(top / low)
    return out


def threshold(x: list[float]) -> float:
    """A cut between the means of two clusters, each held by its anchor; a page of one kind has all its lines on one side."""
    lo, hi = LOW, HIGH
    for _ in range(8):
        cut = lo + CUT * (hi - lo)
        a, b = [v for v in x if v <= cut], [v for v in x if v > cut]
        new = ((sum(a) + ANCHOR * LOW) / (len(a) + ANCHOR), (sum(b) + ANCHOR * HIGH) / (len(b) + ANCHOR))
        if new == (lo, hi):
            break
        lo, hi = new
    return lo + CUT * (hi - lo)


def ratios(read: list[L.Line], at: list[int], tags: dict[int, int], heads: set[int]) -> list[float]:
    """Text to tags of the lines ``at``, as logarithms. A heading, a phrase of its own or one that leads on to text of the page,
    weighs as much as a short sentence; of other short lines each word counts as a tag, as in a menu."""
    after = L.BLANK  # kind of the next line that is neither furniture nor too short to tell
    leads: dict[int, int] = {}
    for i in reversed(at):
        leads[i] = after
        kind = read[i].kind
        after = kind if kind in (L.PROSE, L.GRID) else after if kind == L.SITE else L.SHORT
    out = []
    for i in at:
        x = read[i]
        chars, count = x.chars, x.tags + tags.get(i, 0)
        if x.kind in (L.PROSE, L.GRID) or i in heads:
            chars = max(chars, HEADING)
        elif x.kind == L.SHORT:
            if x.words <= 3 and not x.ends and not any(map(str.isdigit, x.text)):
                count += x.words
            elif x.words >= 5 and x.phrase or leads[i] in (L.PROSE, L.GRID):
                chars = max(chars, HEADING)
            else:
                count += 1
        out.append(math.log1p(chars / (1 + count)))
    return out


def main_lines(body: str, site: str, headlines: L.Headlines, words: list[list[str]] | None = None) -> list[bool | None]:
    """For each line whether it is main body; None for blank lines. A line of markup alone isn't. ``words`` are ``row_words`` of the body."""
    rows, tags, heads = page_lines(body)
    parts = L.parts_in(body)
    if words is None or "<" in body:
        words = [r.lower().split() for r in rows]
    code = "<" in body or L.has_run(body, L.CODE)
    read = [L.read_line(r, site, headlines, parts, w, code) for r, w in zip(rows, words)]
    at = [i for i, x in enumerate(read) if x.kind != L.BLANK]
    out: list[bool | None] = [None] * len(read)
    if tags or heads:
        for i, row in enumerate(body.split("\n")):
            out[i] = False if row.strip() else None
    if not at:
        return out
    even = smooth(ratios(read, at, tags, heads))
    cut = threshold(even)
    for i, v in zip(at, even):
        out[i] = v > cut
    return out


def reader(headlines: L.Headlines):
    """The lines of prose bodies that aren't main body, for ``residue.labels``, which reads bodies once."""

    def run(bodies: list[str], sites: list[str]) -> dict[str, list]:
        other = []
        for b, s in zip(bodies, sites):
            words = L.row_words(b)
            other.append([k for k, main in enumerate(main_lines(b, s, headlines, words), 1) if main is False] if is_prose(b, words) else [])
        return {"other": other}

    return run


def found(rows: DataFrame, residue_ids: DataFrame) -> DataFrame:
    """(id, line_no): non-blank lines that aren't main body, from stored labels (id, other); without ``residue_ids`` (problem 3) and bodies that aren't prose.

    Null and blank bodies give no row; repeated rows of an id give its lines once.
    """
    return rows.filter("size(other) > 0").select("id", "other").join(residue_ids, "id", "left_anti").select("id", F.explode("other").alias("line_no")).distinct()


def main_bodies(articles: DataFrame, headlines: L.Headlines) -> DataFrame:
    """(id, main_text): each body with only its main lines, without markup; null stays null, a body without any is empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = []
            for body, domain in zip(pdf["body_text"], pdf["source_domain"]):
                if body is None:
                    texts.append(None)
                    continue
                keep = main_lines(body, L.site_name(domain), headlines)
                texts.append("\n".join(r for r, k in zip(page_lines(body)[0], keep) if k))
            yield pd.DataFrame({"id": pdf["id"], "main_text": texts})

    return articles.select("id", "body_text", "source_domain").mapInPandas(run, "id long, main_text string")
