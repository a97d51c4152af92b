"""Problem 9: evaluation passages inside a training corpus.

One Aho-Corasick automaton holds short runs of words from all evaluation texts; each document is scanned
once. A run that a passage of ``SHARED`` words must contain is enough as a pattern: hits are extended to both
sides word by word and kept from ``SHARED`` words on, with offsets mapped back to the original text.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Consecutive words that make a leak, and words of a pattern: any SHARED words in a row hold one that starts at a multiple of STEP.
SHARED, STEP = 13, 7
#: Characters of evaluation texts that one automaton holds (about 20 bytes each on a worker); more of them take further scans.
MOST_CHARS = 20_000_000

_DROP = re.compile(r"[^\w\s]|_")
_TOKEN = re.compile(r"\S+")


def normal_words(text: str) -> list[str]:
    """Lower case, letters, digits and white space only, split at white space."""
    return _DROP.sub("", text.lower()).split()


def spans(text: str) -> list[tuple[int, int]]:
    """Offsets in the original ``text`` of each of its normal words."""
    return [m.span() for m in _TOKEN.finditer(text) if _DROP.sub("", m[0].lower())]


class Automaton:
    """Patterns of all evaluation texts: runs of STEP words at multiples of STEP (a shorter text has none of SHARED words)."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        import ahocorasick

        self.items = {}
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item, text in items:
            w = normal_words(text or "")
            if len(w) < SHARED:
                continue
            self.items[item] = w
            # SHARED = 2 * STEP - 1: any SHARED words in a row hold a whole aligned run
            for at in range(0, len(w) - STEP + 1, STEP):
                places[" ".join(w[at : at + STEP])].append((item, at))
        self.machine = ahocorasick.Automaton()
        for run, where in places.items():
            self.machine.add_word(f" {run} ", where)
        self.ready = bool(places)
        if self.ready:
            self.machine.make_automaton()

    def scan(self, text: str) -> list[tuple[int, int, int]]:
        """(item, first word, words) of the longest shared runs of each item in ``text``."""
        if not self.ready:
            return []
        flat = _DROP.sub("", text.lower()).split()
        joined = f" {' '.join(flat)} "
        hits = list(self.machine.iter(joined))
        if not hits:
            return []
        starts = {}
        at = 1
        for k, w in enumerate(flat):
            starts[at] = k
            at += len(w) + 1
        best: dict[tuple[int, int, int], None] = {}
        for end, where in hits:
            # the run began after the blank that its pattern starts with
            for item, k in where:
                own = self.items[item]
                length = sum(len(x) + 1 for x in own[k : k + STEP])
                d = starts[end - length + 1]
                a, b = 0, STEP
                while k - a > 0 and d - a > 0 and own[k - a - 1] == flat[d - a - 1]:
                    a += 1
                while k + b < len(own) and d + b < len(flat) and own[k + b] == flat[d + b]:
                    b += 1
                if a + b >= SHARED:
                    best[(item, d - a, a + b)] = None
        return list(best)


_machines: dict[str, Automaton] = {}


def machine_of(name: str, items: list[tuple[int, str]]) -> Automaton:
    """The automaton of ``items``, built once per worker and kept under ``name`` until another is asked for."""
    if name not in _machines:
        _machines.clear()
        _machines[name] = Automaton(items)
    return _machines[name]


def _groups(items: DataFrame) -> list[DataFrame]:
    """The evaluation texts in parts of at most about ``MOST_CHARS`` characters, by a hash of their ids."""
    own = items.select("item_id", "item_text").filter("item_text IS NOT NULL").dropDuplicates()
    size = own.agg(F.sum(F.length("item_text"))).first()[0] or 0
    n = -(-size // MOST_CHARS) or 1
    return [own.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k) if n > 1 else own for k in range(n)]


def passages(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, stop, words): where in the original text a shared passage stands.

    Null and empty texts give no row; a text that an item shares with several documents, or several items
    with one, gives a row each; repeated rows repeat. More than ``MOST_CHARS`` of evaluation texts are scanned for in several passes.
    """
    parts = [_scan(documents, part) for part in _groups(items)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _scan(documents: DataFrame, items: DataFrame) -> DataFrame:
    name = uuid.uuid4().hex
    held = documents.sparkSession.sparkContext.broadcast([(r["item_id"], r["item_text"]) for r in items.collect()])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = machine_of(name, held.value)
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                if not text:
                    continue
                got = machine.scan(text)
                if got:
                    place = spans(text)
                    rows += [(doc, item, place[at][0], place[at + n - 1][1], n) for item, at, n in got]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "stop", "words"]).astype({"doc_id": "int64", "item_id": "int64", "start": "int32", "stop": "int32", "words": "int32"})

    return documents.select("doc_id", "text").mapInPandas(run, "doc_id long, item_id long, start int, stop int, words int")


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id): the document and the item share at least ``SHARED`` consecutive words."""
    return passages(documents, items).select("doc_id", "item_id").distinct()
