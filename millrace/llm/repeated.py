"""Problem 1: lines repeated across one site's documents.

The letters of a body are one stream, cut into chunks by content: a rolling hash over the letters ends a chunk wherever it
hits a pattern, whatever lines the letters stand in, so a notice wrapped at another column has the same chunks. Distinct
documents are counted per source and chunk. Each line has chunks of its own, those that its letters alone determine; where it holds
no whole one of the stream, that is the letters between the two strongest cuts of a narrower hash within it. A line whose own chunks
don't all occur often enough is no case, and no line comes in otherwise; what is left is then counted by line, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import kernels as K
from millrace.session import materialize

#: Letters that the rolling hash sees; mean letters of a chunk (a power of two); articles from which a line is excessive; least letters of a line.
WINDOW, MEAN, EXCESSIVE, LETTERS = 16, 128, 5, 12
#: Letters that the narrower hash sees: fewer than ``LETTERS``, so that every line has two cuts.
NARROW = 8

_KEEP = np.zeros(256, bool)
_KEEP[[0, 10, *range(97, 123), *range(128, 256)]] = True


def _letters(text: str) -> str:
    low = text.lower().replace("\0", "")
    return low if low.isascii() else "".join(c for c in low if c == "\n" or c.isalpha())


def _strongest(run: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the letters between the two strongest cuts of each stretch [start, end), those where the hash of ``NARROW`` letters is
    least (of equal ones the first), the windows of both included. No cut between them is as strong, so it is a chunk of that strength."""
    if not len(start):
        return np.zeros(0, np.uint64)
    n = end - start - NARROW + 1
    begin = np.cumsum(n) - n
    at = np.arange(n.sum()) + np.repeat(start - begin, n)
    rolling = K.stretch(run, at, at + NARROW)
    two = []
    for _ in range(2):
        hits = np.flatnonzero(rolling == np.repeat(np.minimum.reduceat(rolling, begin), n))
        hit = hits[np.searchsorted(hits, begin)]
        two.append(at[hit])
        rolling[hit] = np.iinfo(np.uint64).max
    return K.stretch(run, np.minimum(*two), np.maximum(*two) + NARROW)


def cut(texts: list[str]) -> dict[str, np.ndarray]:
    """The chunks of the letters of ``texts``, and one for each line of at least ``LETTERS`` letters that determines none, as arrays.

    doc, chunk (hash), size (letters, 0 for a chunk within those of the text), first (of its chunk in its text); of the line that a
    chunk is determined by: line_no (from 1, or 0), letters, line (hash), parts (chunks that it determines).
    """
    raw = "\0".join(_letters(t) for t in texts) + "\0"
    full = np.frombuffer(raw.encode("utf-8", "replace"), np.uint8)
    buf = full[_KEEP[full]]
    is_end = (buf == 10) | (buf == 0)
    end = np.flatnonzero(is_end)  # end of each line
    closes = buf[end] == 0
    n_line = np.arange(len(end))
    doc = np.concatenate([[0], np.cumsum(closes)[:-1]])
    first_line = np.concatenate([[0], np.flatnonzero(closes)[:-1] + 1])
    line_no = n_line - first_line[doc] + 1
    # from here on places are those among letters alone
    stream = buf[~is_end]
    end = end - n_line
    start = np.concatenate([[0], end[:-1]])
    lead = np.concatenate([[0], np.cumsum((stream & 0xC0) != 0x80)])  # bytes that begin a letter
    letters = lead[end] - lead[start]
    own = letters >= LETTERS
    doc_start, doc_end = start[first_line], end[np.flatnonzero(closes)]
    start, end, doc_of_line, line_no, letters = start[own], end[own], doc[own], line_no[own], letters[own]
    run = K.running(stream)
    at = np.arange(len(stream) - WINDOW + 1) if len(stream) >= WINDOW else np.zeros(0, np.int64)
    rolling = K.stretch(run, at, at + WINDOW)
    cuts = at[(rolling >> np.uint64(40)) % np.uint64(MEAN) == 0] + WINDOW  # a chunk may end here
    of = np.searchsorted(doc_start, cuts - WINDOW, side="right") - 1
    # documents without letters share their start with the next one
    inside = (cuts < doc_end[of]) if len(of) else np.zeros(0, bool)
    cuts, of = cuts[inside], of[inside]
    full_docs = np.flatnonzero(doc_end > doc_start)
    bounds, owner = np.concatenate([doc_start[full_docs], cuts]), np.concatenate([full_docs, of])
    order = np.argsort(bounds, kind="stable")
    bounds, owner = bounds[order], owner[order]
    same = np.append(owner[1:] == owner[:-1], False)  # whether a cut, not the end of the text, ends the chunk
    stop = np.where(same, np.append(bounds[1:], 0), doc_end[owner])
    chunk = K.stretch(run, bounds, stop)
    # a chunk is determined by a line if both its ends are, each by the letters before it
    line = np.searchsorted(start, bounds - WINDOW, side="right") - 1
    held = (line >= 0) & same
    if len(start):
        held &= (bounds - WINDOW >= start[line]) & (stop <= end[line])
    parts = np.bincount(line[held], minlength=len(start))
    bare = np.flatnonzero(parts == 0)
    hashes = K.stretch(run, start, end).view(np.int64)
    if len(start):
        of_line = lambda x: np.where(held, x[line], 0)
    else:
        of_line = lambda x: np.zeros(len(line), x.dtype)
    both = lambda x, y: np.concatenate([x, y])
    none = np.zeros(len(bare), np.int64)
    owner, chunk = both(owner, doc_of_line[bare]), both(chunk, _strongest(run, start[bare], end[bare]))
    _, seen = np.unique(K.mix(chunk ^ K.mix(owner.astype(np.uint64))), return_index=True)
    first = np.zeros(len(chunk), bool)
    first[seen] = True
    return {
        "doc": owner, "chunk": chunk.view(np.int64), "size": both(lead[stop] - lead[bounds], none), "first": first,
        "line_no": both(of_line(line_no), line_no[bare]), "letters": both(of_line(letters), letters[bare]), "line": both(of_line(hashes), hashes[bare]), "parts": both(of_line(parts), none + 1),
    }


def _chunk_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        texts, ids, sources = pdf["body_text"].tolist(), pdf["id"].to_numpy(), pdf["source"].to_numpy()
        for i, j in K.chunks(texts):
            got = cut(texts[i:j])
            doc = got.pop("doc") + i
            yield pd.DataFrame({"id": ids[doc], "source": sources[doc], **got})


def chunk_rows(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """A row per chunk, as of ``cut``: (id, source, chunk, size, first, line_no, letters, line, parts).

    ``source`` is a hash of the source's name. Texts without a source or without a body give no row.
    """
    rows = docs.filter(F.col(source).isNotNull() & F.col(text).isNotNull() & (F.col(text) != ""))
    rows = rows.select(F.col(key).alias("id"), F.xxhash64(source).alias("source"), F.col(text).alias("body_text"))
    return rows.mapInPandas(_chunk_rows, "id long, source long, chunk long, size int, first boolean, line_no int, letters int, line long, parts int")


def repeated_chunks(rows: DataFrame, least: int = EXCESSIVE) -> DataFrame:
    """(source, chunk, documents) of chunks that at least ``least`` documents of a source have; repeated rows of an id count once."""
    ids = F.count_distinct("id")
    counts = rows.groupBy("source", "chunk").agg(F.sum(F.col("first").cast("long")).alias("documents")).filter(F.col("documents") >= least)
    # rows of one id that repeat are told apart only where enough rows have the chunk
    return rows.filter("first").join(counts.select("source", "chunk"), ["source", "chunk"], "left_semi").groupBy("source", "chunk").agg(ids.alias("documents")).filter(F.col("documents") >= least)


def stretches(docs: DataFrame, key: str = "id", text: str = "body_text", source: str = "source_domain", least: int = EXCESSIVE) -> DataFrame:
    """(id, letters, repeated): how many letters a text has, and how many of them stand in chunks that at least ``least`` documents of its
    source have, however their lines are wrapped. Texts without letters or source give no row."""
    rows = materialize(chunk_rows(docs, key, text, source).filter("size > 0").select("id", "source", "chunk", "size", "first"), "chunks")
    often = repeated_chunks(rows, least).select("source", "chunk", F.lit(True).alias("_often"))
    each = rows.groupBy("id", "source", "chunk").agg(F.sum("size").alias("size")).join(often, ["source", "chunk"], "left")
    return each.groupBy("id").agg(F.sum("size").alias("letters"), F.sum(F.when(F.col("_often"), F.col("size")).otherwise(F.lit(0))).alias("repeated"))


def candidates(rows: DataFrame, least: int = EXCESSIVE) -> DataFrame:
    """(id, source, line_no, letters, line) of ``rows`` of ``chunk_rows``: lines whose own chunks are all in at least ``least`` texts of their source."""
    often = rows.groupBy("source", "chunk").agg(F.sum(F.col("first").cast("long")).alias("documents")).filter(F.col("documents") >= least)
    own = ["id", "source", "line_no", "letters", "line"]
    kept = rows.filter("parts > 0").select(*own, "chunk", "parts").join(often.select("source", "chunk"), ["source", "chunk"], "left_semi")
    one = kept.filter("parts = 1").select(*own)
    more = kept.filter("parts > 1").groupBy(*own, "parts").agg(F.count("*").alias("n")).filter(F.col("n") >= F.col("parts"))
    return one.unionByName(more.select(*own))


def repeated_lines(docs: DataFrame, key: str = "id", text: str = "body_text", source: str = "source_domain", least: int = EXCESSIVE) -> DataFrame:
    """(id, line_no): lines that at least ``least`` documents of their source have, letters alone and case ignored.

    Lines with fewer than ``LETTERS`` letters never count; repeated rows of one id count once.
    """
    rows = materialize(chunk_rows(docs, key, text, source), "chunks")
    lines = materialize(candidates(rows, least), "lines")
    # the exact check: distinct documents of the whole line
    full = lines.groupBy("source", "line", "letters").agg(F.count_distinct("id").alias("n")).filter(F.col("n") >= least)
    return lines.join(full.select("source", "line", "letters"), ["source", "line", "letters"], "left_semi").select("id", "line_no").distinct()


def clean_bodies(docs: DataFrame, found: DataFrame, key: str = "id", text: str = "body_text") -> DataFrame:
    """(id, clean_text): each text without the lines of ``found`` (id, line_no); null stays null."""
    marks = found.groupBy(F.col("id").alias("_id")).agg(F.collect_set("line_no").alias("_cut"))
    joined = docs.select(F.col(key).alias("id"), F.col(text).alias("_text")).join(marks, F.col("id") == F.col("_id"), "left")
    kept = F.filter(F.split("_text", "\n", -1), lambda x, i: ~F.array_contains("_cut", i + 1))
    return joined.select("id", F.when(F.col("_cut").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n")).alias("clean_text"))
