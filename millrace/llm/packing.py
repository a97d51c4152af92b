"""Problem 8: whole texts into containers of fixed capacity with little room left.

Only the histogram of lengths, at most one count per token of capacity, reaches the driver. There, patterns
of two and three lengths that fill a container are enumerated, their repeats fitted to the histogram by
non-negative least squares and rounded down, and what is left is packed largest first into the room that
remains and into further containers. Texts then take their places by rank within their length.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialize

TOKENIZER = os.environ.get("MILLRACE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: fixed value: how the byte-level vocabulary splits text before merging
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Steps of length in which patterns are fitted, sweeps of the fit, rows of one length that one task ranks, targets spread at a time, units up to which four lengths make a pattern, power of the length in a residual's weight.
UNITS, SWEEPS, RANK_ROWS, TARGETS, FOUR_UNITS, POWER = 1024, 8, 1_000_000, 500, 128, 2.0

_encodings: dict[str, object] = {}


def encoding(path: str = TOKENIZER):
    """The tokenizer in ``path`` (ranks of a byte-level vocabulary), loaded once per worker."""
    if path not in _encodings:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def token_counts(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens); a null text has none, as an empty one. The vocabulary is sent to executors that don't have it at ``path``."""
    if not os.path.isfile(path):
        raise FileNotFoundError(f"no vocabulary at {path}: set MILLRACE_TOKENIZER to one of a public tokenizer")
    context = documents.sparkSession.sparkContext
    if not context.master.startswith("local"):
        context.addFile(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoding(path if os.path.isfile(path) else SparkFiles.get(os.path.basename(path)))
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": np.array([len(own.encode_ordinary(t)) if t else 0 for t in pdf["text"]], dtype=np.int32)})

    return documents.select("doc_id", "text").mapInPandas(run, "doc_id long, n_tokens int")


@dataclass
class Group:
    """``repeats`` containers with the same lengths in them."""

    lengths: dict[int, int]
    room: int
    repeats: int


def _patterns(units: int) -> list[tuple[int, ...]]:
    """Two or three lengths, in units, that fill a container to the unit; four where the units are coarse enough for few such patterns."""
    pairs = [(a, units - a) for a in range((units + 1) // 2, units)]
    triples = [(a, b, units - a - b) for a in range((units + 2) // 3, units - 1) for b in range((units - a + 1) // 2, min(a, units - a - 1) + 1)]
    fours = [(a, *p) for a in range((units + 3) // 4, units - 2) for p in _parts(units - a, a)] if units <= FOUR_UNITS else []
    return pairs + triples + fours


def _parts(total: int, most: int) -> list[tuple[int, int, int]]:
    """Three lengths of at most ``most``, falling, that make ``total``."""
    return [(b, c, total - b - c) for b in range((total + 2) // 3, min(most, total - 2) + 1) for c in range((total - b + 1) // 2, min(b, total - b - 1) + 1)]


def fit_repeats(counts: np.ndarray, patterns: list[tuple[int, ...]], sweeps: int = SWEEPS, power: float = POWER) -> np.ndarray:
    """Non-negative least squares: repeats x of ``patterns`` with A x near ``counts`` (index: length in units).

    A residual weighs the more the longer its items, which are the harder to place afterwards. Coordinate descent on the residual; a
    column of A has at most four entries, so a step costs four look-ups.
    """
    left = counts.astype(float).tolist()
    weight = ((np.arange(len(counts)) / max(len(counts) - 1, 1)) ** power).tolist()
    x = [0.0] * len(patterns)
    columns = [tuple((u, p.count(u), p.count(u) * weight[u]) for u in sorted(set(p))) for p in patterns]
    scale = [sum(m * w for _, m, w in column) for column in columns]
    for _ in range(sweeps):
        moved = 0.0
        for k, column in enumerate(columns):
            new = x[k] + sum(left[u] * w for u, _, w in column) / scale[k]
            step = (new if new > 0 else 0.0) - x[k]
            if step:
                x[k] += step
                for u, m, _ in column:
                    left[u] -= m * step
                moved = max(moved, abs(step))
        if moved < 0.5:
            break
    return np.array(x)


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[Group], bool]:
    """(containers for all lengths 1..capacity of ``histogram``, whether they come from fitted patterns): groups of equal ones, which use every item once.

    Where the histogram has so few items of a length that rounding leaves most of them over, the rest packed alone can need fewer
    containers than the fitted plan; only then it's taken.
    """
    fitted, rest = _plan(histogram, capacity, True), _plan(histogram, capacity, False)
    better = sum(g.repeats for g in fitted) <= sum(g.repeats for g in rest)
    return (fitted, True) if better else (rest, False)


def _plan(histogram: dict[int, int], capacity: int, fit: bool) -> list[Group]:
    left = {n: c for n, c in histogram.items() if c > 0 and 0 < n <= capacity}
    groups: list[Group] = []
    for n in [n for n in left if n == capacity]:
        groups.append(Group({n: 1}, 0, left.pop(n)))
    units = min(UNITS, capacity)
    step = -(-capacity // units)
    by_unit: dict[int, list[int]] = {}
    for n in sorted(left, reverse=True):
        by_unit.setdefault(-(-n // step), []).append(n)
    top = capacity // step  # whole units that surely fit
    counts = np.zeros(top + 1)
    for u, ns in by_unit.items():
        if u <= top:
            counts[u] = sum(left[n] for n in ns)
    patterns = [p for p in _patterns(top) if all(counts[u] for u in p)] if fit and top >= 3 else []
    if patterns:
        for p, repeats in zip(patterns, np.floor(fit_repeats(counts, patterns) + 1e-9).astype(int).tolist()):
            while repeats > 0:
                # the longest left of each unit; the run lasts as long as these lengths do
                need: dict[int, int] = {}
                for u in p:
                    n = next((n for n in by_unit[u] if left.get(n, 0) > need.get(n, 0)), None)
                    if n is None:
                        need = {}
                        break
                    need[n] = need.get(n, 0) + 1
                if not need:
                    break
                times = int(min(repeats, *(left[n] // m for n, m in need.items())))
                groups.append(Group(need, capacity - sum(n * m for n, m in need.items()), times))
                for n, m in need.items():
                    left[n] -= m * times
                repeats -= times
    # the rest, largest first: into the room left, then into new containers
    lengths = np.array(sorted(n for n in left if left[n] > 0), dtype=np.int64)
    alive = np.ones(len(lengths), bool)

    def largest(most: int) -> int | None:
        k = int(np.searchsorted(lengths, most, side="right")) - 1
        while k >= 0 and not alive[k]:
            k -= 1
        return k if k >= 0 else None

    def take(k: int, n: int) -> None:
        left[int(lengths[k])] -= n
        if left[int(lengths[k])] == 0:
            alive[k] = False

    done: list[Group] = []
    stack = sorted(groups, key=lambda g: -g.room)
    while stack or alive.any():
        if not stack:
            k = largest(capacity)
            n = int(lengths[k])
            each = min(capacity // n, left[n])
            times = left[n] // each
            take(k, each * times)
            stack.append(Group({n: each}, capacity - n * each, times))
        g = stack.pop()
        while (k := largest(g.room)) is not None:
            n = int(lengths[k])
            if left[n] < g.repeats:
                some = left[n]
                stack.append(Group(dict(g.lengths), g.room, g.repeats - some))
                g.repeats = some
            each = min(g.room // n, left[n] // g.repeats)
            take(k, each * g.repeats)
            g.lengths[n] = g.lengths.get(n, 0) + each
            g.room -= n * each
        done.append(g)
    return done


def slots(groups: list[Group], key: int) -> pd.DataFrame:
    """Ranges of rank that groups take of each length: (key, tokens, rank0, each, container0)."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for g in groups:
        for n, each in g.lengths.items():
            rows.append((key, n, used.get(n, 0), each, base))
            used[n] = used.get(n, 0) + each * g.repeats
        base += g.repeats
    return pd.DataFrame(rows, columns=["key", "tokens", "rank0", "each", "container0"])


def pieces(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id, capacity, doc_id, piece, first_token, tokens): a text is one piece unless it exceeds the capacity."""
    caps = targets.filter("capacity_tokens > 0").select("target_id", F.col("capacity_tokens").cast("int").alias("capacity")).dropDuplicates(["target_id"]).orderBy("target_id").collect()
    each = None
    for i in range(0, max(len(caps), 1), TARGETS):
        some = F.array(*[F.struct(F.lit(r["target_id"]).alias("target_id"), F.lit(r["capacity"]).alias("capacity")) for r in caps[i : i + TARGETS]])
        some = some if caps else some.cast("array<struct<target_id int, capacity int>>")
        part = counts.select("doc_id", "n_tokens", F.explode(some).alias("t")).select("t.*", "doc_id", "n_tokens")
        each = part if each is None else each.unionByName(part)
    last = F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / F.col("capacity")).cast("int") - 1)
    each = each.select("target_id", "capacity", "doc_id", "n_tokens", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    first = F.col("piece") * F.col("capacity")
    return each.select("target_id", "capacity", "doc_id", "piece", first.alias("first_token"), F.least(F.col("capacity"), F.col("n_tokens") - first).alias("tokens"))


def pack(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id, doc_id, piece, first_token, tokens, container, fitted): every piece in one container of its target; whether its plan was fitted.

    Containers are numbered from 0 per target. Items without tokens take no room and lie in container 0.
    Equal items are told apart by rank, so ties and repeated rows each have a place; no documents or no targets give no row.
    """
    spark = counts.sparkSession
    items = pieces(materialize(counts, "tokens"), targets).withColumn("_h", F.xxhash64("doc_id", "piece"))
    histogram = items.groupBy("target_id", "capacity", "tokens").count().collect()  # at most a row per token of capacity
    most = max((r["count"] for r in histogram), default=0)
    blocks = max(1, -(-most // RANK_ROWS) * 4 if most > RANK_ROWS else 1)
    tables, fitted = [], set()
    for target, capacity in sorted({(r["target_id"], r["capacity"]) for r in histogram}):
        own = {r["tokens"]: r["count"] for r in histogram if r["target_id"] == target}
        groups, by_fit = plan(own, capacity)
        tables.append(slots(groups, target))
        fitted |= {target} if by_fit else set()
    table = pd.concat(tables, ignore_index=True) if tables else slots([], 0)
    table = table.sort_values(["key", "tokens", "rank0"], ignore_index=True)
    held = spark.sparkContext.broadcast({(int(k), int(n)): (x["rank0"].to_numpy(), x["each"].to_numpy(), x["container0"].to_numpy()) for (k, n), x in table.groupby(["key", "tokens"])})
    # ranks within a length, in blocks: a length that a third of all texts share is ranked by many tasks
    items = items.withColumn("_b", F.pmod(F.col("_h"), F.lit(blocks)).cast("int"))
    if blocks > 1:
        sizes = items.groupBy("target_id", "tokens", "_b").count()
        before = sizes.withColumn("_before", F.coalesce(F.sum("count").over(Window.partitionBy("target_id", "tokens").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
        items = items.join(before, ["target_id", "tokens", "_b"])
    else:
        items = items.withColumn("_before", F.lit(0).cast("long"))
    rank = F.row_number().over(Window.partitionBy("target_id", "tokens", "_b").orderBy("_h", "doc_id", "piece")) - 1 + F.col("_before")
    ranked = items.select("target_id", "doc_id", "piece", "first_token", "tokens", rank.cast("long").alias("rank"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = held.value
        for pdf in batches:
            container = np.zeros(len(pdf), dtype=np.int64)
            rank = pdf["rank"].to_numpy()
            for (target, n), at in pdf.groupby(["target_id", "tokens"]).indices.items():
                if n == 0:
                    continue
                rank0, each, base = own[(int(target), int(n))]
                k = np.searchsorted(rank0, rank[at], side="right") - 1
                container[at] = base[k] + (rank[at] - rank0[k]) // each[k]
            yield pdf.drop(columns="rank").assign(container=container)

    return ranked.mapInPandas(place, "target_id int, doc_id long, piece int, first_token int, tokens int, container long").withColumn("fitted", F.col("target_id").isin(*sorted(fitted)) if fitted else F.lit(False))


def fill(packed: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id, containers, tokens, fitted, filled): how full the containers of each target are, and whether patterns were fitted."""
    total = packed.groupBy("target_id").agg(F.max("fitted").alias("fitted"), (F.max("container") + 1).alias("containers"), F.sum(F.col("tokens").cast("long")).alias("tokens"))
    return total.join(targets, "target_id").select("target_id", "containers", "tokens", "fitted", (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("filled"))
