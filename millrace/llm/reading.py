"""Problem 10: the reading level of every document, spread from graded examples over a document-word graph.

Documents and words are the two sides of a graph; a word is one of ``WORDS`` buckets of its hash, so one side is
bounded whatever the corpus (``exact`` keeps every word apart and shuffles by word instead). Graded documents are clamped; each harmonic iteration gives words the mean
difficulty of their documents and documents the mean of their words, a word counting the more the less
its documents differ, until words hardly move. Cut points between levels are then chosen where they part the graded documents best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import kernels as K
from millrace.session import materialize

#: Buckets of words; mean change of a word's difficulty at which iteration ends, and most iterations; levels; bins of difficulty for the cut points.
WORDS, SETTLED, ITERATIONS, LEVELS, BINS = 1 << 16, 0.02, 30, 5, 4000
#: Variance that a word has before it is seen, and how many sightings that equals; least variance.
PRIOR_VARIANCE, PRIOR_COUNT, FLOOR = 1.2, 2.0, 0.03

#: fixed values: function words that tell English from the other languages that occur
_ENGLISH = "the of and in for to a that its with as at by is are was were has had from this which would said so while after before into than more because not on it be or but".split()
_OTHER = "der die das und den dem des von mit ein eine le la les du un une et en au aux par pour dans sur el los las del y con para al es het een van te dat".split()


def _known(words: list[str]) -> np.ndarray:
    return np.unique(K.words(words)[0])


def graph(documents: DataFrame, words: int | None = WORDS) -> DataFrame:
    """(doc_id, english, nodes, weights): all documents with their words, in ``words`` buckets or each apart, and whether they are English; those without words have no nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        english, other = _known(_ENGLISH), _known(_OTHER)
        for batch in batches:
            ids = batch.column("doc_id")
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, j in K.chunks(texts):
                n = j - i
                h, doc = K.words(texts[i:j])
                total = np.bincount(doc, minlength=n)
                own = np.bincount(doc, weights=np.isin(h, english), minlength=n)
                foreign = np.bincount(doc, weights=np.isin(h, other), minlength=n)
                is_english = (total > 0) & (own > foreign) & (own >= 0.05 * total)
                node = ((h >> np.uint64(40)) % np.uint64(words)).astype(np.int64) if words else h.view(np.int64)
                order = np.lexsort((node, doc))
                doc, node = doc[order], node[order]
                first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (node[1:] != node[:-1]))) if len(doc) else np.zeros(0, np.int64)
                weight = np.sqrt(np.diff(np.append(first, len(doc)))).astype(np.float32)
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc[first], minlength=n))]).astype(np.int32)
                lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))
                yield pa.RecordBatch.from_arrays([ids.slice(i, n), pa.array(is_english), lists(node[first], pa.int64()), lists(weight, pa.float32())], names=["doc_id", "english", "nodes", "weights"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, english boolean, nodes array<long>, weights array<float>")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = batch.column("nodes")
    nodes = lists.flatten().to_numpy(zero_copy_only=False)
    weights = batch.column("weights").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(lists.offsets.to_numpy())
    return np.repeat(np.arange(len(lists)), sizes), nodes, weights


def _difficulty(doc: np.ndarray, nodes: np.ndarray, weights: np.ndarray, n: int, score: np.ndarray, trust: np.ndarray, mean: float) -> np.ndarray:
    w = weights * trust[nodes]
    low = np.bincount(doc, weights=w, minlength=n)
    top = np.bincount(doc, weights=w * score[nodes], minlength=n)
    return np.where(low > 0, top / np.maximum(low, 1e-12), mean)


def _sums(score: np.ndarray | None, trust: np.ndarray | None, mean: float):
    """Per node the weight, and weighted sum and square sum of difficulty, of its documents; graded ones are clamped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, WORDS))
        for batch in batches:
            doc, nodes, weights = _flat(batch)
            grade = batch.column("grade").to_numpy(zero_copy_only=False).astype(np.float64)
            given = ~np.isnan(grade)
            if score is None:
                f, use = np.nan_to_num(grade), given[doc]
            else:
                f, use = np.where(given, np.nan_to_num(grade), _difficulty(doc, nodes, weights, len(grade), score, trust, mean)), slice(None)
            d, x, w = doc[use], nodes[use], weights[use]
            for k, v in enumerate((w, w * f[d], w * f[d] ** 2)):
                sums[k] += np.bincount(x, weights=v, minlength=WORDS)
        seen = np.flatnonzero(sums[0]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(seen), *(pa.array(s[seen]) for s in sums)], names=["node", "w", "wf", "wff"])

    return run


def _scores(rows: list, mean: float) -> tuple[np.ndarray, np.ndarray]:
    """Difficulty and trust of each node; a node that no document reached has no trust."""
    at = np.array([r["node"] for r in rows], dtype=np.int64)
    w, wf, wff = (np.array([r[k] for r in rows], dtype=np.float64) for k in ("w", "wf", "wff"))
    score, trust = np.full(WORDS, mean), np.zeros(WORDS)
    score[at] = (wf + mean) / (w + 1)
    variance = np.maximum(wff / w - (wf / w) ** 2, 0)
    trust[at] = 1 / ((variance * w + PRIOR_VARIANCE * PRIOR_COUNT) / (w + PRIOR_COUNT) + FLOOR)
    return score, trust


def _cut(low: np.ndarray, high: np.ndarray) -> float:
    """The bin edge that parts documents below a level from those at it best (by F1); of equal ones, the middle."""
    found = np.cumsum(high[::-1])[::-1]
    taken = found + np.cumsum(low[::-1])[::-1]
    f1 = 2 * found / np.maximum(taken + high.sum(), 1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    # the first run of best edges: the gap that has no graded document in it
    run = best[: int(np.argmax(np.append(np.diff(best) > 1, True))) + 1]
    return float(run.mean())


def _exact(nodes: DataFrame, mean: float) -> DataFrame:
    """(doc_id, english, grade, difficulty) with every word a node of its own: sums by word and by document, each combined before its shuffle."""
    edges = nodes.select("doc_id", "english", "grade", F.explode(F.arrays_zip("nodes", "weights")).alias("e")).select("doc_id", "english", "grade", F.col("e.nodes").alias("node"), F.col("e.weights").cast("double").alias("w"))
    edges = materialize(edges, "edges")
    docs = materialize(nodes.select("doc_id", "english", "grade"), "documents").dropDuplicates()
    now, before = docs.select("doc_id", F.col("grade").alias("f")).filter("f IS NOT NULL"), None
    for k in range(ITERATIONS):
        f = edges.filter("english").join(now, "doc_id")
        sums = f.groupBy("node").agg(F.sum("w").alias("s"), F.sum(F.col("w") * F.col("f")).alias("t"), F.sum(F.col("w") * F.col("f") * F.col("f")).alias("u"))
        variance = F.greatest(F.col("u") / F.col("s") - F.pow(F.col("t") / F.col("s"), 2), F.lit(0.0))
        words = sums.select("node", ((F.col("t") + mean) / (F.col("s") + 1)).alias("score"), (1 / ((variance * F.col("s") + PRIOR_VARIANCE * PRIOR_COUNT) / (F.col("s") + PRIOR_COUNT) + FLOOR)).alias("trust"))
        words = materialize(words, "words")
        x = F.col("w") * F.col("trust")
        judged = edges.join(words, "node", "left").groupBy("doc_id").agg((F.sum(x * F.col("score")) / F.sum(x)).alias("d"))
        judged = materialize(docs.join(judged, "doc_id", "left").withColumn("d", F.coalesce("d", F.lit(mean))), "judged")
        now = judged.select("doc_id", F.coalesce("grade", "d").alias("f"))
        if before is not None:
            moved = words.join(before.withColumnRenamed("score", "old"), "node").agg(F.avg(F.abs(F.col("score") - F.col("old")))).first()[0] or 0.0
            if moved <= SETTLED:
                break
        before = words.select("node", "score")
    bare = nodes.filter(F.size("nodes") == 0).select("doc_id").distinct().withColumn("_bare", F.lit(True))
    return judged.join(bare, "doc_id", "left").select("doc_id", "english", "grade", F.when(F.col("_bare"), F.lit(1.0)).otherwise(F.col("d")).alias("difficulty"))


def _bucketed(nodes: DataFrame, mean: float) -> DataFrame:
    """(doc_id, english, grade, difficulty) with words in buckets, whose sums are so few that they are put together on the driver."""
    english = nodes.filter("english")

    def gather(score, trust) -> tuple[np.ndarray, np.ndarray]:
        part = english.select("nodes", "weights", "grade") if score is not None else english.filter("grade IS NOT NULL").select("nodes", "weights", "grade")
        sums = part.mapInArrow(_sums(score, trust, mean), "node int, w double, wf double, wff double")
        # a row per bucket: bounded by WORDS
        return _scores(sums.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("w", "wf", "wff")]).collect(), mean)

    score, trust = gather(None, None)
    for _ in range(ITERATIONS - 1):
        old = score
        score, trust = gather(score, trust)
        if np.abs(score - old)[trust > 0].mean() <= SETTLED:
            break

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, own, weights = _flat(batch)
            difficulty = _difficulty(doc, own, weights, batch.num_rows, score, trust, mean)
            difficulty[np.bincount(doc, minlength=batch.num_rows) == 0] = 1.0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("english"), batch.column("grade"), pa.array(difficulty)], names=["doc_id", "english", "grade", "difficulty"])

    return nodes.mapInArrow(judge, "doc_id long, english boolean, grade double, difficulty double")


def levels(documents: DataFrame, labels: DataFrame, every: bool = False, exact: bool = False) -> DataFrame:
    """(doc_id, difficulty, level) of each English document, or of ``every`` one; several grades of a document count as their mean.

    Copies of a text get one level, also where a copy has no grade. Words and cut points are learnt from English
    documents alone; others are judged by the words that these know. A text without words has the lowest
    level. If no English document is graded, there is no scale and no row. ``exact`` keeps every word apart; ids are then unique.
    """
    grades = labels.filter("grade_level IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("grade_level").alias("grade"))
    nodes = materialize(graph(documents, None if exact else WORDS).filter(F.col("english") | F.lit(every)).join(grades, "doc_id", "left").select("doc_id", "english", "nodes", "weights", "grade"), "reading")
    mean = nodes.filter("english").agg(F.avg("grade")).first()[0]
    if mean is None:
        return documents.sparkSession.createDataFrame([], "doc_id long, difficulty double, level int")
    judged = _exact(nodes, mean) if exact else _bucketed(nodes, mean)
    place = F.least(F.lit(BINS - 1), F.floor((F.col("difficulty") - 1) / (LEVELS - 1) * BINS)).cast("int")
    graded = judged.filter("english AND grade IS NOT NULL").groupBy(place.alias("bin"), F.floor(F.col("grade") + 0.5).cast("int").alias("level")).count().collect()
    table = np.zeros((LEVELS + 1, BINS))
    for r in graded:
        table[r["level"], max(0, r["bin"])] += r["count"]
    cuts = [1 + _cut(table[:k].sum(axis=0), table[k:].sum(axis=0)) * (LEVELS - 1) / BINS for k in range(2, LEVELS + 1)]
    level = sum((F.when(F.col("difficulty") >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(1))
    return judged.select("doc_id", "difficulty", level.cast("int").alias("level"))


def found(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id): English documents of the hardest level."""
    return levels(documents, labels).filter(F.col("level") == LEVELS).select("doc_id").distinct()
