"""Registered queries of the training-text operators, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import leakage, mainbody, packing, quality, reading, repeated, residue
from millrace.llm.lines import headlines_of
from millrace.session import materialize
from millrace.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def _p1_found(s: SparkSession, d: str) -> DataFrame:
    return repeated.repeated_lines(table(s, d, "articles"))


def _p1_clean_bodies(s: SparkSession, d: str) -> DataFrame:
    articles = table(s, d, "articles")
    return repeated.clean_bodies(articles, repeated.repeated_lines(articles))


def _p1_stretches(s: SparkSession, d: str) -> DataFrame:
    return repeated.stretches(table(s, d, "articles"))


def _p3_found(s: SparkSession, d: str) -> DataFrame:
    return residue.found(table(s, d, "articles"))


def _p4_found(s: SparkSession, d: str) -> DataFrame:
    articles = table(s, d, "articles")
    rows = materialize(residue.labels(articles, mainbody.reader(headlines_of(articles)), "other array<int>"), "labels")
    return mainbody.found(rows, residue.excluded(rows, articles).select("id"))


def _p4_main_bodies(s: SparkSession, d: str) -> DataFrame:
    articles = table(s, d, "articles")
    return mainbody.main_bodies(articles, headlines_of(articles))


def _p5_found(s: SparkSession, d: str) -> DataFrame:
    articles = table(s, d, "articles")
    rows = materialize(residue.labels(articles, quality.reader, "prose boolean"), "labels")
    return quality.found(articles, rows, residue.excluded(rows, articles).select("id"))


def _p5_word_counts(s: SparkSession, d: str) -> DataFrame:
    return quality.wrong_counts(table(s, d, "articles"))


def _p5_statistics(s: SparkSession, d: str) -> DataFrame:
    return quality.text_statistics(table(s, d, "articles"))


def _p8_containers(s: SparkSession, d: str) -> DataFrame:
    return packing.pack(packing.token_counts(table(s, d, "documents")), table(s, d, "pack_targets"))


def _p8_fill(s: SparkSession, d: str) -> DataFrame:
    return packing.fill(_p8_containers(s, d), table(s, d, "pack_targets"))


def _p9_found(s: SparkSession, d: str) -> DataFrame:
    return leakage.found(table(s, d, "documents"), table(s, d, "eval_items"))


def _p9_passages(s: SparkSession, d: str) -> DataFrame:
    return leakage.passages(table(s, d, "documents"), table(s, d, "eval_items"))


def _p10_found(s: SparkSession, d: str) -> DataFrame:
    return reading.found(table(s, d, "documents"), table(s, d, "reading_labels"))


def _p10_levels(s: SparkSession, d: str) -> DataFrame:
    return reading.levels(table(s, d, "documents"), table(s, d, "reading_labels"), every=True)


def queries() -> dict[str, Query]:
    return {
        "p1_found": _p1_found,
        "p1_clean_bodies": _p1_clean_bodies,
        "p1_stretches": _p1_stretches,
        "p3_found": _p3_found,
        "p4_found": _p4_found,
        "p4_main_bodies": _p4_main_bodies,
        "p5_found": _p5_found,
        "p5_word_counts": _p5_word_counts,
        "p5_statistics": _p5_statistics,
        "p8_containers": _p8_containers,
        "p8_fill": _p8_fill,
        "p9_found": _p9_found,
        "p9_passages": _p9_passages,
        "p10_found": _p10_found,
        "p10_levels": _p10_levels,
    }


def _grams(table: str, key: str, text: str) -> str:
    """SQL of the runs of 13 words of each text."""
    words = f"list_filter(regexp_split_to_array(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}\\s]', '', 'g'), '\\s+'), lambda x: x <> '')"
    return f"SELECT DISTINCT {key}, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT {key}, {words} AS w FROM {table} WHERE {text} IS NOT NULL), unnest(range(1, len(w) - 11)) AS t(k)"


#: lines of every body, numbered from 1, with their letters alone in lower case
_LINES = """
lines AS (
  SELECT id, source_domain, n AS line_no, regexp_replace(lower(parts[n]), '[^\\p{L}]', '', 'g') AS letters
  FROM (SELECT id, source_domain, string_split(body_text, chr(10)) AS parts FROM articles WHERE body_text IS NOT NULL), unnest(range(1, len(parts) + 1)) AS t(n))
"""


_REPEATED = f"""
{_LINES}, often AS (
  SELECT source_domain, letters FROM lines WHERE length(letters) >= 12 GROUP BY ALL HAVING count(DISTINCT id) >= 5),
found AS (SELECT DISTINCT id, CAST(line_no AS INTEGER) AS line_no FROM lines JOIN often USING (source_domain, letters))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"WITH {_REPEATED} SELECT * FROM found",
        "p1_clean_bodies": f"""
WITH {_REPEATED}, cuts AS (SELECT id, list(line_no) AS c FROM found GROUP BY id)
SELECT a.id, CASE WHEN c IS NULL THEN body_text ELSE array_to_string(list_filter(string_split(body_text, chr(10)), lambda x, i: NOT list_contains(c, CAST(i AS INTEGER))), chr(10)) END AS clean_text
FROM articles a LEFT JOIN cuts ON cuts.id = a.id
""",
        "p5_word_counts": "SELECT id, len(list_filter(regexp_split_to_array(body_text, '[\\s\\x0b\\x1c-\\x1f\\x85\\x{00a0}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{3000}]+'), lambda w: w <> '')) AS n_words FROM articles WHERE word_count IS NOT NULL AND body_text IS NOT NULL AND n_words <> word_count",
        "p9_found": f"SELECT DISTINCT d.doc_id, i.item_id FROM ({_grams('documents', 'doc_id', 'text')}) d JOIN ({_grams('eval_items', 'item_id', 'item_text')}) i USING (g)",
    }
