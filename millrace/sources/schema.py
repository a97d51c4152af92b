"""Schemas of the pipeline's tables and the steps that bring older ones up to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = {
    "discovered_urls": "id long, url string, domain string, company string, ticker string, source string, discovered_at string, pub_date string, title string, status string, fetch_status_code int, match_class string, match_reason string, query string",
    "discovery_progress": "ticker string, domain string, start_date date, end_date date, completed_at timestamp, inserted_count long",
    "articles": "id long, ticker string, company string, gics_sector string, gics_sub_industry string, title string, author string, pub_date string, body_text string, word_count int, language string, source_domain string, extraction_method string, fetch_status string, http_status_code int, fetched_at timestamp, prev_fetch_status string",
    "sitemap_entries": "domain string, url string, lastmod string, title string, first_seen timestamp, last_seen timestamp",
    "sitemap_crawls": "domain string, started_at timestamp, finished_at timestamp, complete boolean, range_start date, signature string, entries long, failures long",
    "universe_membership": "symbol string, security string, gics_sector string, gics_sub_industry string, hq_location string, date_added string, cik string, founded string, valid_from date, valid_to date, source string, gics_revision_id string, gics_revision_timestamp string",
}

#: fixed values: what a column that an older table lacks is filled with; columns that are gone
DEFAULTS = {"discovered_urls": {"match_class": "accept", "status": "pending"}, "discovery_progress": {"inserted_count": 0}}
DROPPED = {"articles": ("sector",)}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])


def table_or_empty(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stored table, or an empty one of its schema where none is stored yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return evolve(spark.read.parquet(path.toString()), name) if there else empty(spark, name)


def evolve(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the columns of today's schema in order: missing ones are added, dropped ones left out, others kept behind."""
    target = df.sparkSession.createDataFrame([], TABLES[name]).schema
    fill = DEFAULTS.get(name, {})
    cols = [F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(fill.get(f.name)).cast(f.dataType).alias(f.name) for f in target]
    extra = [c for c in df.columns if c not in target.names and c not in DROPPED.get(name, ())]
    return df.select(*cols, *extra)


def violations(queue: DataFrame) -> DataFrame:
    """(problem, n): rows that the queue's rules don't allow."""
    classes = F.coalesce(F.col("match_class").isin("accept", "review", "reject"), F.lit(False))
    return queue.select(F.inline(F.array(
        F.struct(F.lit("match_class").alias("problem"), (~classes).alias("bad")), F.struct(F.lit("no url").alias("problem"), F.col("url").isNull().alias("bad")), F.struct(F.lit("no ticker").alias("problem"), F.col("ticker").isNull().alias("bad")),
    ))).groupBy("problem").agg(F.count_if("bad").alias("n"))
