from pyspark.sql import functions as F

from millrace.operators.store import BucketStore
from millrace.streaming import ingest


def test_stream_merges_files_as_they_come(spark, small, tmp_path):
    from millrace.sources.tables import table

    rows = table(spark, small, "discovered_urls")
    source = f"{tmp_path}/in"
    store = BucketStore(spark, f"file://{tmp_path}/store", ["url", "ticker"])
    for part in range(2):
        rows.filter(F.col("id") % 2 == part).coalesce(1).write.mode("append").parquet(source)
        ingest.ingest(ingest.file_stream(spark, source), store, f"{tmp_path}/check").awaitTermination()
    assert store.generation() == 2
    got = store.read()
    assert got.count() == rows.select("url", "ticker").distinct().count()
    best = rows.groupBy("url", "ticker").agg(F.max(F.when(F.col("match_class") == "accept", 2).when(F.col("match_class") == "review", 1).otherwise(0)).alias("b"))
    from millrace.operators.queue import rank

    assert got.join(best, ["url", "ticker"]).filter(rank(F.col("match_class")) != F.col("b")).count() == 0


def test_event_windows_in_batch(spark, small):
    from millrace.sources.tables import table

    events = table(spark, small, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    assert ingest.event_counts(events).agg(F.sum("n")).first()[0] == events.count()
    assert ingest.sessions(events).agg(F.sum("n")).first()[0] == events.count()
