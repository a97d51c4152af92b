"""Incremental ingest: a stream of discovered pairs merged into a stored queue, and event-time counts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import queue
from millrace.operators.store import BucketStore
from millrace.session import materialize, work_dir


def merge_into(store: BucketStore, empty: DataFrame) -> Callable[[DataFrame, int], None]:
    """The batch function of a merging stream: only buckets of the batch's pairs are read and written. A batch seen twice changes nothing, since a merge only ever promotes."""

    def run(batch: DataFrame, epoch: int) -> None:
        rows = materialize(batch.withColumn("ordinal", F.col("id") if "id" in batch.columns else F.monotonically_increasing_id()), "batch")
        touched = store.touched(rows)
        if not touched:
            return
        known = store.generation() is not None
        stored = store.read(touched) if known else empty
        top = (store.read() if known else empty).agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
        store.swap(queue.merge(stored, rows, top), touched)

    return run


def file_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the parquet files in a folder, or of a single file."""
    schema = spark.read.parquet(path).schema
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        return reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    return reader.parquet(path)


def ingest(stream: DataFrame, store: BucketStore, checkpoint: str) -> StreamingQuery:
    """Merges all rows that are new in ``stream`` into ``store``, a generation per batch."""
    empty = stream.sparkSession.createDataFrame([], stream.schema)
    return stream.writeStream.foreachBatch(merge_into(store, empty)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def settle(stream: DataFrame, name: str) -> DataFrame:
    """Runs an aggregating stream over all input there is and gives its last state, written to the shared folder."""
    spark = stream.sparkSession
    base = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/state")

    stream.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/state")


def event_counts(events: DataFrame, late: str = "10 minutes", size: str = "5 minutes", step: str | None = None) -> DataFrame:
    """(started, event_type, n) per window of event time; events later than ``late`` are left out of a running stream."""
    w = F.window("ts", size, step) if step else F.window("ts", size)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("started"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(user_id, started, ended, n): runs of a user's events without a gap."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n")
