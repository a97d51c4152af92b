"""Writers: exports, appended logs, and results with a manifest that proves them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_pending(queue: DataFrame, path: str) -> None:
    """Pending pairs as CSV with a header, by ticker and domain."""
    cols = ["id", "url", "domain", "company", "ticker", "source", "pub_date", "title"]
    queue.filter("status = 'pending'").select(*cols).orderBy("ticker", "domain", "id").write.mode("overwrite").option("header", True).csv(path)


def append_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("header", True).csv(path)


def class_lists(rows: DataFrame, path: str) -> None:
    """A CSV folder per class, for hand-over."""
    rows.write.mode("overwrite").partitionBy("match_class").option("header", True).csv(path)


def digest(df: DataFrame) -> DataFrame:
    """One row (rows, digest): the same for the same rows in any order, different if any value differs."""
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in sorted(df.columns)])
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest"))


def write_with_manifest(df: DataFrame, path: str) -> dict:
    """Writes parquet, reads it back, and stores counts, digest and schema beside it; refuses a write that reads back otherwise."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/data")
    want, got = digest(df).first().asDict(), digest(spark.read.parquet(f"{path}/data")).first().asDict()
    if want != got:
        raise RuntimeError(f"written {want}, read {got}")
    manifest = got | {"schema": df.schema.json()}
    spark.createDataFrame([manifest]).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return manifest
