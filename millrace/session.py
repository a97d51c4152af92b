"""Session defaults and the one place that writes intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "millrace", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings every query expects (UTC, AQE, Arrow)."""
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    ship(session)
    return session


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package, from wherever the driver was started.

    On one machine its folder joins the workers' path; on a cluster the package is sent along, once a session.
    """
    context, root = spark.sparkContext, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in context.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
        if not context.master.startswith("local"):
            archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace"), "zip", root, "millrace")
            context.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    On a cluster this is ``spark.checkpoint.dir``; only where the session leaves it unset
    (tests, one machine) a temporary folder is made and set as the checkpoint directory.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isDefined():
            return found.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
    return base


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage with files that outlive an executor, so a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_cleared: set[str] = set()


def work_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables in the shared folder; it is deleted when the driver's process ends."""
    path = f"{shared_dir(spark).rstrip('/')}/millrace/{spark.sparkContext.applicationId}"
    if path not in _cleared:
        _cleared.add(path)
        atexit.register(_clear_quietly, spark, path)
    return path


def _clear_quietly(spark: SparkSession, path: str) -> None:
    try:
        _delete(spark, path)
    except Exception:  # the session may be gone by then
        pass


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear_materialized(spark: SparkSession) -> None:
    """Deletes this application's intermediate tables before its end: for when no DataFrame that reads one is used any more."""
    _delete(spark, work_dir(spark))


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no further than that."""
    return df.limit(max_rows + 1).count() <= max_rows
