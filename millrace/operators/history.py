"""Problem 6: full histories of changing attributes, kept by rebuilding affected chains.

A chain is all versions of one symbol. Late or corrected captures never patch intervals: the
symbols they touch are found, only those symbols' raw rows are read again, their chains are
built anew, and the store swaps the buckets of these chains at once (new files beside the old ones, then one rename).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.store import BucketStore
from millrace.session import materialize, work_dir

LABELS = ("security", "gics_sector", "gics_sub_industry")
OPEN_END = "9999-12-31"


def _norm(label: str) -> Column:
    """A label with case and blanks at the ends ignored; null stays null."""
    return F.lower(F.trim(F.col(label)))


def _sym(df: DataFrame) -> DataFrame:
    return df.withColumn("symbol", F.upper(F.trim("symbol"))).filter(F.col("symbol").isNotNull())


def calendar(snapshots: DataFrame) -> DataFrame:
    """The snapshot dates of the whole table with the date of the next: (snapshot_date, next_date), a row per date."""
    days = snapshots.select("snapshot_date").filter(F.col("snapshot_date").isNotNull()).distinct()
    # a row per capture date: the one window here is over dates, not over data
    return days.withColumn("next_date", F.lead("snapshot_date").over(Window.orderBy("snapshot_date")))


def snapshot_chains(snapshots: DataFrame, dates: DataFrame) -> DataFrame:
    """Versions (symbol, labels.., valid_from, valid_to) from periodic snapshots.

    Per symbol and date the latest capture counts (of equal captures, the greatest row); a null label
    keeps the value before it; a version ends the day before the first later date of ``dates`` that
    shows another or lacks the symbol; an absence always starts a new version. ``valid_to`` null is open.
    """
    rows = _sym(snapshots).filter(F.col("snapshot_date").isNotNull()).select("symbol", "snapshot_date", "captured_at", *LABELS)
    # groupBy with a struct maximum combines before the shuffle, so repeats and corrections of a hot symbol stay cheap
    latest = rows.groupBy("symbol", "snapshot_date").agg(F.max(F.struct(F.coalesce(F.unix_micros("captured_at"), F.lit(-(1 << 62))).alias("at"), *LABELS)).alias("r"))
    one = latest.select("symbol", "snapshot_date", *[F.col(f"r.{x}").alias(x) for x in LABELS])
    line = Window.partitionBy("symbol").orderBy("snapshot_date")
    filled = one.withColumns({x: F.last(x, ignorenulls=True).over(line) for x in LABELS})
    dated = filled.join(F.broadcast(dates), "snapshot_date")
    key = F.struct(*[_norm(x) for x in LABELS])
    dated = dated.withColumn("_key", key)
    # the successor date must be the symbol's own next row, else the symbol was absent in between
    starts = F.lag("_key").over(line).isNull() | ~F.lag("_key").over(line).eqNullSafe(F.col("_key")) | ~F.lag("next_date").over(line).eqNullSafe(F.col("snapshot_date"))
    run = dated.withColumn("_run", F.sum(starts.cast("int")).over(line))
    agg = [F.min_by(x, "snapshot_date").alias(x) for x in LABELS]
    chains = run.groupBy("symbol", "_run").agg(*agg, F.min("snapshot_date").alias("valid_from"), F.max_by("next_date", "snapshot_date").alias("_next"))
    return chains.select("symbol", *LABELS, "valid_from", F.date_sub("_next", 1).alias("valid_to"))


def touched_symbols(chains: DataFrame, old_dates: DataFrame, updates: DataFrame) -> DataFrame:
    """Symbols whose chain an update can change: those it has rows of, and, if it brings a date
    not seen before, all whose versions run on past or up to that date (they are now absent there)."""
    own = _sym(updates).select("symbol").distinct()
    new = updates.select("snapshot_date").filter(F.col("snapshot_date").isNotNull()).distinct().join(old_dates, "snapshot_date", "left_anti")
    first = new.agg(F.min("snapshot_date").alias("_first"))
    across = chains.join(F.broadcast(first), F.col("_first").isNotNull() & (F.coalesce("valid_to", F.lit(OPEN_END).cast("date")) >= F.col("_first")), "left_semi").select("symbol")
    return own.unionByName(across).distinct()


def rebuild_affected(chains: DataFrame, raw: DataFrame, updates: DataFrame) -> DataFrame:
    """``chains`` after ``updates``: touched chains built again from all their raw rows, the rest as they are.

    ``raw`` is what ``chains`` was built from. The result equals a build from ``raw`` and ``updates`` together.
    """
    every = raw.unionByName(updates)
    touched = touched_symbols(chains, calendar(raw).select("snapshot_date"), updates)
    again = _sym(every).join(touched, "symbol", "left_semi")
    rebuilt = snapshot_chains(again, calendar(every))
    kept = chains.join(touched, "symbol", "left_anti")
    return kept.unionByName(rebuilt)


def update_store(store: BucketStore, raw: DataFrame, updates: DataFrame) -> int:
    """Brings the chains in ``store``, built from ``raw``, up to ``updates``: only buckets of touched symbols are written, all swapped at once."""
    every = raw.unionByName(updates)
    chains = store.read()
    touched = materialize(touched_symbols(chains, calendar(raw).select("snapshot_date"), updates), "touched")
    buckets = store.touched(touched)
    if not buckets:
        return store.generation()
    rebuilt = snapshot_chains(_sym(every).join(touched, "symbol", "left_semi"), calendar(every))
    kept = store.read(buckets).join(touched, "symbol", "left_anti")
    return store.swap(kept.unionByName(rebuilt), buckets)


def stored_chains(membership: DataFrame) -> DataFrame:
    """Versions from stored rows: in order of ``valid_from`` per symbol, a row ends at its ``valid_to`` or the day
    before the next row; repeats and rows left without a day are dropped; rows with equal labels and no day
    between them are one version. Rows without symbol or ``valid_from`` are left out.
    """
    rows = _sym(membership).filter(F.col("valid_from").isNotNull()).select("symbol", *LABELS, "valid_from", "valid_to")
    rows = rows.withColumn("_key", F.struct(*[_norm(x) for x in LABELS])).dropDuplicates(["symbol", "_key", "valid_from", "valid_to"])
    last = F.lit(OPEN_END).cast("date")
    line = Window.partitionBy("symbol").orderBy("valid_from", F.coalesce("valid_to", last), "_key")
    cut = rows.withColumn("_end", F.least(F.coalesce("valid_to", last), F.coalesce(F.date_sub(F.lead("valid_from").over(line), 1), last)))
    cut = cut.filter(F.col("_end") >= F.col("valid_from"))
    joins = F.lag("_key").over(line).eqNullSafe(F.col("_key")) & (F.date_add(F.lag("_end").over(line), 1) == F.col("valid_from"))
    run = cut.withColumn("_run", F.sum((~F.coalesce(joins, F.lit(False))).cast("int")).over(line))
    agg = [F.min_by(x, "valid_from").alias(x) for x in LABELS]
    chains = run.groupBy("symbol", "_run").agg(*agg, F.min("valid_from").alias("valid_from"), F.max("_end").alias("_end"))
    return chains.select("symbol", *LABELS, "valid_from", F.when(F.col("_end") < last, F.col("_end")).alias("valid_to"))


def _spread(chains: DataFrame, origin: str) -> DataFrame:
    return chains.select(F.lit(origin).alias("origin"), "symbol", *LABELS, F.col("valid_from").cast("string").alias("valid_from"), F.coalesce(F.col("valid_to").cast("string"), F.lit(OPEN_END)).alias("valid_to"))


def versions(snapshots: DataFrame, membership: DataFrame) -> DataFrame:
    """(origin, symbol, labels.., valid_from, valid_to) of both tables.

    Captures taken in time (within a day of their date, each symbol's and date's first) make the chains of a store in the
    shared folder; all others arrive as late or corrected updates, rebuild the chains they touch there and replace these at once.
    """
    mark = F.col("captured_at") >= F.date_add("snapshot_date", 1).cast("timestamp")
    cols = ["symbol", "snapshot_date", "captured_at", *LABELS]
    flagged = snapshots.select(*cols, F.coalesce(mark, F.lit(False)).alias("_late"))
    base, late = flagged.filter(~F.col("_late")).drop("_late"), flagged.filter("_late").drop("_late")
    spark = snapshots.sparkSession
    store = BucketStore(spark, f"{work_dir(spark)}/chains-{uuid.uuid4().hex}", ["symbol"])
    store.replace(snapshot_chains(base, calendar(base)))
    update_store(store, base, late)
    return _spread(store.read(), "snapshots").unionByName(_spread(stored_chains(membership), "stored"))


def found(snapshots: DataFrame, membership: DataFrame) -> DataFrame:
    """(origin, symbol, valid_from, valid_to)."""
    return versions(snapshots, membership).select("origin", "symbol", "valid_from", "valid_to").distinct()
