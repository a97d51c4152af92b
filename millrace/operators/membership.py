"""Point-in-time membership: as-of lists, rebuilt stints, differences of snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import small_enough

#: Names, or revisions of one page, that may be broadcast and searched without a key.
SEARCHED_ROWS = 100_000


def in_force(day: Column) -> Column:
    return (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") >= day))


def as_of(membership: DataFrame, day: str) -> DataFrame:
    """Distinct (symbol, security, gics_sector) in force on ``day``, both ends included."""
    return membership.filter(in_force(F.lit(day).cast("date"))).select("symbol", "security", "gics_sector").distinct()


def members_on(membership: DataFrame, days: DataFrame) -> DataFrame:
    """(day, members): symbols in force on each of ``days`` (day), from starts and ends alone.

    Overlapping rows of a symbol count once: its rows are first joined to stints without a gap.
    """
    last = F.lit("9999-12-31").cast("date")
    rows = membership.filter("symbol IS NOT NULL AND valid_from IS NOT NULL").select("symbol", "valid_from", F.coalesce("valid_to", last).alias("end")).filter("end >= valid_from").distinct()
    line = Window.partitionBy("symbol").orderBy("valid_from", "end")
    so_far = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    starts = so_far.isNull() | (F.col("valid_from") > so_far)
    stints = rows.withColumn("s", F.sum(starts.cast("int")).over(line)).groupBy("symbol", "s").agg(F.min("valid_from").alias("a"), F.max("end").alias("b"))
    moves = stints.select(F.col("a").alias("day"), F.lit(1).alias("d")).unionByName(stints.filter(F.col("b") < last).select(F.date_add("b", 1).alias("day"), F.lit(-1).alias("d")))
    steps = moves.groupBy("day").agg(F.sum("d").alias("d"))
    asked = days.select("day").distinct().withColumn("d", F.lit(0)).withColumn("q", F.lit(1))
    every = steps.withColumn("q", F.lit(0)).unionByName(asked)
    # one row per day with a move: days are few whatever the number of symbols
    run = every.withColumn("members", F.sum("d").over(Window.orderBy("day", "q").rowsBetween(Window.unboundedPreceding, 0)))
    return run.filter("q = 1").select("day", F.col("members").cast("long").alias("members"))


def closed_targets(membership: DataFrame, cutoff: str) -> DataFrame:
    """Stints that ended on or after ``cutoff``, have a cik, and whose cik has no open stint."""
    still = membership.filter("valid_to IS NULL AND cik IS NOT NULL").select("cik").distinct()
    return membership.filter((F.col("valid_to") >= F.lit(cutoff).cast("date")) & F.col("cik").isNotNull()).join(still, "cik", "left_anti").select("symbol", "cik", "valid_from", "valid_to").distinct()


def snapshot_changes(snapshots: DataFrame) -> DataFrame:
    """(snapshot_date, symbol, change): who joined and left from each snapshot to the next; nobody joins on the first."""
    seen = snapshots.filter("symbol IS NOT NULL AND snapshot_date IS NOT NULL").select(F.upper(F.trim("symbol")).alias("symbol"), "snapshot_date").distinct()
    days = seen.select("snapshot_date").distinct()
    order = Window.orderBy("snapshot_date")
    days = days.select("snapshot_date", F.lag("snapshot_date").over(order).alias("before"), F.lead("snapshot_date").over(order).alias("after"))
    own = Window.partitionBy("symbol").orderBy("snapshot_date")
    rows = seen.join(F.broadcast(days), "snapshot_date").withColumns({"prev": F.lag("snapshot_date").over(own), "next": F.lead("snapshot_date").over(own)})
    joined = rows.filter(F.col("before").isNotNull() & ~F.col("prev").eqNullSafe(F.col("before"))).select("snapshot_date", "symbol", F.lit("joined").alias("change"))
    left = rows.filter(F.col("after").isNotNull() & ~F.col("next").eqNullSafe(F.col("after"))).select(F.col("after").alias("snapshot_date"), "symbol", F.lit("left").alias("change"))
    return joined.unionByName(left)


def stints_from_changes(changes: DataFrame, roster: DataFrame, earliest: str) -> DataFrame:
    """(symbol, valid_from, valid_to) from a log of ``changes`` (effective_date, symbol, kind, ordinal) and today's ``roster``.

    Read from the newest change back, an add closes the stint that runs on from it and a remove opens one that
    ended the day before; an add without an open stint and a remove within one are passed over. A
    stint without an add starts at ``earliest`` or its ``date_added``, whichever is later, but not after its end.
    """
    now = roster.select("symbol", F.col("date_added").alias("_added")).dropDuplicates(["symbol"])
    seed = now.select("symbol", F.lit(None).cast("date").alias("effective_date"), F.lit("remove").alias("kind"), F.lit(-1).cast("long").alias("ordinal"), F.lit(0).alias("age"))
    log = changes.filter("symbol IS NOT NULL AND effective_date IS NOT NULL").select("symbol", "effective_date", "kind", F.col("ordinal").cast("long"), F.lit(1).alias("age"))
    back = Window.partitionBy("symbol").orderBy("age", F.col("effective_date").desc(), "ordinal", F.when(F.col("kind") == "add", 0).otherwise(1))
    # kinds must alternate, beginning with an opening one: a repeated kind is passed over
    kept = seed.unionByName(log).withColumn("_before", F.lag("kind", 1, "add").over(back)).filter(F.col("kind") != F.col("_before"))
    paired = kept.withColumns({"_kind2": F.lead("kind").over(back), "_start": F.lead("effective_date").over(back)}).filter("kind = 'remove'")
    end = F.when(F.col("age") == 0, F.lit(None)).otherwise(F.date_sub("effective_date", 1))
    rows = paired.join(now, "symbol", "left").select("symbol", F.when(F.col("_kind2") == "add", F.col("_start")).alias("_start"), end.alias("valid_to"), "_added")
    fallback = F.least(F.greatest(F.lit(earliest).cast("date"), F.coalesce("_added", F.lit(earliest).cast("date"))), F.coalesce("valid_to", F.lit("9999-12-31").cast("date")))
    return rows.select("symbol", F.coalesce("_start", fallback).alias("valid_from"), "valid_to")


def resolve(names: DataFrame, asked: DataFrame) -> DataFrame:
    """(query, symbol): a query is a symbol without regard to case, else part of a name; of several, the least symbol.

    Parts are looked up by their first three letters among all runs of up to three letters of the names.
    """
    q = asked.select("query", F.lower("query").alias("_q")).filter("_q <> ''").distinct()
    exact = q.join(names, F.col("_q") == F.lower("symbol")).select("query", F.lit(0).alias("r"), "symbol")
    low = names.filter("security <> ''").select("symbol", F.lower("security").alias("_name")).distinct()
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.length("_name")), lambda i: F.transform(F.array(*map(F.lit, (1, 2, 3))), lambda n: F.substr("_name", i, n))))
    grams = low.select("symbol", "_name", F.explode(F.array_distinct(runs)).alias("_g"))
    part = q.withColumn("_g", F.substring("_q", 1, 3)).join(grams, "_g").filter(F.col("_name").contains(F.col("_q"))).select("query", F.lit(1).alias("r"), "symbol")
    return exact.unionByName(part).groupBy("query").agg(F.min(F.struct("r", "symbol")).alias("b")).select("query", "b.symbol")


def spans(membership: DataFrame, symbols: DataFrame) -> DataFrame:
    """(symbol, stints): all stints of the asked symbols, oldest first, each once."""
    rows = membership.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    return rows.groupBy("symbol").agg(F.array_sort(F.collect_set(F.struct("valid_from", "valid_to"))).alias("stints"))


def names(asked: DataFrame, today: DataFrame, membership: DataFrame, day: str) -> DataFrame:
    """(ticker, name): of today's list (symbol, security) first, else of the list in force on ``day``; null where neither has it."""
    now = today.groupBy(F.col("symbol").alias("ticker")).agg(F.min("security").alias("_now"))
    then = as_of(membership, day).groupBy(F.col("symbol").alias("ticker")).agg(F.min("security").alias("_then"))
    return asked.select("ticker").distinct().join(now, "ticker", "left").join(then, "ticker", "left").select("ticker", F.coalesce("_now", "_then").alias("name"))


def label_stability(revisions: DataFrame, days: int = 30) -> DataFrame:
    """(symbol, cik, ts, same): each revision row's label against the newest row of its symbol and cik at least ``days`` older.

    ``revisions`` is (ts, symbol, cik, label); ``same`` is null without an older row. One window per symbol and cik.
    """
    line = Window.partitionBy("symbol", "cik").orderBy(F.unix_micros("ts")).rangeBetween(Window.unboundedPreceding, -days * 86_400_000_000)
    older = F.max(F.struct("ts", "label")).over(line)
    return revisions.withColumn("_o", older).select("symbol", "cik", "ts", F.when(F.col("_o").isNotNull(), F.col("_o.label").eqNullSafe(F.col("label"))).alias("same"))


def last_revision(stints: DataFrame, revisions: DataFrame) -> DataFrame:
    """For each stint (symbol, cik, valid_from, valid_to) the newest revision row with its symbol and cik up to the end of its last day.

    ``revisions`` is (revid, ts, symbol, cik, gics_sector); a stint without one has nulls; ``depth`` counts newer
    revisions in its time that don't list it.
    """
    times = revisions.select("revid", "ts").distinct()
    if not small_enough(times, SEARCHED_ROWS):
        raise ValueError("the revisions of a page are a bounded list")
    order = Window.orderBy("ts", "revid")
    ranked = times.withColumn("_rank", F.row_number().over(order))
    # revisions up to each day that a stint ends on: sums over days, of which a calendar has some thousands
    daily = times.groupBy(F.to_date("ts").alias("_day")).agg(F.count("*").alias("_n")).unionByName(stints.select(F.col("valid_to").alias("_day"), F.lit(0).cast("long").alias("_n")).distinct())
    upto = daily.groupBy("_day").agg(F.sum("_n").alias("_n")).select(F.col("_day").alias("valid_to"), F.sum("_n").over(Window.orderBy("_day")).alias("_upto"))
    keys = ["symbol", "cik", "valid_from", "valid_to"]
    own = revisions.select("symbol", "cik", "revid").distinct().join(F.broadcast(ranked), "revid")
    inside = (F.to_date("ts") <= F.col("valid_to")) & (F.to_date("ts") >= F.col("valid_from"))
    best = stints.select(*keys).join(own, ["symbol", "cik"]).filter(inside).groupBy(*keys).agg(F.max(F.struct("_rank", "revid")).alias("b"))
    newer = best.join(F.broadcast(upto), "valid_to").select(*keys, F.col("b.revid").alias("revid"), (F.col("_upto") - F.col("b._rank")).alias("depth"))
    return stints.join(newer, keys, "left").select(*keys, "revid", "depth")


def close_intervals(stored: DataFrame, symbols: DataFrame, last_day: str) -> DataFrame:
    """``stored`` with the open rows of ``symbols`` (symbol) ended on ``last_day``."""
    gone = symbols.select("symbol").distinct().withColumn("_gone", F.lit(True))
    end = F.when(F.col("_gone") & F.col("valid_to").isNull(), F.lit(last_day).cast("date")).otherwise(F.col("valid_to"))
    return stored.join(gone, "symbol", "left").select(*[end.alias(c) if c == "valid_to" else F.col(c) for c in stored.columns])


def record_snapshot(stored: DataFrame, roster: DataFrame, today: str, source: str = "snapshot") -> DataFrame:
    """``stored`` after today's ``roster``: rows of symbols that left end yesterday, symbols that are new get a row open from today.

    ``roster`` may lack columns of ``stored``; of several rows of a symbol the least counts. Recording a day twice changes nothing.
    """
    now = roster.filter("symbol IS NOT NULL").dropDuplicates(["symbol"])
    open_ = stored.filter("valid_to IS NULL").select("symbol").distinct()
    yesterday = F.date_sub(F.lit(today).cast("date"), 1)
    gone = open_.join(now.select("symbol"), "symbol", "left_anti").withColumn("_gone", F.lit(True))
    end = F.when(F.col("_gone") & F.col("valid_to").isNull(), yesterday).otherwise(F.col("valid_to"))
    kept = stored.join(gone, "symbol", "left").select(*[end.alias(c) if c == "valid_to" else F.col(c) for c in stored.columns])
    fixed = {"valid_from": F.lit(today).cast("date"), "valid_to": F.lit(None).cast("date"), "source": F.lit(source)}
    kinds = dict(stored.dtypes)
    fresh = now.join(open_, "symbol", "left_anti").select(*[(fixed[c] if c in fixed else F.col(c) if c in now.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in stored.columns])
    return kept.unionByName(fresh)


def backfilled(stored: DataFrame, built: DataFrame, source: str, force: bool = False) -> DataFrame:
    """``stored`` with the rows of ``source`` built anew; as it is where it has such rows already, unless ``force``."""
    if not force and not stored.filter(F.col("source") == source).isEmpty():
        return stored
    kinds = dict(stored.dtypes)
    rows = built.select(*[(F.lit(source) if c == "source" else F.col(c) if c in built.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in stored.columns])
    return stored.filter(~F.col("source").eqNullSafe(F.lit(source))).unionByName(rows)


def relabelled(stored: DataFrame, updates: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``stored`` with the ``columns`` of ``updates`` (symbol, valid_from, columns) where it has a row of that symbol and day; nulls of an update are written."""
    one = updates.select("symbol", "valid_from", *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_hit")).dropDuplicates(["symbol", "valid_from"])
    return stored.join(one, ["symbol", "valid_from"], "left").select(*[F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in stored.columns])


def coverage(stored: DataFrame, days: DataFrame) -> DataFrame:
    """(day, problem): whether a list can be given for a day: ``empty`` without rows, ``too early`` before the first, else null."""
    first = stored.agg(F.min("valid_from").alias("_first"))
    problem = F.when(F.col("_first").isNull(), "empty").when(F.col("day") < F.col("_first"), "too early")
    return days.select("day").distinct().join(F.broadcast(first)).select("day", problem.alias("problem"))


PUBLIC = ("symbol", "security", "gics_sector", "gics_sub_industry", "hq_location", "date_added", "cik", "founded", "valid_from", "valid_to", "source", "gics_revision_id")


def public(rows: DataFrame) -> DataFrame:
    """``rows`` in the public form of twelve columns; columns that an older table lacks are null."""
    return rows.select(*[F.col(c).cast("string").alias(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in PUBLIC])


def tracked(asked: DataFrame, membership: DataFrame) -> DataFrame:
    """(ticker, tracked): whether each asked ticker has an open row; blanks at the ends and case are ignored, null is not tracked."""
    own = membership.filter("valid_to IS NULL").select(F.upper(F.trim("symbol")).alias("_s")).distinct().withColumn("_t", F.lit(True))
    return asked.select("ticker").distinct().join(own, F.upper(F.trim("ticker")) == F.col("_s"), "left").select("ticker", F.coalesce("_t", F.lit(False)).alias("tracked"))


def chosen_stint(membership: DataFrame, floor: str) -> DataFrame:
    """(symbol, start, end): of the rows that end last the one that starts last, not before ``floor``; a symbol with an open row has no end."""
    last = F.coalesce("valid_to", F.lit("9999-12-31").cast("date"))
    best = membership.filter("symbol IS NOT NULL AND valid_from IS NOT NULL").groupBy("symbol").agg(F.max(F.struct(last.alias("e"), "valid_from", "valid_to")).alias("b"))
    return best.select("symbol", F.greatest("b.valid_from", F.lit(floor).cast("date")).alias("start"), F.col("b.valid_to").alias("end"))
