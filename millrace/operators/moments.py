"""Problem 7: timestamps of mixed notation and zone, as one UTC form.

Every value gets the array of all its valid readings (day and month either way round, either pass
of a repeated hour) with a cost for each; the chain of readings of a source, in its record order,
is chosen by Viterbi, where a change of the day-month order and a step back in time cost extra.
To contradict what a source declares (its date order, "first pass") costs ``DECLARED``, more than
any neighbours can offer.

A chain is as long as its source has records, and no task reads it whole: ranges of records are blocks, each block gives the cost
of the best way through it from every state before it to every state after it, these are put together along the source, a
row per block, and each block is then read with the states so found. The result is that of one pass over the whole chain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import timestamps as ts
from millrace.plans import once
from millrace.session import materialize, small_enough

#: Costs: of a change of order from one slash date to the next, of a step back in time (by days, up to BACK_MOST), of contradicting what the source declares.
SWITCH, BACK_DAY, BACK_MOST = 8.0, 0.02, 4.0
DECLARED = 2 * (SWITCH + BACK_MOST) + 1
#: Rows of sites (about 100 bytes each) that may be broadcast.
SITES_MOST = 100_000
#: Records of a block.
BLOCK = 1 << 16


def _abbreviations(sites: DataFrame) -> DataFrame:
    """(_zone, _abbr) of every time zone in use."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"_zone": pdf["time_zone"], "_abbr": [ts.zone_abbreviations(z) for z in pdf["time_zone"]]})

    return sites.select("time_zone").filter("time_zone IS NOT NULL").distinct().mapInPandas(run, "_zone string, _abbr map<string,int>")


def readings(df: DataFrame, sites: DataFrame, value: str = "value", domain: str = "domain", zone_utc: str | None = None) -> DataFrame:
    """``df`` with ``cands``, an array of ``struct(us, ord, cost)``: all valid readings of ``value``.

    ``sites`` (domain, time_zone, date_order) is one row per domain and fixed in size; it is broadcast
    only if it is small. ``zone_utc`` names a boolean column: true where text without a zone is UTC.
    A null, blank or unreadable value gives no row; a source that ``sites`` lacks is on UTC
    and declares no date order. ``ord`` is 1 for day first, 2 for month first, 0 for neither.
    """
    known = sites.select(F.col("domain").alias("_domain"), "time_zone", F.lower("date_order").alias("date_order")).dropDuplicates(["_domain"])
    known = known.join(_abbreviations(sites), F.col("time_zone") == F.col("_zone"), "left").drop("_zone")
    # a row per domain: joined by broadcast if it is as small as it should be, since rows per domain are skewed
    known = F.broadcast(known) if small_enough(sites, SITES_MOST) else known
    out = df.join(known, F.col(domain) == F.col("_domain"), "left").drop("_domain")
    out = once(out, _parts=F.split(ts.canon(F.col(value)), r"\|")).filter(F.col("_parts").isNotNull())
    p = ts.parts(F.col("_parts"))
    tz = F.when(F.col(zone_utc), F.lit("UTC")).otherwise(F.coalesce("time_zone", F.lit("UTC"))) if zone_utc else F.coalesce("time_zone", F.lit("UTC"))
    out = once(
        out, _fam=F.substring(p["family"], 2, 1), _y=ts._num(p["y"]), _a=ts._month(p["m"]), _b=ts._num(p["d"]), _clock=ts.clock_us(p), _zoned=p["zone"] != "",
        _epoch=F.when(F.substring(p["family"], 2, 1) == "e", ts.epoch_us(p)), _offset=ts.offset_minutes(p["zone"], F.col("_abbr")).cast("long"), _tz=tz,
    ).drop("_parts", "_abbr", "time_zone")
    slash = F.col("_fam") == "s"
    # slash dates: the first number is the day (1: dmy) or the month (2: mdy); all other families are year, month, day
    out = once(
        out, _l1=ts._days(F.col("_y"), F.when(slash, F.col("_b")).otherwise(F.col("_a")), F.when(slash, F.col("_a")).otherwise(F.col("_b"))) * F.lit(ts.DAY_US) + F.col("_clock"),
        _l2=F.when(slash, ts._days(F.col("_y"), F.col("_a"), F.col("_b")) * F.lit(ts.DAY_US) + F.col("_clock")),
    ).drop("_y", "_a", "_b", "_clock")

    def instant(local: Column) -> Column:
        return F.when(F.col("_zoned"), local - F.col("_offset") * F.lit(60_000_000)).when(F.col("_tz") == "UTC", local).otherwise(ts.zone_less_us(local, F.col("_tz")))

    out = once(out, _u1=instant(F.col("_l1")), _u2=instant(F.col("_l2")))

    def later(us: Column, local: Column) -> Column:
        return F.when(~F.col("_zoned") & (F.col("_tz") != "UTC"), ts.second_pass_us(us, local, F.col("_tz")))

    def reading(us: Column, order: Column, cost: Column) -> Column:
        return F.struct(us.alias("us"), order.cast("int").alias("ord"), cost.cast("double").alias("cost"))

    dmy, mdy = (F.coalesce(F.col("date_order") == x, F.lit(False)) for x in ("dmy", "mdy"))
    # a declared order that gives no date leaves no reading: the other order isn't what the source means
    ok1, ok2 = ~slash | ~mdy | F.col("_l2").isNotNull(), ~dmy | F.col("_l1").isNotNull()
    order1 = F.when(slash, F.lit(1)).otherwise(F.lit(0))
    cost1, cost2 = F.when(slash & mdy, F.lit(DECLARED)).otherwise(F.lit(0.0)), F.when(dmy, F.lit(DECLARED)).otherwise(F.lit(0.0))
    dated = F.array(
        reading(F.when(ok1, F.col("_u1")), order1, cost1), reading(F.when(ok1, later(F.col("_u1"), F.col("_l1"))), order1, cost1 + F.lit(DECLARED)),
        reading(F.when(ok2, F.col("_u2")), F.lit(2), cost2), reading(F.when(ok2, later(F.col("_u2"), F.col("_l2"))), F.lit(2), cost2 + F.lit(DECLARED)),
    )
    cands = F.when(F.col("_epoch").isNotNull(), F.array(reading(F.col("_epoch"), F.lit(0), F.lit(0.0)))).otherwise(dated)
    cands = once(out, _cands=F.filter(cands, lambda x: x["us"].isNotNull())).filter(F.size("_cands") > 0)
    return cands.select(*df.columns, F.col("_cands").alias("cands"))


START: dict[tuple[int, int | None], float] = {(0, None): 0.0}  # (order in use, its moment) -> cost


def _step(best: dict, u: list, o: list, c: list) -> tuple[dict, dict]:
    """The states after one more record, and for each the reading taken and the state before: a state is a reading with the order last used."""
    now: dict[tuple[int, int | None], float] = {}
    step: dict[tuple[int, int | None], tuple] = {}
    for (conv, last), so_far in best.items():
        for k, (uk, ok, ck) in enumerate(zip(u, o, c)):
            new = ok or conv
            total = so_far + ck + (SWITCH if ok and conv and ok != conv else 0.0)
            if last is not None and uk < last:
                total += min(BACK_MOST, (last - uk) / ts.DAY_US * BACK_DAY)
            state = (new, uk)
            if total < now.get(state, np.inf):
                now[state], step[state] = total, (k, (conv, last))
    return now, step


def _cheapest(best: dict) -> tuple:
    return min(best, key=lambda s: (best[s], s[0], s[1]))


def _viterbi(us: list, order: list, cost: list) -> list[int]:
    """Choice of a reading for each record of one chain."""
    best, back = START, []
    for u, o, c in zip(us, order, cost):
        best, step = _step(best, u, o, c)
        back.append(step)
    at = _cheapest(best)
    chosen = []
    for step in reversed(back):
        k, at = step[at]
        chosen.append(k)
    return chosen[::-1]


def _near(us0: np.ndarray, order: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Which records of a block take part: those with a choice or an order of their own, their neighbours, and both ends.

    The cost between two others is the same for every path.
    """
    event = many | (order != 0)
    near = event.copy()
    near[1:] |= event[:-1]
    near[:-1] |= event[1:]
    near[[0, -1]] = True
    return np.flatnonzero(near)


def _through(us: list, order: list, cost: list) -> list[tuple[int, int, int, int | None, float]]:
    """The cheapest ways through a block: (order before, reading of the first record, order after, moment of the last, cost).

    The step back to the first record isn't among the costs; it hangs on the block before.
    """
    ways: dict[tuple[int, int], dict] = {}
    for conv in (0, 1, 2):
        for k, (u, o, c) in enumerate(zip(us[0], order[0], cost[0])):
            ways[conv, k] = {(o or conv, u): c + (SWITCH if o and conv and o != conv else 0.0)}
    for i in range(1, len(us)):
        states = {s for best in ways.values() for s in best}
        if len(states) == 1:  # all ways have met: from here on they are one
            state = states.pop()
            paid = {e: best[state] for e, best in ways.items()}
            best = {state: 0.0}
            for j in range(i, len(us)):
                best, _ = _step(best, us[j], order[j], cost[j])
            return [(*e, *s, p + c) for e, p in paid.items() for s, c in best.items()]
        for e, best in ways.items():
            ways[e] = _step(best, us[i], order[i], cost[i])[0]
    return [(*e, *s, c) for e, best in ways.items() for s, c in best.items()]


def _between(us: list, order: list, cost: list, conv: int, first: int, end: tuple) -> list[int]:
    """Choice of a reading for each record of a block on its cheapest way from (``conv``, ``first``) to the state ``end``."""
    u, o, c = us[0][first], order[0][first], cost[0][first]
    best: dict = {(o or conv, u): c}
    back: list[dict] = []
    chosen = [first]

    def follow(at: tuple) -> None:
        picked = []
        for step in reversed(back):
            k, at = step[at]
            picked.append(k)
        chosen.extend(reversed(picked))
        back.clear()

    for i in range(1, len(us)):
        best, step = _step(best, us[i], order[i], cost[i])
        back.append(step)
        if len(best) == 1:
            follow(next(iter(best)))
    if back:
        follow(end)
    return chosen


def _stitch(blocks: list[tuple]) -> list[tuple]:
    """Of (first moments, ways) of the blocks of one source in order: for each block the (order before, first reading, state after) of the cheapest chain."""
    best, back = START, []
    for first, ways in blocks:
        now: dict[tuple, float] = {}
        step: dict[tuple, tuple] = {}
        for (conv, last), so_far in best.items():
            for before, k, after, end, cost in ways:
                if before != conv:
                    continue
                total = so_far + cost
                if last is not None and first[k] < last:
                    total += min(BACK_MOST, (last - first[k]) / ts.DAY_US * BACK_DAY)
                state = (after, end)
                if total < now.get(state, np.inf):
                    now[state], step[state] = total, ((conv, last), k)
        best = now
        back.append(step)
    at = _cheapest(best)
    out = []
    for step in reversed(back):
        before, k = step[at]
        out.append((before[0], k, at))
        at = before
    return out[::-1]


_KEY = "_source long, _at0 long, _tie0 long, _no int"


def _blocks(names: list[str]):
    """Packs the records of a sorted partition into a row per block: the candidates of those that take part, and the columns of those with a choice."""

    def packed(key: tuple, pdfs: list[pd.DataFrame]) -> pd.DataFrame:
        pdf = pd.concat(pdfs, ignore_index=True) if len(pdfs) > 1 else pdfs[0]
        many = pdf["_us"].notna().to_numpy()
        us0, order = pdf["_us0"].to_numpy(), pdf["_ord0"].to_numpy()
        at = _near(us0, order, many)
        lists = [[x.tolist() if m else [v] for x, m, v in zip(pdf[c].to_numpy()[at], many[at], one)] for c, one in (("_us", us0[at].tolist()), ("_ord", order[at].tolist()), ("_cost", [0.0] * len(at)))]
        own = pdf[many]
        row = {"_source": key[0], "_at0": key[1], "_tie0": key[2], "_no": key[3], "us": lists[0], "ord": lists[1], "cost": lists[2], "many": many[at].tolist()}
        for c in names:
            row[f"p_{c}"] = [None if x is None or x is pd.NaT else x for x in own[c].astype(object).where(own[c].notna(), None)]
        return pd.DataFrame([row])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size, no, key = 0, 0, None
        for pdf in batches:
            own = pdf["_source"].to_numpy()
            for rows in np.split(np.arange(len(pdf)), np.flatnonzero(own[1:] != own[:-1]) + 1):
                while len(rows):
                    if key is not None and (key[0] != own[rows[0]] or size >= BLOCK):
                        yield packed(key, held)
                        held, size, key = [], 0, None
                    if key is None:
                        head = pdf.iloc[rows[0]]
                        key, no = (int(head["_source"]), int(head["_at"]), int(head["_tie"]), no), no + 1
                    take, rows = rows[: BLOCK - size], rows[BLOCK - size :]
                    held.append(pdf.iloc[take])
                    size += len(take)
        if key is not None:
            yield packed(key, held)

    return run


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        ways = [list(zip(*_through([x.tolist() for x in u], o, c))) for u, o, c in zip(pdf["us"], pdf["ord"], pdf["cost"])]
        yield pd.DataFrame({**{c: pdf[c] for c in ("_source", "_at0", "_tie0", "_no")}, "first": [u[0] for u in pdf["us"]], **{f"w{k}": [list(w[k]) for w in ways] for k in range(5)}})


def _stitched(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["_at0", "_tie0", "_no"], ignore_index=True)
    chosen = _stitch([(r["first"], list(zip(*(r[f"w{k}"] for k in range(5))))) for _, r in pdf.iterrows()])
    return pdf[["_source", "_at0", "_tie0", "_no"]].assign(conv=[c for c, _, _ in chosen], pick=[k for _, k, _ in chosen], after=[s[0] for _, _, s in chosen], end=[s[1] for _, _, s in chosen])


def _chosen(names: list[str]):
    """The moments of the records with a choice, from blocks and the states at their ends."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.to_dict("records"):
                if not any(r["many"]):
                    continue
                us = [x.tolist() for x in r["us"]]
                picks = _between(us, r["ord"], r["cost"], int(r["conv"]), int(r["pick"]), (int(r["after"]), int(r["end"])))
                yield pd.DataFrame({**{c: list(r[f"p_{c}"]) for c in names}, "us": [u[k] for u, k, m in zip(us, picks, r["many"]) if m]})

    return run


def resolve(df: DataFrame, sites: DataFrame, *, value: str = "value", domain: str = "domain", source: list[str], order: str = "ord_key", zone_utc: str | None = None, fixed: str | None = None) -> DataFrame:
    """``df``, one row per readable value, with ``us``: the moment in microseconds since 1970 UTC.

    ``source`` names the columns of a chain, ``order`` the long that numbers its records, with or without gaps; records
    of one number follow the hash of their text. ``fixed`` names a boolean column: true where the value is in the canonical form, which
    needs no reading. Chains are never cut. Unreadable
    and null values give no row; repeated rows give repeated rows; an empty ``df`` gives an empty result.
    """
    keys = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in source])
    several = lambda field: F.when(F.size("cands") > 1, F.transform("cands", lambda x: x[field]))
    place = [keys.alias("_source"), F.coalesce(F.col(order), F.lit(0)).cast("long").alias("_at"), F.xxhash64(value).alias("_tie")]
    chain = readings(df.filter(~F.col(fixed)) if fixed else df, sites, value, domain, zone_utc).select(
        *df.columns, *place, F.col("cands")[0]["us"].alias("_us0"), F.col("cands")[0]["ord"].alias("_ord0"), several("us").alias("_us"), several("ord").alias("_ord"), several("cost").alias("_cost"),
    )
    if fixed:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("_us", "array<bigint>"), ("_ord", "array<int>"), ("_cost", "array<double>"))]
        # the form itself is UTC, to the microsecond
        instant = F.unix_micros(F.replace(F.replace(value, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit("+00:00")).try_cast("timestamp"))
        chain = chain.unionByName(df.filter(F.col(fixed)).select(*df.columns, *place, instant.alias("_us0"), F.lit(0).alias("_ord0"), *none).filter("_us0 IS NOT NULL"))
    chain = materialize(chain, "readings")
    many = F.col("_us").isNotNull()
    # only records with a choice carry their columns along the chain
    slim = chain.select("_source", "_at", "_tie", "_us0", "_ord0", "_us", "_ord", "_cost", *[F.when(many, F.col(c)).alias(c) for c in df.columns])
    sources = chain.filter(many).select("_source").distinct()
    slim = slim.join(sources, "_source", "left_semi")
    kinds = dict(df.dtypes)
    packed = ", ".join(f"p_{c} array<{kinds[c]}>" for c in df.columns)
    blocks = slim.repartitionByRange("_source", "_at", "_tie").sortWithinPartitions("_source", "_at", "_tie")
    blocks = materialize(blocks.mapInPandas(_blocks(df.columns), f"{_KEY}, us array<array<long>>, ord array<array<int>>, cost array<array<double>>, many array<boolean>, {packed}"), "blocks")
    ways = blocks.select("_source", "_at0", "_tie0", "_no", "us", "ord", "cost").mapInPandas(_summaries, f"{_KEY}, first array<long>, w0 array<int>, w1 array<int>, w2 array<int>, w3 array<long>, w4 array<double>")
    # a row per block and source
    ends = ways.groupBy("_source").applyInPandas(_stitched, f"{_KEY}, conv int, pick int, after int, end long")
    schema = df.select(*df.columns, F.lit(0).cast("long").alias("us")).schema
    chosen = blocks.join(ends, ["_source", "_at0", "_tie0", "_no"]).mapInPandas(_chosen(df.columns), schema)
    return chain.filter(~many).select(*df.columns, F.col("_us0").alias("us")).unionByName(chosen)


def _field(df: DataFrame, name: str, value: str, key: Column, order: Column, utc: bool) -> DataFrame:
    return df.select(F.lit(name).alias("field_name"), key.alias("row_key"), F.col(value).alias("value"), "domain", order.alias("ord_key"), F.lit(utc).alias("as_utc"))


def moment_fields(urls: DataFrame, entries: DataFrame) -> DataFrame:
    """The three text fields of the queue and the sitemap entries as (field_name, row_key, value, domain, ord_key, as_utc)."""
    row = F.col("id").cast("string")
    # entries of one crawl have no order of their own: the hash of their text gives them one that stays the same
    seen = F.coalesce(F.unix_micros("first_seen"), F.lit(0))
    both = urls.select("domain", "id", F.explode(F.array(
        F.struct(F.lit("discovered_urls.pub_date").alias("f"), F.col("pub_date").alias("v"), F.lit(False).alias("u")),
        F.struct(F.lit("discovered_urls.discovered_at").alias("f"), F.col("discovered_at").alias("v"), F.lit(True).alias("u")),
    )).alias("x")).select(F.col("x.f").alias("field_name"), row.alias("row_key"), F.col("x.v").alias("value"), "domain", F.col("id").alias("ord_key"), F.col("x.u").alias("as_utc"))
    return both.unionByName(_field(entries, "sitemap_entries.lastmod", "lastmod", F.col("url"), seen, False))


def moments_of(urls: DataFrame, entries: DataFrame, sites: DataFrame, canonical: bool) -> DataFrame:
    """(field_name, row_key, utc) of all readable values, or only of those not in the ``canonical`` form; those in it always hold their chains."""
    fields = moment_fields(urls, entries).filter(F.col("value").isNotNull()).withColumn("fixed", F.col("value").rlike(ts.CANONICAL))
    out = resolve(fields, sites, source=["field_name", "domain"], zone_utc="as_utc", fixed="fixed")
    return out.filter(F.lit(canonical) | ~F.col("fixed")).select("field_name", "row_key", ts.format_us(F.col("us")).alias("utc")).distinct()


def found(urls: DataFrame, entries: DataFrame, sites: DataFrame) -> DataFrame:
    """(field_name, row_key, utc): the readable values not yet in the canonical form, in it."""
    return moments_of(urls, entries, sites, False)
