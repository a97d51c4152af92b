"""Readings of timestamp text, as columns.

A value is read by one regular expression per family into ``\\u0001family|y|m|d|H|M|S|frac|half|zone``;
everything after that is integer arithmetic, so no step depends on the session's time zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000

#: fixed values: month names in order
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

_MON = r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?"
_ZONE = r"(z|[+-]\d{2}(?::?\d{2})?|[a-z]{2,5})?"
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?"

#: family letter, pattern, replacement; families exclude each other by their first characters
FAMILIES = [
    ("i", rf"^\s*(\d{{4}})-(\d{{2}})-(\d{{2}})(?:[t ]\s*{_TIME}\s*{_ZONE})?\s*$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    ("c", r"^\s*(\d{4})(\d{2})(\d{2})(?:t(\d{2})(\d{2})(\d{2})(?:[.,](\d+))?(z|[+-]\d{2}(?::?\d{2})?)?)?\s*$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    ("r", rf"^\s*(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?(\d{{1,2}})\s+{_MON},?\s+(\d{{4}})(?:,?\s+{_TIME}\s*([ap]m)?\s*{_ZONE})?\s*$", "$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    ("n", rf"^\s*(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?{_MON}\s+(\d{{1,2}}),?\s+(\d{{4}})(?:,?\s+{_TIME}\s*([ap]m)?\s*{_ZONE})?\s*$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    ("s", rf"^\s*(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:,?\s+{_TIME}\s*([ap]m)?\s*{_ZONE})?\s*$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    ("e", r"^\s*(\d{10}|\d{13}|\d{16}|\d{19})\s*$", "$1||||||||"),
]

CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}Z$"


def zone_abbreviations(zone: str) -> dict[str, int]:
    """Abbreviations in use in ``zone`` since 1990, with their offsets in minutes."""
    found: dict[str, int] = {}
    try:
        info = ZoneInfo(zone)
    except Exception:
        return found
    at = datetime(1990, 1, 1, tzinfo=timezone.utc)
    while at.year < 2040:
        local = at.astimezone(info)
        name = local.tzname()
        if name and name.isalpha():
            found[name.lower()] = int(local.utcoffset().total_seconds() // 60)
        at += timedelta(days=28)
    return found


def canon(value: Column) -> Column:
    """``family|y|m|d|H|M|S|frac|half|zone`` behind a marker, or null for text of no family."""
    text = value
    for letter, pattern, replacement in FAMILIES:
        text = F.regexp_replace(text, "(?i)" + pattern, f"\u0001{letter}|{replacement}")
    return F.nullif(F.regexp_replace(text, "(?s)^[^\u0001].*$", ""), F.lit(""))


def _num(part: Column) -> Column:
    return part.try_cast("int")


def _month(part: Column) -> Column:
    at = F.position(F.lower(F.substring(part, 1, 3)), F.lit(MONTHS))
    return F.coalesce(_num(part), F.when(F.length(part) >= 3, ((at + 2) / 3).cast("int")))


def _days(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970 of a calendar date, null where there is no such date."""
    return F.unix_date(F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")).try_cast("date"))


def parts(at: Column) -> dict[str, Column]:
    """The pieces of a split canon string, by name."""
    piece = {k: F.get(at, F.lit(i)) for i, k in enumerate(("family", "y", "m", "d", "H", "M", "S", "frac", "half", "zone"))}
    return piece


def clock_us(p: dict[str, Column]) -> Column:
    """Microseconds since midnight; digits beyond microseconds are cut; null for an impossible time."""
    raw = F.coalesce(_num(p["H"]), F.lit(0))
    half = F.lower(p["half"])
    hour = F.when(half == "", raw).when((raw < 1) | (raw > 12), F.lit(None)).when(half == "am", raw % 12).otherwise(raw % 12 + 12)
    minute, second = F.coalesce(_num(p["M"]), F.lit(0)), F.coalesce(_num(p["S"]), F.lit(0))
    frac = F.coalesce(F.rpad(F.substring(p["frac"], 1, 6), 6, "0").try_cast("long"), F.lit(0))
    return F.when((hour < 24) & (minute < 60) & (second < 60), ((hour * 60 + minute) * 60 + second).cast("long") * 1_000_000 + frac)


def epoch_us(p: dict[str, Column]) -> Column:
    """Microseconds of a count of seconds, milli-, micro- or nanoseconds since 1970."""
    n, size = p["y"].try_cast("long"), F.length(p["y"])
    return F.when(size == 10, n * 1_000_000).when(size == 13, n * 1_000).when(size == 16, n).when(size == 19, F.substring(p["y"], 1, 16).try_cast("long"))


def offset_minutes(zone: Column, abbreviations: Column) -> Column:
    """Offset of written zone text: null where it names none known for the source."""
    z = F.lower(zone)
    digits = F.regexp_replace(F.substring(z, 2, 5), ":", "")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    return (
        F.when(z.isin("z", "utc", "gmt", "ut"), F.lit(0))
        .when(z.startswith("+"), minutes)
        .when(z.startswith("-"), -minutes)
        .otherwise(F.try_element_at(abbreviations, z))
    )


def zone_less_us(local_us: Column, zone: Column) -> Column:
    """The instant of a wall clock reading in ``zone``: first pass of a repeated hour, a skipped hour moved on by the gap."""
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local_us), zone))


def second_pass_us(first_us: Column, local_us: Column, zone: Column) -> Column:
    """The later instant with the same wall clock, null where the hour isn't repeated."""
    later = first_us + HOUR_US
    return F.when(F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(later), zone)) == local_us, later)


def format_us(us: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.ffffffZ``."""
    day = F.floor(us / F.lit(DAY_US).cast("double")).cast("long")
    day = F.when(us - day * DAY_US < 0, day - 1).when(us - day * DAY_US >= DAY_US, day + 1).otherwise(day)
    rest = us - day * DAY_US
    second = ((rest - rest % 1_000_000) / 1_000_000).cast("int")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(
        F.date_from_unix_date(day.cast("int")).cast("string"), F.lit("T"),
        two((second / 3600).cast("int")), F.lit(":"), two((second % 3600 / 60).cast("int")), F.lit(":"), two(second % 60),
        F.lit("."), F.lpad((rest % 1_000_000).cast("string"), 6, "0"), F.lit("Z"),
    )
