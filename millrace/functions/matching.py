"""Which company a page is about, from its address and title, as columns.

All that depends on the company alone is worked out once per company (``company_columns``); a pair is then
classed by substring tests on flattened text. Patterns made per row are used only where a title has a
mark that calls for them, or a ticker has characters that flattening would lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import urls
from millrace.session import small_enough

#: Companies whose columns (about half a kilobyte each) may be broadcast.
BROADCAST_COMPANIES = 50_000

#: fixed values: words and limits of the rule
WORD_TICKERS = ("ON", "A", "ARE", "IT", "TECH", "HAS", "NOW", "ALL")
STOPWORDS = tuple(
    "dollar american trade bank first news best global home target public live state federal capital texas digital extra union equity international general united national new pacific southern western norfolk".split()
)
COMMON = WORD_TICKERS + tuple("AM AN AS AT BE BY DO GO HE IF IN IS ME MY NO OF OR SO TO UP US WE I CAN FOR ONE OUT NEW BIG FAST KEY APP FIX".split())
ABBREVIATIONS = ("PM", "MA", "ED", "EL", "IP", "CI", "HD", "PH", "MS", "NI", "DD")
ALIASES = {"GOOGL": ["google"], "GOOG": ["google"], "PG": ["p and g"], "META": ["facebook"], "BRK.B": ["berkshire"], "BRK.A": ["berkshire"], "JPM": ["jpmorgan"], "WMT": ["wal mart"]}
SUFFIX = r"(?i)\b(inc|corp|corporation|co|company|ltd|plc|llc|holdings|group|the|class [a-c])\b\.?"
PLURAL_PHRASES = ("best buy", "on semiconductor", "target corporation")
EXCHANGE = "(?:NYSE American|NYSE MKT|NYSEARCA|NYSE|NASDAQ|Nasdaq)"
RANK = {"reject": 0, "review": 1, "accept": 2}
MIN_NAME, MIN_TICKER, MIN_SHORT_TICKER = 4, 3, 2

_NO_EDGE = "[A-Za-z0-9&]"


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, one blank between; ``&`` is read as ``and``."""
    return F.trim(F.regexp_replace(F.replace(F.lower(text), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def flat(text: Column) -> Column:
    """``words`` between blanks."""
    return F.concat(F.lit(" "), words(text), F.lit(" "))


def normalized_name(company: Column) -> Column:
    """The company's name without forms of incorporation; punctuation as blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(company), SUFFIX, " "), "[^a-z0-9]+", " "))


def full_name(company: Column) -> Column:
    return normalized_name(F.replace(company, F.lit("&"), F.lit(" and ")))


def _spelled_enough(form: Column) -> Column:
    parts = F.split(form, " ")
    whole = F.forall(parts, lambda w: F.length(w) >= 2)
    return (form != "") & whole & ((F.size(parts) >= 2) | ((F.length(form) >= MIN_NAME) & ~form.isin(*STOPWORDS)))


def loose_forms(company: Column) -> Column:
    """Spellings of the name that an address may use, as an array: each counts as weak evidence."""
    bare = F.trim(F.regexp_replace(company, r"\([^)]*\)", " "))
    name, kept = full_name(company), words(bare)
    legal = F.regexp_replace(kept, " corp$", " corporation")
    brand = words(F.regexp_replace(bare, "(?<=[a-z])(?:Corp|Co)$", ""))
    every = F.array_distinct(F.array(name, F.replace(name, F.lit(" and "), F.lit(" ")), kept, legal, brand))
    return F.filter(every, _spelled_enough)


def company_columns(companies: DataFrame, name: str = "company", ticker: str = "ticker") -> DataFrame:
    """``companies`` with the columns that ``classify`` needs (``m_*``); rows without name or ticker are left out."""
    c, t = F.col(name), F.col(ticker)
    full = full_name(c)
    first = F.regexp_replace(F.split_part(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(" "), F.lit(1)), r"^[,.]+|[,.]+$", "")
    distinctive = ((F.length(full) >= MIN_NAME) | full.rlike(r"\d")) & ~full.isin(*STOPWORDS) & (full != "")
    alias = F.create_map(*[x for k, v in ALIASES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    common = t.isin(*COMMON, *ABBREVIATIONS)
    forms = loose_forms(c)
    plural = F.filter(forms, lambda f: f.contains(" ") & ~f.isin(*PLURAL_PHRASES))
    return companies.filter(c.isNotNull() & t.isNotNull() & (F.trim(c) != "") & (t != "")).withColumns({
        "m_name": F.when(distinctive, full),
        "m_aliases": F.coalesce(F.try_element_at(alias, t), F.array().cast("array<string>")),
        "m_common": common,
        "m_upper": F.when(~common & (F.length(t) >= MIN_SHORT_TICKER), t),
        "m_weak": F.when(~common & (F.length(t) >= MIN_TICKER), t),
        "m_abbreviation": F.when(t.isin(*ABBREVIATIONS), t),
        "m_forms": F.concat(forms, F.transform(plural, lambda f: F.concat(f, F.lit("s")))),
        "m_first": F.when((F.length(first) >= MIN_NAME) & ~F.lower(first).isin(*STOPWORDS), first),
    })


def with_company(rows: DataFrame, name: str = "company", ticker: str = "ticker") -> DataFrame:
    """``rows`` with the columns of ``company_columns``, worked out once per name and ticker; rows without either are left out."""
    each = company_columns(rows.select(name, ticker).distinct(), name, ticker)
    each = F.broadcast(each) if small_enough(rows.select(name, ticker).distinct(), BROADCAST_COMPANIES) else each
    return rows.join(each, [name, ticker])


def edges(text: Column) -> Column:
    """Text in which all but letters, digits and ``&`` are blanks, between blanks."""
    return F.concat(F.lit(" "), F.regexp_replace(text, "[^A-Za-z0-9&]", " "), F.lit(" "))


def _quoted(token: Column) -> Column:
    return F.concat(F.lit("\\Q"), token, F.lit("\\E"))


def _word(token: Column, text: Column, edged: Column, ignore_case: bool) -> Column:
    """``token`` as a whole word: no letter, digit or ``&`` next to it."""
    a, b = (F.lower(token), F.lower(edged)) if ignore_case else (token, edged)
    pattern = F.concat(F.lit(("(?i)" if ignore_case else "") + f"(?<!{_NO_EDGE})"), _quoted(token), F.lit(f"(?!{_NO_EDGE})"))
    return F.when(token.rlike("^[A-Za-z0-9&]+$"), b.contains(F.concat(F.lit(" "), a, F.lit(" ")))).otherwise(F.rlike(text, pattern))


def explicit_ticker(ticker: Column, title: Column, cashtag: bool = True) -> Column:
    """``(NYSE: X)``, ``NASDAQ: X`` and, with ``cashtag``, ``$X`` in the title."""
    t, end = _quoted(ticker), r"(?![A-Za-z0-9&-])"
    forms = [F.lit(rf"\({EXCHANGE}\s*:\s*"), t, F.lit(r"\)|"), F.lit(rf"{EXCHANGE}\s*:\s*"), t, F.lit(end)]
    if cashtag:
        forms += [F.lit(r"|\$"), t, F.lit(end)]
    marked = title.contains(":") | title.contains("$") if cashtag else title.contains(":")
    return F.when(marked, F.rlike(title, F.concat(*forms))).otherwise(F.lit(False))


def classify(title: Column, text: Column, flat_text: Column, edged_title: Column, edged_text: Column, ticker: Column) -> Column:
    """``struct(cls, reason)`` of a pair whose row has the ``m_*`` columns; text columns must not be null."""
    within = lambda form: flat_text.contains(F.concat(F.lit(" "), form, F.lit(" ")))
    made = lambda cls, reason: F.struct(F.lit(cls).alias("cls"), F.lit(reason).alias("reason"))
    yes = lambda c: F.coalesce(c, F.lit(False))
    m = {k: F.col(f"m_{k}") for k in ("name", "aliases", "common", "upper", "weak", "abbreviation", "forms", "first")}
    return (
        F.when(yes(within(m["name"])), made("accept", "name"))
        .when(F.exists(m["aliases"], within), made("accept", "alias"))
        .when(F.when(m["common"], explicit_ticker(ticker, title, False)).otherwise(explicit_ticker(ticker, title)), made("accept", "explicit_ticker"))
        .when(yes(_word(m["upper"], title, edged_title, False)), made("accept", "upper_ticker"))
        .when(m["common"] & explicit_ticker(ticker, title), made("review", "cashtag"))
        .when(yes(_word(m["weak"], text, edged_text, True)), made("review", "weak_ticker"))
        .when(F.exists(m["forms"], within), made("review", "loose_name"))
        .when(yes(_word(m["first"], text, edged_text, True)), made("review", "weak_first_word"))
        .when(yes(_word(m["abbreviation"], title, edged_title, False)), made("review", "abbreviation"))
        .otherwise(made("reject", "none"))
    )


def text_columns(rows: DataFrame, url: str = "url", title: str = "title") -> DataFrame:
    """``rows`` with the text columns of ``classify`` (``x_*``)."""
    text = rows.withColumns({"x_title": F.coalesce(F.col(title), F.lit("")), "x_text": F.coalesce(urls.entry_text(F.col(url), F.col(title)), F.lit(""))})
    return text.withColumns({"x_flat": flat(F.col("x_text")), "x_etitle": edges(F.col("x_title")), "x_etext": edges(F.col("x_text"))})


def classified(rows: DataFrame, ticker: str = "ticker") -> DataFrame:
    """``rows`` of pairs (with ``x_*`` and ``m_*``) plus ``match_class`` and ``match_reason``, without those columns."""
    hit = classify(F.col("x_title"), F.col("x_text"), F.col("x_flat"), F.col("x_etitle"), F.col("x_etext"), F.col(ticker))
    keep = [c for c in rows.columns if not c.startswith(("x_", "m_"))]
    found = rows.select(*keep, F.inline(F.array(hit)))
    return found.select(*[c for c in keep if c not in ("match_class", "match_reason")], F.col("cls").alias("match_class"), F.col("reason").alias("match_reason"))
