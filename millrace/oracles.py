"""SQL of the core's queries, for a second engine over the same tables."""

from __future__ import annotations

_NORMAL = r"""regexp_replace(lower(regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1)) || regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#;]*)', 1), '/+$', '')"""
_HOST = r"""regexp_replace(split_part(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)), ':', 1), '^www\.', '')"""
_STOP = "('dollar','american','trade','bank','first','news','best','global','home','target','public','live','state','federal','capital','texas','digital','extra','union','equity','international','general','united','national','new','pacific','southern','western','norfolk')"
_ABBR = "('PM','MA','ED','EL','IP','CI','HD','PH','MS','NI','DD')"
_COMMON = "('ON','A','ARE','IT','TECH','HAS','NOW','ALL','AM','AN','AS','AT','BE','BY','DO','GO','HE','IF','IN','IS','ME','MY','NO','OF','OR','SO','TO','UP','US','WE','I','CAN','FOR','ONE','OUT','NEW','BIG','FAST','KEY','APP','FIX','PM','MA','ED','EL','IP','CI','HD','PH','MS','NI','DD')"
_EXCHANGE = "(?:NYSE American|NYSE MKT|NYSEARCA|NYSE|NASDAQ|Nasdaq)"


def _words(x: str) -> str:
    return rf"trim(regexp_replace(replace(lower({x}), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


def _edges(x: str) -> str:
    return rf"(' ' || regexp_replace({x}, '[^A-Za-z0-9&]', ' ', 'g') || ' ')"


def _company(rows: str) -> str:
    """SQL of the company columns of a relation with ``ticker`` and ``company``."""
    full = r"trim(regexp_replace(regexp_replace(lower(replace(company, '&', ' and ')), '\b(inc|corp|corporation|co|company|ltd|plc|llc|holdings|group|the|class [a-c])\b\.?', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"
    return rf"""
SELECT *, CASE WHEN (length(fn) >= 4 OR regexp_matches(fn, '[0-9]')) AND fn NOT IN {_STOP} AND fn <> '' THEN fn END AS m_name,
  CASE ticker WHEN 'GOOGL' THEN ['google'] WHEN 'GOOG' THEN ['google'] WHEN 'PG' THEN ['p and g'] WHEN 'META' THEN ['facebook'] WHEN 'BRK.A' THEN ['berkshire']
    WHEN 'BRK.B' THEN ['berkshire'] WHEN 'JPM' THEN ['jpmorgan'] WHEN 'WMT' THEN ['wal mart'] ELSE [] END AS m_aliases,
  ticker IN {_COMMON} AS m_common,
  list_concat(forms, list_transform(list_filter(forms, lambda f: contains(f, ' ') AND f NOT IN ('best buy', 'on semiconductor', 'target corporation')), lambda f: f || 's')) AS m_forms,
  CASE WHEN length(fw) >= 4 AND lower(fw) NOT IN {_STOP} THEN fw END AS m_first
FROM (SELECT *, list_filter(list_distinct([fn, replace(fn, ' and ', ' '), kept, regexp_replace(kept, ' corp$', ' corporation'), brand]),
        lambda f: f <> '' AND len(list_filter(string_split(f, ' '), lambda w: length(w) < 2)) = 0 AND (contains(f, ' ') OR (length(f) >= 4 AND f NOT IN {_STOP}))) AS forms
  FROM (SELECT *, {full} AS fn, {_words("bare")} AS kept, {_words("CASE WHEN regexp_matches(bare, '[a-z](?:Corp|Co)$') THEN regexp_replace(bare, '(?:Corp|Co)$', '') ELSE bare END")} AS brand,
      regexp_replace(regexp_replace(split_part(trim(regexp_replace(company, '\s+', ' ', 'g')), ' ', 1), '^[,.]+', ''), '[,.]+$', '') AS fw
    FROM (SELECT *, trim(regexp_replace(company, '\([^)]*\)', ' ', 'g')) AS bare FROM ({rows}) WHERE company IS NOT NULL AND ticker IS NOT NULL AND trim(company) <> '' AND ticker <> '')))
"""


def _texts(rows: str) -> str:
    """SQL of the text columns of a relation with ``url`` and non-null ``title``."""
    return rf"""
SELECT *, ' ' || {_words("x_text")} || ' ' AS x_flat, {_edges("title")} AS x_etitle, lower({_edges("x_text")}) AS x_etext
FROM (SELECT *, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) || ' ' || regexp_extract(url, '\?([^#]*)', 1) || ' ' || title AS x_text FROM ({rows}))
"""


#: class and reason, joined by a bar, of a row with text and company columns
_CLASS = rf"""
CASE WHEN contains(x_flat, ' ' || m_name || ' ') THEN 'accept|name'
  WHEN len(list_filter(m_aliases, lambda f: contains(x_flat, ' ' || f || ' '))) > 0 THEN 'accept|alias'
  WHEN regexp_matches(title, '\({_EXCHANGE}\s*:\s*' || ticker || '\)|{_EXCHANGE}\s*:\s*' || ticker || '($|[^A-Za-z0-9&-])') OR (NOT m_common AND regexp_matches(title, '\$' || ticker || '($|[^A-Za-z0-9&-])')) THEN 'accept|explicit_ticker'
  WHEN NOT m_common AND length(ticker) >= 2 AND contains(x_etitle, ' ' || ticker || ' ') THEN 'accept|upper_ticker'
  WHEN m_common AND regexp_matches(title, '\$' || ticker || '($|[^A-Za-z0-9&-])') THEN 'review|cashtag'
  WHEN NOT m_common AND length(ticker) >= 3 AND contains(x_etext, ' ' || lower(ticker) || ' ') THEN 'review|weak_ticker'
  WHEN len(list_filter(m_forms, lambda f: contains(x_flat, ' ' || f || ' '))) > 0 THEN 'review|loose_name'
  WHEN contains(x_etext, ' ' || lower(m_first) || ' ') THEN 'review|weak_first_word'
  WHEN ticker IN {_ABBR} AND contains(x_etitle, ' ' || ticker || ' ') THEN 'review|abbreviation'
  ELSE 'reject|none' END
"""

_PAIRS = f"""
titled AS (SELECT d.id, d.url, d.domain, d.source, d.company, d.ticker, d.match_class AS stored_class, coalesce(nullif(d.title, ''), a.title, '') AS title FROM discovered_urls d LEFT JOIN articles a ON a.id = d.id),
classed AS (SELECT id, domain, source, stored_class, split_part(c, '|', 1) AS match_class, split_part(c, '|', 2) AS match_reason FROM (SELECT *, {_CLASS} AS c FROM ({_company(_texts('SELECT * FROM titled'))})))
"""

_PRESELECT = f"""
entries AS ({_texts(f"SELECT n AS url, coalesce(max(title), '') AS title FROM (SELECT {_NORMAL} AS n, title FROM sitemap_entries) GROUP BY n")}),
firms AS ({_company("SELECT symbol AS ticker, max(security) AS company FROM universe_membership GROUP BY symbol")}),
pairs AS (SELECT url, ticker, split_part(c, '|', 1) AS match_class, split_part(c, '|', 2) AS match_reason FROM (SELECT *, {_CLASS} AS c FROM entries, firms) WHERE c NOT LIKE 'reject%')
"""

_MODE = r"""
CASE WHEN t AND n THEN 'both' WHEN t THEN 'ticker_only' WHEN n THEN 'name_only' ELSE 'unmatched' END
"""

_WALL = r"""
CASE WHEN regexp_matches(h, '\b(?:security verification|unusual traffic from your|verify you are a human|verify you are human|are you a robot|checking your browser|enable javascript and cookies)\b')
    OR regexp_matches(h, '^[\s"''#*]*(?:just a moment|access denied)\b') THEN 'failed'
  WHEN regexp_matches(h, '\b(?:sign in to continue|log in to continue|create a free account to continue|subscribe to continue)\b') THEN 'paywalled' END
"""

_WORDS = r"len(list_filter(regexp_split_to_array(body, '\s+'), lambda w: w <> ''))"

_LABELS = "lower(trim(security)), lower(trim(gics_sector)), lower(trim(gics_sub_industry))"

#: both origins of histories: (origin, symbol, security, gics_sector, gics_sub_industry, valid_from, valid_to)
_VERSIONS = f"""
WITH latest AS (
  SELECT upper(trim(symbol)) AS symbol, snapshot_date, security, gics_sector, gics_sub_industry FROM roster_snapshots WHERE symbol IS NOT NULL AND snapshot_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY upper(trim(symbol)), snapshot_date ORDER BY captured_at DESC NULLS LAST, security DESC NULLS LAST, gics_sector DESC NULLS LAST, gics_sub_industry DESC NULLS LAST) = 1),
days AS (SELECT snapshot_date, lead(snapshot_date) OVER (ORDER BY snapshot_date) AS next_date FROM (SELECT DISTINCT snapshot_date FROM roster_snapshots WHERE snapshot_date IS NOT NULL)),
filled AS (
  SELECT symbol, snapshot_date, next_date, last_value(security IGNORE NULLS) OVER w AS security, last_value(gics_sector IGNORE NULLS) OVER w AS gics_sector, last_value(gics_sub_industry IGNORE NULLS) OVER w AS gics_sub_industry
  FROM latest JOIN days USING (snapshot_date) WINDOW w AS (PARTITION BY symbol ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING)),
keyed AS (SELECT *, row({_LABELS}) AS k FROM filled),
marked AS (SELECT *, CASE WHEN lag(snapshot_date) OVER w IS NULL OR lag(k) OVER w IS DISTINCT FROM k OR lag(next_date) OVER w IS DISTINCT FROM snapshot_date THEN 1 ELSE 0 END AS fresh FROM keyed WINDOW w AS (PARTITION BY symbol ORDER BY snapshot_date)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY symbol ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING) AS run FROM marked),
snaps AS (
  SELECT 'snapshots' AS origin, symbol, arg_min(security, snapshot_date) AS security, arg_min(gics_sector, snapshot_date) AS gics_sector, arg_min(gics_sub_industry, snapshot_date) AS gics_sub_industry, min(snapshot_date) AS valid_from,
    CASE WHEN bool_or(next_date IS NULL) THEN DATE '9999-12-31' ELSE max(next_date) - 1 END AS valid_to
  FROM runs GROUP BY symbol, run),
stored AS (SELECT upper(trim(symbol)) AS symbol, min(security) AS security, min(gics_sector) AS gics_sector, min(gics_sub_industry) AS gics_sub_industry, row({_LABELS}) AS k, valid_from, coalesce(valid_to, DATE '9999-12-31') AS stop
  FROM universe_membership WHERE symbol IS NOT NULL AND valid_from IS NOT NULL GROUP BY upper(trim(symbol)), row({_LABELS}), valid_from, coalesce(valid_to, DATE '9999-12-31')),
cut AS (SELECT *, least(stop, coalesce(lead(valid_from) OVER (PARTITION BY symbol ORDER BY valid_from, stop, k) - 1, stop)) AS last_day FROM stored),
joined AS (SELECT *, CASE WHEN lag(k) OVER w IS NOT DISTINCT FROM k AND lag(last_day) OVER w + 1 = valid_from THEN 0 ELSE 1 END AS fresh FROM cut WHERE last_day >= valid_from WINDOW w AS (PARTITION BY symbol ORDER BY valid_from, stop, k)),
stretches AS (SELECT *, sum(fresh) OVER (PARTITION BY symbol ORDER BY valid_from, stop, k ROWS UNBOUNDED PRECEDING) AS run FROM joined),
stays AS (SELECT 'stored' AS origin, symbol, arg_min(security, valid_from) AS security, arg_min(gics_sector, valid_from) AS gics_sector, arg_min(gics_sub_industry, valid_from) AS gics_sub_industry, min(valid_from) AS valid_from, max(last_day) AS valid_to FROM stretches GROUP BY symbol, run),
versions AS (SELECT * FROM snaps UNION ALL SELECT * FROM stays)
"""

_SESSIONS = """
years AS (SELECT CAST(y AS INTEGER) AS y FROM range({first}, {last}) t(y)),
parts AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
moon AS (SELECT y, a, b, c, (19 * a + b - b // 4 - ((b - (b + 8) // 25 + 1) // 3) + 15) % 30 AS h FROM parts),
week AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM moon),
sunday AS (SELECT y, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM week),
good AS (SELECT make_date(y, CAST(n // 31 AS INTEGER), CAST(n % 31 + 1 AS INTEGER)) - 2 AS day FROM sunday),
fixed AS (SELECT make_date(y, m, d) AS day FROM years, (VALUES (1, 1, 0), (6, 19, 2022), (7, 4, 0), (12, 25, 0)) v(m, d, since) WHERE y >= since),
observed AS (SELECT CASE WHEN isodow(day) = 6 THEN day - 1 WHEN isodow(day) = 7 THEN day + 1 ELSE day END AS day FROM fixed WHERE NOT (month(day) = 1 AND isodow(day) = 6)),
every AS (SELECT CAST(d AS DATE) AS day FROM range(DATE '{start}', DATE '{end}' + 1, INTERVAL 1 DAY) t(d)),
ranked AS (SELECT day, month(day) AS m, isodow(day) AS w, (day(day) - 1) // 7 + 1 AS nth, day + 7 > last_day(day) AS final FROM every),
floating AS (SELECT day FROM ranked WHERE (m = 1 AND w = 1 AND nth = 3) OR (m = 2 AND w = 1 AND nth = 3) OR (m = 5 AND w = 1 AND final) OR (m = 9 AND w = 1 AND nth = 1) OR (m = 11 AND w = 4 AND nth = 4)),
special AS (SELECT CAST(d AS DATE) AS day FROM (VALUES ('2001-09-11'), ('2001-09-12'), ('2001-09-13'), ('2001-09-14'), ('2004-06-11'), ('2007-01-02'), ('2012-10-29'), ('2012-10-30'), ('2018-12-05'), ('2025-01-09')) v(d)),
sessions AS (SELECT day FROM every WHERE isodow(day) < 6 AND day NOT IN (SELECT day FROM good UNION ALL SELECT day FROM observed UNION ALL SELECT day FROM floating UNION ALL SELECT day FROM special))
"""


def oracle_sql() -> dict[str, str]:
    named = {
        "p6_found": _VERSIONS + "SELECT DISTINCT origin, symbol, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM versions",
        "p6_versions": _VERSIONS + "SELECT origin, symbol, security, gics_sector, gics_sub_industry, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM versions",
        "url_normalize": rf"SELECT id, {_NORMAL} AS normal, {_HOST} AS host, regexp_matches(lower(url), '^https?://[^/?#]+') AS valid, coalesce(TRY_CAST(regexp_extract(url, '/((?:19|20)\d{{2}})/', 1) AS INTEGER), 0) AS year FROM discovered_urls",
        "url_first": f"SELECT n AS url, ticker, id, source, status FROM (SELECT {_NORMAL} AS n, ticker, id, source, status FROM discovered_urls) QUALIFY row_number() OVER (PARTITION BY n, ticker ORDER BY id) = 1",
        "sitemap_duplicates": f"SELECT {_NORMAL} AS url, count(*) AS listed, count(DISTINCT lastmod) AS lastmods, bool_or(lastmod IS NULL) AS undated FROM sitemap_entries GROUP BY 1 HAVING count(*) > 1",
        "queue_stats": "SELECT 'total' AS kind, NULL AS value, count(*) AS n FROM discovered_urls UNION ALL SELECT 'status', status, count(*) FROM discovered_urls GROUP BY status UNION ALL SELECT 'domain', domain, count(*) FROM discovered_urls GROUP BY domain UNION ALL SELECT 'match_class', match_class, count(*) FROM discovered_urls GROUP BY match_class",
        "queue_page": "SELECT id, url, ticker, company, status FROM discovered_urls WHERE match_class = 'accept' AND contains(lower(company), 'holdings') ORDER BY id DESC LIMIT 50 OFFSET 50",
        "queue_page_total": "SELECT count(*) AS total FROM discovered_urls WHERE match_class = 'accept' AND contains(lower(company), 'holdings')",
        "queue_merge": """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY url, ticker ORDER BY id) AS k, CASE match_class WHEN 'reject' THEN 0 WHEN 'review' THEN 1 WHEN 'accept' THEN 2 END AS rank FROM discovered_urls),
s AS (SELECT * FROM r WHERE k = 1),
b AS (SELECT url, ticker, max(rank) AS rank, arg_min(match_class, (-rank, id)) AS cls, list(match_reason ORDER BY -rank, id)[1] AS reason, arg_min(match_reason, id) FILTER (match_reason IS NOT NULL) AS any_reason, arg_min(query, id) FILTER (query IS NOT NULL) AS query FROM r WHERE k > 1 GROUP BY url, ticker)
SELECT s.id, s.url, s.ticker, CASE WHEN b.rank > s.rank AND s.match_class = 'reject' AND s.status = 'skipped' THEN 'pending' ELSE s.status END AS status,
  CASE WHEN b.rank > s.rank THEN b.cls ELSE s.match_class END AS match_class, CASE WHEN b.rank > s.rank THEN b.reason ELSE coalesce(s.match_reason, b.any_reason) END AS match_reason, coalesce(s.query, b.query) AS query
FROM s LEFT JOIN b ON s.url = b.url AND s.ticker = b.ticker""",
        "table_fingerprint": "SELECT count(*) AS pairs, CAST(sum(id) AS BIGINT) AS id_sum, max(id) AS id_max, count(*) FILTER (match_class = 'reject') AS reject, count(*) FILTER (match_class = 'review') AS review, count(*) FILTER (match_class = 'accept') AS accept, (SELECT count(*) FROM articles) AS articles, (SELECT max(id) FROM articles) AS article_max, (SELECT count(*) FROM articles a WHERE NOT EXISTS (SELECT 1 FROM discovered_urls d WHERE d.id = a.id)) AS orphans FROM discovered_urls",
        "unfinished_pairs": "SELECT t.ticker, s.domain FROM (SELECT DISTINCT ticker FROM discovered_urls) t, (SELECT DISTINCT domain FROM sites) s WHERE NOT EXISTS (SELECT 1 FROM discovered_urls d WHERE d.ticker = t.ticker AND d.domain = s.domain)",
        "match_classify": f"WITH {_PAIRS} SELECT id, match_class, match_reason FROM classed",
        "class_transitions": f"WITH {_PAIRS} SELECT stored_class, match_class, count(*) AS n FROM classed GROUP BY ALL",
        "match_preselect": f"WITH {_PRESELECT} SELECT * FROM pairs",
        "match_counts": f"WITH {_PRESELECT} SELECT ticker, count(*) AS pairs, count(*) FILTER (match_class = 'accept') AS accepted FROM pairs GROUP BY ticker",
        "mode_audit": rf"""
WITH c AS (SELECT domain, source, regexp_matches(x, '(?i)\b' || ticker || '\b') AS t, regexp_matches(x, '(?i)\b' || regexp_replace(token, '([.()&])', '\\\1', 'g') || '\b') AS n
  FROM (SELECT *, concat_ws(chr(10), url, title) AS x, CASE WHEN length(split_part(trim(company), ' ', 1)) > 3 THEN split_part(trim(company), ' ', 1) ELSE company END AS token FROM discovered_urls)),
m AS (SELECT domain, source, {_MODE} AS mode FROM c),
g AS (SELECT domain, source, count(*) AS rows, count(*) FILTER (mode = 'both') AS "both", count(*) FILTER (mode = 'ticker_only') AS ticker_only, count(*) FILTER (mode = 'name_only') AS name_only, count(*) FILTER (mode = 'unmatched') AS unmatched FROM m GROUP BY ALL)
SELECT *, round_even(ticker_only / rows, 4) AS ticker_only_share, round_even(name_only / rows, 4) AS name_only_share FROM g""",
        "quality_audit": rf"""
WITH r AS (SELECT source_domain, coalesce(fetch_status = 'ok' OR (fetch_status = 'quarantined' AND prev_fetch_status = 'ok'), false) AS ok, fetch_status = 'quarantined' AS held, coalesce(body_text, '') AS body, lower(substr(coalesce(body_text, ''), 1, 300)) AS h FROM articles),
x AS (SELECT *, {_WALL} IS NOT NULL AS wall, {_WORDS} < 80 AS thin FROM r)
SELECT source_domain, count(*) AS rows, count(*) FILTER (ok) AS ok, count(*) FILTER (ok AND wall) AS walls, count(*) FILTER (ok AND thin) AS under_floor, count(*) FILTER (ok) - count(DISTINCT body) FILTER (ok) AS duplicate_bodies, count(*) FILTER (held) AS held FROM x GROUP BY source_domain""",
        "wall_by_status": f"SELECT fetch_status, count(*) AS rows, count(*) FILTER (w = 'failed') AS failed, count(*) FILTER (w = 'paywalled') AS paywalled FROM (SELECT fetch_status, {_WALL} AS w FROM (SELECT fetch_status, lower(substr(coalesce(body_text, ''), 1, 300)) AS h FROM articles)) GROUP BY fetch_status",
        "article_words": f"SELECT id, CAST({_WORDS} AS INTEGER) AS words, {_WORDS} < 80 AS thin FROM (SELECT id, body_text AS body FROM articles WHERE body_text IS NOT NULL)",
        "latest_crawls": "SELECT domain, epoch_us(started_at) AS started_at, entries, CAST(range_start AS VARCHAR) AS range_start FROM sitemap_crawls WHERE complete AND started_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY domain ORDER BY started_at DESC, entries DESC, range_start DESC) = 1",
        "crawl_gaps": "SELECT domain, count(*) AS crawls, count(*) FILTER (complete) AS complete, count(*) FILTER (finished_at IS NULL) AS open, CAST(coalesce(sum(failures), 0) AS BIGINT) AS failures, epoch_us(max(started_at) FILTER (complete)) AS latest_complete FROM sitemap_crawls GROUP BY domain",
        "current_entries": "WITH c AS (SELECT domain, max(started_at) AS last_start FROM sitemap_crawls WHERE complete GROUP BY domain) SELECT e.domain, url, lastmod, epoch_us(last_seen) AS last_seen FROM sitemap_entries e JOIN c ON c.domain = e.domain AND last_seen = last_start",
        "entry_upsert": "WITH g AS (SELECT domain, url, min(first_seen) AS first_seen FROM sitemap_entries GROUP BY ALL), n AS (SELECT domain, url, lastmod, title, last_seen FROM sitemap_entries QUALIFY row_number() OVER (PARTITION BY domain, url ORDER BY last_seen DESC, lastmod DESC NULLS LAST, title DESC NULLS LAST) = 1) SELECT domain, url, lastmod, title, epoch_us(first_seen) AS first_seen, epoch_us(last_seen) AS last_seen FROM n JOIN g USING (domain, url)",
        "membership_as_of": "SELECT DISTINCT symbol, security, gics_sector FROM universe_membership WHERE valid_from <= DATE '2023-06-30' AND (valid_to IS NULL OR valid_to >= DATE '2023-06-30')",
        "members_by_day": "SELECT CAST(d.day AS VARCHAR) AS day, count(DISTINCT u.symbol) AS members FROM (SELECT DISTINCT snapshot_date AS day FROM roster_snapshots) d LEFT JOIN universe_membership u ON u.valid_from <= d.day AND (u.valid_to IS NULL OR u.valid_to >= d.day) GROUP BY d.day",
        "closed_targets": "SELECT DISTINCT symbol, cik, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM universe_membership u WHERE valid_to >= DATE '2022-01-01' AND cik IS NOT NULL AND NOT EXISTS (SELECT 1 FROM universe_membership o WHERE o.cik = u.cik AND o.valid_to IS NULL)",
        "snapshot_changes": """
WITH s AS (SELECT DISTINCT upper(trim(symbol)) AS symbol, snapshot_date AS d FROM roster_snapshots), n AS (SELECT d, lag(d) OVER (ORDER BY d) AS before FROM (SELECT DISTINCT d FROM s))
SELECT CAST(n.d AS VARCHAR) AS snapshot_date, symbol, 'joined' AS change FROM s JOIN n ON s.d = n.d WHERE before IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s x WHERE x.symbol = s.symbol AND x.d = n.before)
UNION ALL SELECT CAST(n.d AS VARCHAR), symbol, 'left' FROM s JOIN n ON s.d = n.before WHERE NOT EXISTS (SELECT 1 FROM s x WHERE x.symbol = s.symbol AND x.d = n.d)""",
        "resolve_names": """
WITH q AS (SELECT DISTINCT split_part(security, ' ', 1) AS query FROM universe_membership UNION SELECT DISTINCT lower(symbol) FROM universe_membership), u AS (SELECT DISTINCT symbol, security FROM universe_membership),
h AS (SELECT query, 0 AS r, symbol FROM q JOIN u ON lower(symbol) = lower(query) UNION ALL SELECT query, 1, symbol FROM q JOIN u ON contains(lower(security), lower(query)))
SELECT query, symbol FROM h QUALIFY row_number() OVER (PARTITION BY query ORDER BY r, symbol) = 1""",
        "strata_sample": "SELECT stratum, id, stratum_size FROM (SELECT id, domain || '/' || source AS stratum, count(*) OVER (PARTITION BY domain || '/' || source) AS stratum_size, row_number() OVER (PARTITION BY domain || '/' || source ORDER BY md5(CAST(id AS VARCHAR) || ':54'), id) AS k FROM discovered_urls) WHERE k <= 8",
        "strata_rates": f"""
WITH {_PAIRS}, s AS (SELECT domain, domain || '/' || source AS stratum, count(*) AS n, count(*) FILTER (match_class <> stored_class) AS k FROM classed GROUP BY ALL),
w AS (SELECT *, n / sum(n) OVER (PARTITION BY domain) AS w, (k + 0.5) / (n + 1) AS p FROM s),
g AS (SELECT domain, CAST(sum(n) AS BIGINT) AS n, CAST(sum(k) AS BIGINT) AS n_wrong, sum(w * k / n) AS rate, 1.96 * sqrt(sum(w * w * p * (1 - p) / (n + 1))) AS half FROM w GROUP BY domain)
SELECT domain, n, n_wrong, round(rate, 6) AS rate, round(greatest(0.0, rate - half), 6) AS low, round(least(1.0, rate + half), 6) AS high FROM g""",
        "class_confusion": f"""
WITH {_PAIRS}, g AS (SELECT source, count(*) FILTER (match_class = 'accept' AND stored_class = 'accept') AS tp, count(*) FILTER (match_class = 'accept' AND stored_class <> 'accept') AS fp, count(*) FILTER (match_class <> 'accept' AND stored_class = 'accept') AS fn, count(*) FILTER (match_class <> 'accept' AND stored_class <> 'accept') AS tn FROM classed GROUP BY source)
SELECT *, CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 6) ELSE 0.0 END AS precision, CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) ELSE 0.0 END AS recall FROM g""",
        "wilson_by_source": """
WITH g AS (SELECT source, count(*) AS n, count(*) FILTER (status = 'failed') AS k FROM discovered_urls GROUP BY source), p AS (SELECT *, CAST(k AS DOUBLE) / n AS p, CAST(3.8416 AS DOUBLE) AS zz, CAST(1.96 AS DOUBLE) AS z FROM g)
SELECT source, n, k, round(greatest(CAST(0 AS DOUBLE), (p + zz / (2 * n)) / (1 + zz / n) - z * sqrt(p * (1 - p) / n + zz / (4.0 * n * n)) / (1 + zz / n)), 6) AS low,
  round(least(CAST(1 AS DOUBLE), (p + zz / (2 * n)) / (1 + zz / n) + z * sqrt(p * (1 - p) / n + zz / (4.0 * n * n)) / (1 + zz / n)), 6) AS high FROM p""",
        "top_tickers": "SELECT ticker, count(*) AS n FROM discovered_urls GROUP BY ticker ORDER BY n DESC, ticker LIMIT 20",
        "trading_sessions": "WITH " + _SESSIONS.format(first=2020, last=2027, start="2021-01-01", end="2025-12-31") + "SELECT CAST(day AS VARCHAR) AS day, row_number() OVER (ORDER BY day) AS n FROM sessions",
        "quiet_sessions": "WITH " + _SESSIONS.format(first=2023, last=2027, start="2024-01-01", end="2025-12-31") + "SELECT CAST(day AS VARCHAR) AS day FROM sessions WHERE day NOT IN (SELECT CAST(fetched_at AT TIME ZONE 'UTC' AS DATE) FROM articles WHERE fetched_at IS NOT NULL)",
        "date_windows": """
WITH w AS (SELECT CAST(d AS DATE) AS first, least(CAST(d AS DATE) + 6, DATE '2025-12-31') AS last FROM range(DATE '2024-01-01', DATE '2026-01-01', INTERVAL 7 DAY) t(d))
SELECT CAST(first AS VARCHAR) AS first, CAST(last AS VARCHAR) AS last, count(*) AS n FROM w JOIN (SELECT CAST(fetched_at AT TIME ZONE 'UTC' AS DATE) AS day FROM articles) ON day BETWEEN first AND last GROUP BY ALL""",
        "busiest_hour": "SELECT event_type, max(n) AS most FROM (SELECT event_type, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS n FROM events) GROUP BY event_type",
        "user_sessions": """
WITH m AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 1800000000 THEN 1 ELSE 0 END AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
r AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM m)
SELECT user_id, epoch_us(min(ts)) AS started, epoch_us(max(ts)) AS ended, count(*) AS n FROM r GROUP BY user_id, s""",
        "daily_change": "WITH g AS (SELECT event_type, CAST(ts AS DATE) AS day, sum(value) FILTER (NOT isnan(value)) AS total FROM events GROUP BY ALL) SELECT event_type, CAST(day AS VARCHAR) AS day, round(CASE WHEN b <> 0 THEN total / b - 1 END, 6) AS change FROM (SELECT *, lag(total) OVER (PARTITION BY event_type ORDER BY day) AS b FROM g)",
        "name_mentions": rf"""
WITH a AS (SELECT id, trim(regexp_replace(regexp_replace(lower(replace(company, '&', ' and ')), '\b(inc|corp|corporation|co|company|ltd|plc|llc|holdings|group|the|class [a-c])\b\.?', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS n, ' ' || {_words("body_text")} || ' ' AS b FROM articles WHERE body_text IS NOT NULL AND company IS NOT NULL)
SELECT id, CAST(len(string_split(b, ' ' || n || ' ')) - 1 AS INTEGER) AS mentions FROM a WHERE n <> ''""",
        "deletable_pairs": """
WITH c AS (SELECT domain FROM sitemap_crawls WHERE complete AND started_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY domain ORDER BY started_at DESC, entries DESC) = 1 AND entries > 0),
p AS (SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY domain || '/' || source ORDER BY md5(CAST(id AS VARCHAR) || ':54'), id) AS k FROM discovered_urls) WHERE k <= 8)
SELECT domain, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM discovered_urls WHERE match_class = 'reject' AND status = 'skipped' AND source = 'sitemap' AND domain IN (SELECT domain FROM c) AND id NOT IN (SELECT id FROM articles) AND id NOT IN (SELECT id FROM p) GROUP BY domain""",
        "rule_scores": rf"""
WITH p AS (SELECT d.url, d.company, d.ticker, d.match_class = 'accept' AS actual, coalesce(nullif(d.title, ''), a.title, '') AS title, coalesce(a.body_text, '') AS body FROM discovered_urls d JOIN articles a ON a.id = d.id),
c AS (SELECT *, trim(regexp_replace(regexp_replace(lower(company), '\b(inc|corp|corporation|co|company|ltd|plc|llc|holdings|group|the|class [a-c])\b\.?', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS nn,
  '\({_EXCHANGE}\s*:\s*' || ticker || '\)|{_EXCHANGE}\s*:\s*' || ticker || '($|[^A-Za-z0-9&-])|\$' || ticker || '($|[^A-Za-z0-9&-])' AS et FROM ({_company("SELECT * FROM p")})),
v AS (SELECT actual, (length(nn) >= 4 AND contains(' ' || regexp_replace(lower(url), '[^a-z0-9]+', ' ', 'g') || ' ' || regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g') || ' ', ' ' || nn || ' ')) OR regexp_matches(title, et) OR regexp_matches(body, et) AS named,
  fn <> '' AND len(string_split(' ' || {_words("body")} || ' ', ' ' || fn || ' ')) - 1 >= 2 AS twice,
  (NOT m_common AND length(ticker) >= 2 AND contains({_edges("title")}, ' ' || ticker || ' ')) OR coalesce(contains(lower({_edges("title")}), ' ' || lower(m_first) || ' '), false) AS signal FROM c),
r AS (SELECT actual, 'all' AS rule, true AS predicted FROM v UNION ALL SELECT actual, 'named', named FROM v UNION ALL SELECT actual, 'mentioned', named OR twice FROM v UNION ALL SELECT actual, 'signalled', named OR twice OR signal FROM v),
g AS (SELECT rule, count(*) FILTER (predicted AND actual) AS tp, count(*) FILTER (predicted AND NOT actual) AS fp, count(*) FILTER (NOT predicted AND actual) AS fn, count(*) FILTER (NOT predicted AND NOT actual) AS tn FROM r GROUP BY rule)
SELECT *, CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 6) ELSE 0.0 END AS precision, CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) ELSE 0.0 END AS recall FROM g""",
        "membership_spans": "WITH d AS (SELECT DISTINCT symbol, valid_from, valid_to FROM universe_membership WHERE symbol IN (SELECT symbol FROM universe_membership WHERE valid_to IS NOT NULL)) SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY valid_from, valid_to NULLS FIRST) AS n, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM d",
        "ticker_names": """
WITH q AS (SELECT ticker FROM discovered_urls WHERE ticker IS NOT NULL UNION SELECT ticker FROM articles WHERE ticker IS NOT NULL), n AS (SELECT symbol, min(security) AS name FROM universe_membership WHERE valid_to IS NULL GROUP BY symbol),
t AS (SELECT symbol, min(security) AS name FROM universe_membership WHERE valid_from <= DATE '2021-06-30' AND (valid_to IS NULL OR valid_to >= DATE '2021-06-30') GROUP BY symbol)
SELECT ticker, coalesce(n.name, t.name) AS name FROM q LEFT JOIN n ON n.symbol = ticker LEFT JOIN t ON t.symbol = ticker""",
        "label_stability": """
WITH r AS (SELECT DISTINCT CAST(replace(gics_revision_timestamp, 'Z', '') AS TIMESTAMP) AS ts, symbol, cik, lower(gics_sub_industry) AS label FROM universe_membership WHERE gics_revision_timestamp IS NOT NULL),
o AS (SELECT a.ts, a.symbol, a.cik, a.label, arg_max(b.label, (b.ts, b.label)) AS older, count(b.ts) AS k FROM r a LEFT JOIN r b ON b.symbol = a.symbol AND b.cik = a.cik AND b.ts <= a.ts - INTERVAL 30 DAY GROUP BY ALL)
SELECT CASE WHEN k = 0 THEN 'none older' WHEN older IS NOT DISTINCT FROM label THEN 'true' ELSE 'false' END AS same, count(*) AS n FROM o GROUP BY 1""",
        "run_summary": """
WITH e AS (SELECT domain, CAST(fetch_status_code AS VARCHAR) AS error, count(*) AS n FROM discovered_urls WHERE fetch_status_code >= 400 GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY -n, error) AS r, count(*) OVER (PARTITION BY domain) AS errors FROM e),
t AS (SELECT domain, max(errors) AS errors, string_agg(error || ' x' || n, '; ' ORDER BY r) FILTER (r <= 3) AS head FROM k GROUP BY domain)
SELECT d.domain, count(*) AS pairs, count(*) FILTER (status = 'done') AS inserted, coalesce(max(errors), 0) AS errors, coalesce(max(head) || CASE WHEN max(errors) > 3 THEN ' and ' || (max(errors) - 3) || ' more' ELSE '' END, '') AS summary FROM discovered_urls d LEFT JOIN t ON t.domain = d.domain GROUP BY d.domain""",
        "stream_hours": "SELECT epoch_us(date_trunc('hour', ts)) AS started, event_type, count(*) AS n FROM events GROUP BY ALL",
        "stream_queue": """
WITH r AS (SELECT *, CASE match_class WHEN 'reject' THEN 0 WHEN 'review' THEN 1 WHEN 'accept' THEN 2 END AS rank FROM discovered_urls)
SELECT url, ticker, CASE WHEN max(rank) = 0 THEN 'skipped' ELSE arg_min(status, id) END AS status, arg_min(match_class, (-rank, id)) AS match_class, arg_min(query, id) FILTER (query IS NOT NULL) AS query FROM r GROUP BY url, ticker""",
        "field_formats": r"""
WITH r AS (SELECT DISTINCT symbol, trim(cik) AS cik, coalesce(TRY_CAST(nullif(regexp_extract(date_added, '^\s*(\d{4}-\d{2}-\d{2})', 1), '') AS DATE), CAST(try_strptime(trim(date_added), '%B %d, %Y') AS DATE), CAST(try_strptime(trim(date_added), '%b %d, %Y') AS DATE)) AS added FROM roster_snapshots)
SELECT DISTINCT symbol, CASE WHEN regexp_matches(cik, '^[0-9]+$') THEN CASE WHEN length(cik) >= 10 THEN cik ELSE lpad(cik, 10, '0') END END AS cik, CAST(added AS VARCHAR) AS added,
  CASE WHEN n <= 1 THEN 'd' WHEN n <= 7 THEN 'w' WHEN n <= 31 THEN 'm' WHEN n <= 366 THEN 'y' END AS span FROM (SELECT *, date_diff('day', added, DATE '2025-06-30') AS n FROM r)""",
        "search_texts": "WITH p AS (SELECT DISTINCT domain, company, ticker FROM discovered_urls) SELECT DISTINCT domain, ticker, 'site:' || domain || ' ' || company || ' ' || ticker || ' ' || y AS query FROM p, range(2021, 2026) t(y) UNION SELECT domain, ticker, 'site:' || domain || ' \"' || company || '\"' FROM p",
        "name_presence": rf"""
WITH c AS ({_company("SELECT * FROM discovered_urls")}), x AS (SELECT *, '-' || regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1)), '[^a-z0-9]+', '-', 'g') || '-' AS p, trim(regexp_replace(regexp_replace(lower(company), '\b(inc|corp|corporation|co|company|ltd|plc|llc|holdings|group|the|class [a-c])\b\.?', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS nn FROM c)
SELECT match_class, count(*) AS n, count(*) FILTER (length(nn) >= 4 AND contains(' ' || regexp_replace(lower(url), '[^a-z0-9]+', ' ', 'g') || ' ' || regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', ' ', 'g') || ' ', ' ' || nn || ' ')) AS named,
  count(*) FILTER (len(list_filter(forms, lambda f: contains(p, '-' || replace(f, ' ', '-') || '-') OR contains(p, '-' || replace(f, ' ', '-') || 's-'))) > 0) AS slugged FROM x GROUP BY match_class""",
        "stored_presence": rf"""
WITH c AS (SELECT domain, max(started_at) AS last_start FROM sitemap_crawls WHERE complete GROUP BY domain), e AS (SELECT {_NORMAL} AS url, bool_or(last_seen IS NOT DISTINCT FROM last_start) AS now FROM sitemap_entries LEFT JOIN c USING (domain) GROUP BY 1),
d AS (SELECT DISTINCT {_NORMAL} AS url FROM discovered_urls)
SELECT coalesce(TRY_CAST(regexp_extract(d.url, '/((?:19|20)\d{{2}})/', 1) AS INTEGER), 0) AS year, CASE WHEN now THEN 'listed' WHEN e.url IS NOT NULL THEN 'left' ELSE 'never' END AS kind, count(*) AS n FROM d LEFT JOIN e ON d.url = e.url GROUP BY ALL""",
        "label_weights": """
WITH d AS (SELECT doc_id, coalesce(doc_type, '?') AS doc_type FROM documents), s AS (SELECT doc_type, count(*) AS size FROM d GROUP BY doc_type), r AS (SELECT doc_type, grade_level AS label FROM reading_labels JOIN d USING (doc_id)), n AS (SELECT doc_type, count(*) AS n FROM r GROUP BY doc_type)
SELECT r.doc_type, label, count(*) AS n, round(sum(size / n.n), 6) AS weight FROM r JOIN n USING (doc_type) JOIN s USING (doc_type) GROUP BY r.doc_type, label""",
        "stints_from_log": """
WITH s AS (SELECT DISTINCT upper(trim(symbol)) AS symbol, snapshot_date AS d FROM roster_snapshots), n AS (SELECT d, lead(d) OVER (ORDER BY d) AS after FROM (SELECT DISTINCT d FROM s)),
m AS (SELECT symbol, s.d, after, CASE WHEN lag(after) OVER (PARTITION BY symbol ORDER BY s.d) IS DISTINCT FROM s.d THEN 1 ELSE 0 END AS fresh FROM s JOIN n ON s.d = n.d), r AS (SELECT *, sum(fresh) OVER (PARTITION BY symbol ORDER BY d) AS run FROM m)
SELECT symbol, CAST(min(d) AS VARCHAR) AS valid_from, CASE WHEN bool_or(after IS NULL) THEN NULL ELSE CAST(max(after) - 1 AS VARCHAR) END AS valid_to FROM r GROUP BY symbol, run""",
        "last_revisions": """
WITH r AS (SELECT DISTINCT gics_revision_id AS revid, CAST(replace(gics_revision_timestamp, 'Z', '') AS TIMESTAMP) AS ts, symbol, cik FROM universe_membership WHERE gics_revision_timestamp IS NOT NULL),
s AS (SELECT DISTINCT symbol, cik, valid_from, valid_to FROM universe_membership WHERE valid_to IS NOT NULL),
b AS (SELECT s.*, arg_max(r.revid, (r.ts, r.revid)) AS revid, max(r.ts) AS ts FROM s JOIN r ON r.symbol = s.symbol AND r.cik = s.cik AND r.ts >= s.valid_from AND r.ts < s.valid_to + INTERVAL 1 DAY GROUP BY ALL),
d AS (SELECT b.symbol, b.cik, b.valid_from, b.valid_to, b.revid, count(t.ts) AS depth FROM b LEFT JOIN (SELECT DISTINCT revid, ts FROM r) t ON (t.ts > b.ts OR (t.ts = b.ts AND t.revid > b.revid)) AND t.ts < b.valid_to + INTERVAL 1 DAY GROUP BY ALL)
SELECT s.symbol, s.cik, CAST(s.valid_from AS VARCHAR) AS valid_from, CAST(s.valid_to AS VARCHAR) AS valid_to, revid, coalesce(depth, -1) AS depth FROM s LEFT JOIN d ON s.symbol = d.symbol AND s.cik = d.cik AND s.valid_from = d.valid_from AND s.valid_to = d.valid_to""",
    }
    from millrace import reader_queries, stored_queries

    return named | stored_queries.SQL | reader_queries.SQL
