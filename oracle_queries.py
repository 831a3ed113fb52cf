"""DuckDB oracle SQL for every registered query.

The fixture tables are re-derived here in plain SQL from the pre-registered
views (events, customer, documents, labels, conversations), independently of
the Spark code, so the comparison checks the Spark plans end to end.
"""

from __future__ import annotations

# ---- fixture CTEs (FIXTURES.md definitions, DuckDB dialect) ---------------
FX = {}

# score clamp: NULL or NaN (no integer) -> 0, else bounded to 0..100, truncated
CLAMP = ("CAST(CASE WHEN {x} IS NULL OR isnan(CAST({x} AS DOUBLE)) THEN 0 "
         "ELSE trunc(greatest(0, least(100, {x}))) END AS INTEGER)")

FX["fx_seen"] = f"""
SELECT user_id AS chat_id, event_id AS msg_id,
  CAST(CASE WHEN event_type IN ('purchase','signup') THEN 1
            WHEN event_type IN ('view','click') THEN 0 END AS INTEGER) AS is_vacancy,
  CASE WHEN event_type <> 'error' THEN {CLAMP.format(x="value")} END AS score,
  CASE WHEN event_type IN ('purchase','signup') AND {CLAMP.format(x="value")} >= 70
       THEN 1 ELSE 0 END AS posted,
  CASE WHEN event_type IN ('purchase','signup') THEN event_type || ' ' || CAST(event_id AS VARCHAR) END AS title,
  CAST(floor(epoch(ts)) AS BIGINT) AS ts
FROM events"""

FX["fx_channels_base"] = r"""
SELECT c_custkey AS chat_id,
  CASE WHEN c_custkey % 3 <> 0 THEN 'u' || CAST(c_custkey AS VARCHAR) END AS username,
  CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) ELSE upper(c_name) END AS title,
  CAST(NULL AS BIGINT) AS last_msg_ts
FROM customer"""

FX["fx_channels"] = r"""
SELECT b.chat_id, b.username, b.title, greatest(b.last_msg_ts, t.mts) AS last_msg_ts
FROM fx_channels_base b
LEFT JOIN (SELECT chat_id, max(ts) AS mts FROM fx_seen GROUP BY chat_id) t ON t.chat_id = b.chat_id"""

FX["fx_messages"] = r"""
SELECT CASE WHEN n % 4 = 0 THEN n ELSE -(1001000000000 + n) END AS chat_id,
  doc_id AS msg_id,
  1704067200 + doc_id * 60 - CASE WHEN doc_id % 97 = 5 THEN 3456000 ELSE 0 END AS date_s,
  text,
  CASE WHEN n % 5 = 1 THEN '' WHEN n % 5 = 2 THEN NULL ELSE 'src' || CAST(n AS VARCHAR) END AS chat_title,
  CASE WHEN n % 5 = 1 THEN 'h' || CAST(n AS VARCHAR) END AS chat_username,
  CAST(NULL AS VARCHAR) AS chat_first_name,
  a.source
FROM (SELECT doc_id, text, CAST(substr(source, 4) AS BIGINT) AS n FROM documents) d
JOIN (VALUES ('live'), ('backfill')) a(source)
  ON (a.source = 'live' AND d.doc_id % 3 <> 0)
  OR (a.source = 'backfill' AND (d.doc_id % 3 = 0 OR d.doc_id % 10 = 0))"""

# dependency order of the fixture CTEs
FX_ORDER = ["fx_seen", "fx_channels_base", "fx_channels", "fx_messages"]
FX_DEPS = {"fx_channels": ["fx_seen", "fx_channels_base"]}


def _with(needs: list[str], body: str) -> str:
    """Prefix ``body`` with the fixture CTEs it needs (and their dependencies)."""
    want: set[str] = set()

    def add(n):
        for d in FX_DEPS.get(n, []):
            add(d)
        want.add(n)

    for n in needs:
        add(n)
    extra_ctes = [n for n in FX_ORDER if n in want] + sorted(n for n in want if n not in FX_ORDER)
    ctes = ",\n".join(f"{n} AS ({FX[n]})" for n in extra_ctes)
    return f"WITH {ctes}\n{body}"


Q: dict[str, str] = {}

# ---- reports ---------------------------------------------------------------
_CI = "CAST(coalesce(sum(CASE WHEN {c} THEN 1 ELSE 0 END), 0) AS BIGINT)"

Q["overall_stats"] = _with(["fx_seen"], f"""
SELECT count(*) AS total,
  {_CI.format(c="is_vacancy = 1")} AS vacancies,
  {_CI.format(c="is_vacancy = 0")} AS not_vacancies,
  {_CI.format(c="posted = 1")} AS posted,
  max(ts) AS last_ts
FROM fx_seen""")

Q["channel_stats"] = _with(["fx_channels", "fx_seen"], f"""
SELECT c.chat_id, c.username, c.title, c.last_msg_ts,
  count(s.msg_id) AS total,
  {_CI.format(c="s.is_vacancy = 1")} AS vacancies,
  {_CI.format(c="s.posted = 1")} AS posted,
  round(avg(CASE WHEN s.is_vacancy = 1 THEN s.score END), 1) AS avg_score,
  CAST(coalesce(max(CASE WHEN s.is_vacancy = 1 THEN s.score ELSE 0 END), 0) AS INTEGER) AS max_score
FROM fx_channels c LEFT JOIN fx_seen s ON s.chat_id = c.chat_id
GROUP BY c.chat_id, c.username, c.title, c.last_msg_ts""")

_NOCASE = "translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

Q["channel_ranking"] = _with(["fx_channels", "fx_seen"], f"""
SELECT c.chat_id, c.username, c.title, c.last_msg_ts,
  count(s.msg_id) AS total,
  {_CI.format(c="s.is_vacancy = 1")} AS vacancies,
  {_CI.format(c="s.posted = 1")} AS posted,
  round(avg(CASE WHEN s.is_vacancy = 1 THEN s.score END), 1) AS avg_score,
  CAST(coalesce(max(CASE WHEN s.is_vacancy = 1 THEN s.score ELSE 0 END), 0) AS INTEGER) AS max_score,
  row_number() OVER (ORDER BY {_NOCASE.format(c="c.title")} ASC NULLS FIRST, c.chat_id ASC) AS rank
FROM fx_channels c LEFT JOIN fx_seen s ON s.chat_id = c.chat_id
GROUP BY c.chat_id, c.username, c.title, c.last_msg_ts""")

Q["dashboard_cards"] = _with(["fx_seen", "fx_channels"], f"""
, o AS (SELECT count(*) AS v0, {_CI.format(c="is_vacancy = 1")} AS v1,
               {_CI.format(c="is_vacancy = 0")} AS v2, {_CI.format(c="posted = 1")} AS v3 FROM fx_seen),
  ch AS (SELECT count(*) AS v4 FROM fx_channels)
SELECT 0 AS position, 'Total seen' AS card, v0 AS value, 'all' AS filter_type FROM o
UNION ALL SELECT 1, 'Vacancies', v1, 'vacancies' FROM o
UNION ALL SELECT 2, 'Not vacancies', v2, 'not_vacancies' FROM o
UNION ALL SELECT 3, 'Posted (matched)', v3, 'posted' FROM o
UNION ALL SELECT 4, 'Channels tracked', v4, CAST(NULL AS VARCHAR) FROM ch""").replace("\n\n, o AS", ", o AS")


def _list_sql(where: str, limit: int) -> str:
    return _with(["fx_seen", "fx_channels"], f"""
SELECT s.ts, s.chat_id, c.username AS channel_username, c.title AS channel_title, s.title, s.score,
  CAST(s.is_vacancy AS BOOLEAN) AS is_vacancy, (s.posted <> 0) AS posted, s.msg_id
FROM fx_seen s LEFT JOIN fx_channels c ON c.chat_id = s.chat_id
WHERE {where}
ORDER BY s.ts DESC, s.chat_id DESC, s.msg_id DESC
LIMIT {limit}""")


Q["list_messages"] = _list_sql("1=1", 200)
Q["list_vacancies"] = _list_sql("s.is_vacancy = 1", 200)
Q["list_not_vacancies"] = _list_sql("s.is_vacancy = 0", 200)
Q["list_posted"] = _list_sql("s.posted = 1", 200)
Q["list_by_channel"] = _list_sql("s.is_vacancy = 1 AND s.chat_id = 7", 300)

_LINK = ("CASE WHEN {c} IS NOT NULL AND {m} IS NOT NULL AND CAST({c} AS VARCHAR) LIKE '-100%' "
         "THEN 'https://t.me/c/' || substr(CAST({c} AS VARCHAR), 5) || '/' || CAST({m} AS VARCHAR) END")
_FMT_TS = ("CASE WHEN coalesce({t}, 0) = 0 THEN '—' "
           "ELSE strftime(make_timestamp({t} * 1000000), '%Y-%m-%d %H:%M') || ' UTC' END")

Q["message_listing"] = f"""
SELECT chat_id, msg_id,
  {_FMT_TS.format(t="ts")} AS time,
  CASE WHEN nullif(channel_username, '') IS NOT NULL
       THEN coalesce(nullif(title, ''), nullif(channel_title, ''), '?') || ' (@' || channel_username || ')'
       ELSE coalesce(nullif(title, ''), nullif(channel_title, ''), '?') END AS channel,
  coalesce(nullif(title, ''), '—') AS title,
  coalesce(CAST(score AS VARCHAR), '—') AS score,
  coalesce(nullif(concat_ws(' ', CASE WHEN posted THEN 'posted' END,
                            CASE WHEN is_vacancy THEN 'vacancy' WHEN NOT is_vacancy THEN 'not vacancy' END), ''),
           '—') AS tags,
  coalesce({_LINK.format(c="chat_id", m="msg_id")}, '—') AS link
FROM ({_list_sql("1=1", 300)}) l"""

Q["recent_matches"] = _with(["fx_seen", "fx_channels"], """
SELECT s.ts, s.chat_id, c.username AS channel_username, c.title AS channel_title, s.title, s.score, s.msg_id
FROM fx_seen s LEFT JOIN fx_channels c ON c.chat_id = s.chat_id
WHERE s.posted = 1
ORDER BY s.ts DESC, s.chat_id DESC, s.msg_id DESC
LIMIT 20""")

_RECENT_30 = Q["recent_matches"].replace("LIMIT 20", "LIMIT 30")

Q["recent_table"] = f"""
SELECT chat_id, msg_id,
  {_FMT_TS.format(t="ts")} AS time,
  coalesce(nullif(channel_title, ''), CAST(chat_id AS VARCHAR)) AS channel,
  coalesce(nullif(title, ''), '—') AS title,
  score,
  {_LINK.format(c="chat_id", m="msg_id")} AS link
FROM ({_RECENT_30}) r"""

Q["channel_table"] = f"""
SELECT chat_id, rank,
  CASE WHEN nullif(username, '') IS NOT NULL THEN coalesce(nullif(title, ''), '?') || ' (@' || username || ')'
       ELSE coalesce(nullif(title, ''), '?') END AS channel,
  total, vacancies, posted,
  coalesce(CAST(avg_score AS VARCHAR), '—') AS avg_score,
  max_score,
  {_FMT_TS.format(t="last_msg_ts")} AS last
FROM ({Q["channel_ranking"]}) x"""

Q["list_page_titles"] = _with(["fx_channels"], """
SELECT c.chat_id, f.filter_type,
  CASE WHEN nullif(c.username, '') IS NOT NULL THEN coalesce(nullif(c.title, ''), '?') || ' (@' || c.username || ')'
       ELSE coalesce(nullif(c.title, ''), '?') END || ' · ' || f.flabel AS title
FROM fx_channels c,
  (VALUES ('all', 'All messages'), ('vacancies', 'Vacancies'), ('not_vacancies', 'Not vacancies'),
          ('posted', 'Posted matches')) f(filter_type, flabel)""")

# ---- message-side fixtures ------------------------------------------------------
# Python's str.strip() whitespace (fixed values): U+0009-U+000D, U+001C-U+0020,
# U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
_WS_CODES = ([*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
WS = "(" + " || ".join(f"chr({c})" for c in _WS_CODES) + ")"
LETTER = r"'[\p{L}\p{Nl}\p{No}]'"


def _worth(t: str) -> str:
    return f"(length({t}) >= 40 AND regexp_matches({t}, {LETTER}))"


FX["fx_norm"] = f"""
SELECT chat_id, msg_id, date_s, trim(coalesce(text, ''), {WS}) AS text,
  CASE WHEN source = 'backfill'
       THEN coalesce(nullif(chat_title, ''), nullif(chat_username, ''), CAST(chat_id AS VARCHAR), '?')
       ELSE coalesce(nullif(chat_title, ''), nullif(chat_username, ''), nullif(chat_first_name, ''),
                     CAST(chat_id AS VARCHAR), 'unknown') END AS chat_title,
  chat_title AS raw_title, chat_username, source,
  length(trim(coalesce(text, ''), {WS})) AS n_chars
FROM fx_messages"""

_RANK = ("row_number() OVER (PARTITION BY chat_id, msg_id ORDER BY "
         "CASE source WHEN 'live' THEN 0 WHEN 'backfill' THEN 1 ELSE 2 END, date_s NULLS LAST, text NULLS LAST)")

FX["fx_arrivals"] = f"SELECT *, {_RANK} = 1 AS is_primary FROM fx_norm"
FX["fx_first"] = "SELECT * EXCLUDE (is_primary) FROM fx_arrivals WHERE is_primary"

FX["fx_directory"] = r"""
SELECT DISTINCT CASE WHEN n % 4 = 0 THEN n ELSE -(1001000000000 + n) END AS chat_id, source AS handle
FROM (SELECT source, CAST(substr(source, 4) AS BIGINT) AS n FROM documents) d"""

FX["fx_entries"] = r"""
SELECT n * 10 AS pos,
  CASE n % 5 WHEN 0 THEN CAST(CASE WHEN n % 4 = 0 THEN n ELSE -(1001000000000 + n) END AS VARCHAR)
             WHEN 1 THEN '"@src' || CAST(n AS VARCHAR) || '"'
             WHEN 2 THEN '" @src' || CAST(n AS VARCHAR) || ' "'
             WHEN 3 THEN '"@missing' || CAST(n AS VARCHAR) || '"'
             ELSE CAST(CASE WHEN n % 4 = 0 THEN n ELSE -(1001000000000 + n) END AS VARCHAR) END AS entry
FROM (SELECT DISTINCT CAST(substr(source, 4) AS BIGINT) AS n FROM documents) s
UNION ALL
SELECT n * 10 + 1, '"  "' FROM (SELECT DISTINCT CAST(substr(source, 4) AS BIGINT) AS n FROM documents) s WHERE n % 7 = 6
UNION ALL
SELECT n * 10 + 2, CAST(n AS VARCHAR) || '.5'
FROM (SELECT DISTINCT CAST(substr(source, 4) AS BIGINT) AS n FROM documents) s WHERE n % 7 = 6"""

FX["fx_sources"] = f"""
SELECT pos,
  CASE WHEN t IN ('BIGINT', 'UBIGINT', 'BOOLEAN') THEN 'id'
       WHEN t = 'VARCHAR' AND length(trim(entry ->> '$', {WS})) > 0 THEN 'handle'
       ELSE 'invalid' END AS kind,
  CASE WHEN t = 'VARCHAR' AND length(trim(entry ->> '$', {WS})) > 0 THEN trim(entry ->> '$', {WS}) END AS username,
  CASE WHEN t IN ('BIGINT', 'UBIGINT') THEN CAST(entry AS BIGINT)
       WHEN t = 'BOOLEAN' THEN CASE WHEN CAST(entry AS BOOLEAN) THEN 1 ELSE 0 END END AS chat_id
FROM (SELECT pos, entry, CASE WHEN json_valid(entry) THEN json_type(entry) END AS t FROM fx_entries) e"""

FX["fx_resolved"] = """
SELECT s.pos, d.chat_id, d.handle FROM fx_sources s JOIN fx_directory d
  ON s.kind = 'handle' AND lower(regexp_replace(s.username, '^@', '')) = lower(regexp_replace(d.handle, '^@', ''))
UNION ALL
SELECT s.pos, d.chat_id, d.handle FROM fx_sources s JOIN fx_directory d ON s.kind = 'id' AND s.chat_id = d.chat_id"""

FX["fx_eval"] = """
SELECT m.chat_id, m.msg_id,
  CASE WHEN m.msg_id % 50 = 7 THEN 'crash' WHEN l.quality IS NULL THEN 'transient' ELSE 'ok' END AS call_status,
  (l.quality = 1) AS is_vacancy,
  'Role ' || CAST(m.msg_id AS VARCHAR) AS title,
  CAST((m.msg_id * 37) % 101 AS INTEGER) AS match_score,
  CASE WHEN l.toxic = 1 THEN ['toxic'] ELSE CAST([] AS VARCHAR[]) END AS red_flags
FROM (SELECT DISTINCT chat_id, msg_id FROM fx_messages) m
LEFT JOIN labels l ON l.doc_id = m.msg_id"""

FX["fx_answers"] = r"""
SELECT user_id AS chat_id, event_id AS msg_id,
  CASE event_id % 10
    WHEN 0 THEN '```json' || chr(10) || '{"is_vacancy": true, "match_score": ' || k || '}' || chr(10) || '```'
    WHEN 1 THEN '{"is_vacancy": true, "match_score": ' || k || '} thanks'
    WHEN 2 THEN '{"is_vacancy": true, "match_score": "' || k || '"}'
    WHEN 3 THEN '{"is_vacancy": true, "match_score": ' || k || '.5}'
    WHEN 4 THEN '{"is_vacancy": true, "match_score": ' || k3 || '}'
    WHEN 5 THEN '{"is_vacancy": true, "match_score": -' || k || '}'
    WHEN 6 THEN '{"match_score": ' || k || ', "title": 7, "company": null, "grade": "wizard", "remote": "moon", "should_apply": true}'
    WHEN 7 THEN '[{"match_score": ' || k || '}]'
    WHEN 8 THEN '{"is_vacancy": true, "match_score": ' || k || ', "title": "Dev ' || k || '", "company": "Acme", "stack": ["Go", null, "", "Kafka"], '
      || '"grade": "senior", "salary": "' || k3 || ' EUR", "remote": "full", "reasoning": " One. Two! Three? Four. ", '
      || '"red_flags": ["late ' || k || '", ""], "should_apply": "false"}'
    ELSE '{"is_vacancy": false, "match_score": 0}' END AS raw
FROM (SELECT *, CAST(CAST(regexp_extract(props, '-?[0-9]+') AS BIGINT) AS VARCHAR) AS k,
             CAST(CAST(regexp_extract(props, '-?[0-9]+') AS BIGINT) * 3 AS VARCHAR) AS k3 FROM events) e"""

FX_ORDER += ["fx_norm", "fx_arrivals", "fx_first", "fx_directory", "fx_entries", "fx_sources",
             "fx_resolved", "fx_eval", "fx_answers"]
FX_DEPS.update({
    "fx_norm": ["fx_messages"], "fx_arrivals": ["fx_norm"], "fx_first": ["fx_arrivals"],
    "fx_sources": ["fx_entries"], "fx_resolved": ["fx_sources", "fx_directory"],
    "fx_eval": ["fx_messages"],
})

# ---- ingest and text -----------------------------------------------------------
Q["messages_normalized"] = _with(["fx_norm"], "SELECT chat_id, msg_id, source, chat_title, text, n_chars FROM fx_norm")
Q["prefilter"] = _with(["fx_norm"], f"SELECT chat_id, msg_id, source, n_chars FROM fx_norm WHERE {_worth('text')}")
Q["chat_titles"] = _with(["fx_messages"], """
SELECT chat_id,
  coalesce(nullif(chat_title, ''), nullif(chat_username, ''), nullif(chat_first_name, ''),
           CAST(chat_id AS VARCHAR), 'unknown') AS live_title,
  coalesce(nullif(chat_title, ''), nullif(chat_username, ''), CAST(chat_id AS VARCHAR)) AS registration_title,
  coalesce(nullif(chat_title, ''), nullif(chat_username, ''), CAST(chat_id AS VARCHAR), '?') AS backfill_title
FROM (SELECT DISTINCT chat_id, chat_title, chat_username, chat_first_name FROM fx_messages) m""")
Q["source_links"] = _with(["fx_messages"], f"""
SELECT chat_id, msg_id, {_LINK.format(c="chat_id", m="msg_id")} AS link
FROM (SELECT DISTINCT chat_id, msg_id FROM fx_messages) m""")
Q["markdown_escape"] = _with(["fx_messages"], r"""
SELECT chat_id, msg_id, escaped, length(escaped) - length(text) AS n_escaped
FROM (SELECT chat_id, msg_id, text, regexp_replace(text, '([\\*_`\[])', '\\\1', 'g') AS escaped
      FROM (SELECT DISTINCT chat_id, msg_id, text FROM fx_messages) m) e""")
Q["sources_normalized"] = _with(["fx_sources"], "SELECT pos, kind, username, chat_id FROM fx_sources")
Q["resolved_sources"] = _with(["fx_resolved"], "SELECT pos, chat_id, handle FROM fx_resolved")
Q["unresolved_sources"] = _with(["fx_resolved"], """
SELECT pos, kind, username, chat_id FROM fx_sources
WHERE kind <> 'invalid' AND pos NOT IN (SELECT pos FROM fx_resolved)""")
Q["allowlisted_messages"] = _with(["fx_resolved", "fx_messages"], """
SELECT chat_id, msg_id, source FROM fx_messages WHERE chat_id IN (SELECT chat_id FROM fx_resolved)""")

# ---- dedup, backfill, state ------------------------------------------------------
_BACKFILL_IN = f"""
, live_seen AS (SELECT chat_id, msg_id FROM fx_norm WHERE source = 'live'),
  incoming AS (SELECT * FROM (SELECT *, {_RANK} AS rn FROM fx_norm WHERE source = 'backfill') x WHERE rn = 1)"""
Q["unseen_messages"] = _with(["fx_norm"], _BACKFILL_IN + """
SELECT i.chat_id, i.msg_id, i.source, i.n_chars FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM live_seen s WHERE s.chat_id = i.chat_id AND s.msg_id = i.msg_id)""")
Q["dedup_skips"] = _with(["fx_norm"], _BACKFILL_IN + """
SELECT i.chat_id, i.msg_id, i.source FROM incoming i
WHERE EXISTS (SELECT 1 FROM live_seen s WHERE s.chat_id = i.chat_id AND s.msg_id = i.msg_id)""")

_BACKFILLED = """
, head AS (SELECT *, row_number() OVER (PARTITION BY chat_id ORDER BY msg_id DESC) AS rn FROM fx_first),
  capped AS (SELECT *, max(CASE WHEN date_s < 1704067200 THEN msg_id END) OVER (PARTITION BY chat_id) AS stop
             FROM head WHERE rn <= 20),
  backfilled AS (SELECT * FROM capped WHERE stop IS NULL OR msg_id > stop)"""
Q["backfill_scan"] = _with(["fx_first"], _BACKFILLED + """
SELECT chat_id, msg_id, date_s,
  coalesce(nullif(raw_title, ''), nullif(chat_username, ''), CAST(chat_id AS VARCHAR), '?') AS title
FROM backfilled""")
Q["backfill_scan_default"] = _with(["fx_first"], _BACKFILLED.replace("rn <= 20)", "rn <= 200)") + """
SELECT chat_id, msg_id, date_s,
  coalesce(nullif(raw_title, ''), nullif(chat_username, ''), CAST(chat_id AS VARCHAR), '?') AS title
FROM backfilled""")
Q["backfill_counts"] = _with(["fx_first", "fx_directory"], _BACKFILLED + """
SELECT d.chat_id, d.handle, count(b.msg_id) AS n_scanned
FROM fx_directory d LEFT JOIN backfilled b ON b.chat_id = d.chat_id
GROUP BY d.chat_id, d.handle""")

Q["seen_upsert"] = _with(["fx_seen"], """
, log AS (
  SELECT *, 0 AS batch FROM fx_seen
  UNION ALL
  SELECT user_id, event_id, 1, 100, 1, 'rescored', CAST(floor(epoch(ts)) AS BIGINT) + 86400, 1
  FROM events WHERE value > 300
  UNION ALL
  SELECT user_id, event_id, CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), 0, CAST(NULL AS VARCHAR),
         CAST(floor(epoch(ts)) AS BIGINT), 2
  FROM events WHERE event_type = 'click' AND value < 1)
SELECT chat_id, msg_id, is_vacancy, score, posted, title, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY chat_id, msg_id ORDER BY ts DESC, batch DESC) AS rn FROM log) x
WHERE rn = 1""")

Q["channels_upsert"] = _with(["fx_channels", "fx_messages"], """
, regs0 AS (
  SELECT DISTINCT chat_id, chat_username AS username,
    coalesce(nullif(chat_title, ''), nullif(chat_username, ''), CAST(chat_id AS VARCHAR)) AS title, 0 AS seq
  FROM fx_messages
  UNION ALL
  SELECT c_custkey, CAST(NULL AS VARCHAR), c_name, 1 FROM customer WHERE c_acctbal < 0),
  regs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chat_id
             ORDER BY seq DESC, username DESC NULLS LAST, title DESC NULLS LAST) AS rn FROM regs0) x WHERE rn = 1)
SELECT c.chat_id, r.username, r.title, c.last_msg_ts FROM fx_channels c JOIN regs r ON r.chat_id = c.chat_id
UNION ALL
SELECT c.chat_id, c.username, c.title, c.last_msg_ts FROM fx_channels c
WHERE c.chat_id NOT IN (SELECT chat_id FROM regs)
UNION ALL
SELECT r.chat_id, r.username, r.title, CAST(NULL AS BIGINT) FROM regs r
WHERE r.chat_id NOT IN (SELECT chat_id FROM fx_channels)""")

Q["channels_touch"] = _with(["fx_channels_base", "fx_seen", "fx_messages"], """
, touches AS (SELECT chat_id, ts FROM fx_seen UNION ALL SELECT chat_id, date_s FROM fx_messages)
SELECT b.chat_id, b.username, b.title, greatest(b.last_msg_ts, t.mts) AS last_msg_ts
FROM fx_channels_base b LEFT JOIN (SELECT chat_id, max(ts) AS mts FROM touches GROUP BY chat_id) t
  ON t.chat_id = b.chat_id""")

Q["schema_evolve"] = _with(["fx_seen"], """
SELECT chat_id, msg_id, CAST(NULL AS INTEGER) AS is_vacancy, score, posted, CAST(NULL AS VARCHAR) AS title, ts
FROM fx_seen WHERE ts < 1705276800
UNION ALL
SELECT chat_id, msg_id, is_vacancy, score, posted, title, ts FROM fx_seen WHERE ts >= 1705276800""")

# ---- answers and scoring ---------------------------------------------------------
Q["score_clamp"] = f"""
SELECT event_id AS msg_id, value - 50 AS raw_score,
  {CLAMP.format(x="value - 50")} AS score
FROM events"""


def _truthy(j: str) -> str:
    """Python truthiness of a JSON value j (NULL = absent)."""
    return (f"(CASE WHEN {j} IS NULL THEN false "
            f"WHEN json_type({j}) = 'NULL' THEN false "
            f"WHEN json_type({j}) = 'BOOLEAN' THEN CAST({j} AS BOOLEAN) "
            f"WHEN json_type({j}) IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN CAST({j} AS DOUBLE) <> 0 "
            f"WHEN json_type({j}) = 'VARCHAR' THEN length({j} ->> '$') > 0 "
            f"WHEN json_type({j}) = 'ARRAY' THEN json_array_length({j}) > 0 "
            f"WHEN json_type({j}) = 'OBJECT' THEN len(json_keys({j})) > 0 "
            f"ELSE true END)")


def _pystr(j: str) -> str:
    return (f"(CASE WHEN json_type({j}) = 'BOOLEAN' THEN CASE WHEN CAST({j} AS BOOLEAN) THEN 'True' ELSE 'False' END "
            f"WHEN json_type({j}) = 'VARCHAR' THEN {j} ->> '$' ELSE CAST({j} AS VARCHAR) END)")


def _text(field: str, default: str) -> str:
    j = f"json_extract(r, '$.{field}')"
    return f"CASE WHEN {_truthy(j)} THEN {_pystr(j)} ELSE '{default}' END"


def _list(field: str) -> str:
    j = f"json_extract(r, '$.{field}')"
    return (f"CASE WHEN NOT {_truthy(j)} THEN CAST([] AS VARCHAR[]) "
            f"WHEN json_type({j}) = 'ARRAY' THEN list_transform(list_filter(json_extract(r, '$.{field}[*]'), "
            f"lambda x: {_truthy('x')}), lambda x: {_pystr('x')}) END")


def _score(j: str) -> str:
    s = f"trim({j} ->> '$')"
    return (f"(CASE WHEN {j} IS NULL OR json_type({j}) = 'NULL' THEN 0 "
            f"WHEN json_type({j}) = 'BOOLEAN' THEN CASE WHEN CAST({j} AS BOOLEAN) THEN 1 ELSE 0 END "
            f"WHEN json_type({j}) IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN "
            f"CAST(trunc(greatest(0, least(100, CAST({j} AS DOUBLE)))) AS INTEGER) "
            f"WHEN json_type({j}) = 'VARCHAR' THEN CASE WHEN regexp_full_match({s}, '[+-]?[0-9]+') "
            f"THEN CAST(greatest(0, least(100, TRY_CAST({s} AS BIGINT))) AS INTEGER) ELSE 0 END "
            f"ELSE 0 END)")


_PARSED = f"""
, a AS (SELECT chat_id, msg_id, coalesce(raw, '{{}}') AS r FROM fx_answers),
  b AS (SELECT *, json_valid(r) AS valid, CASE WHEN json_valid(r) THEN json_type(r) END AS top FROM a),
  c AS (SELECT *, CASE WHEN NOT valid THEN 'parse_error' WHEN top <> 'OBJECT' THEN 'crash' ELSE 'ok' END AS st FROM b),
  parsed AS (
  SELECT chat_id, msg_id, st AS parse_status,
    CASE st WHEN 'ok' THEN {_truthy("json_extract(r, '$.is_vacancy')")} WHEN 'parse_error' THEN false END AS is_vacancy,
    CASE st WHEN 'ok' THEN {_text('title', '')} WHEN 'parse_error' THEN '' END AS title,
    CASE st WHEN 'ok' THEN {_text('company', '')} WHEN 'parse_error' THEN '' END AS company,
    CASE st WHEN 'ok' THEN {_list('stack')} WHEN 'parse_error' THEN CAST([] AS VARCHAR[]) END AS stack,
    CASE st WHEN 'ok' THEN {_text('grade', 'unknown')} WHEN 'parse_error' THEN 'unknown' END AS grade,
    CASE st WHEN 'ok' THEN {_text('salary', '')} WHEN 'parse_error' THEN '' END AS salary,
    CASE st WHEN 'ok' THEN {_text('remote', 'unknown')} WHEN 'parse_error' THEN 'unknown' END AS remote,
    CASE st WHEN 'ok' THEN {_score("json_extract(r, '$.match_score')")} WHEN 'parse_error' THEN 0 END AS match_score,
    CASE st WHEN 'ok' THEN trim({_text('reasoning', '')}, {WS}) WHEN 'parse_error' THEN 'parse_error' END AS reasoning,
    CASE st WHEN 'ok' THEN {_list('red_flags')} WHEN 'parse_error' THEN CAST([] AS VARCHAR[]) END AS red_flags,
    CASE st WHEN 'ok' THEN {_truthy("json_extract(r, '$.should_apply')")} WHEN 'parse_error' THEN false END AS should_apply
  FROM c)"""

Q["parsed_answers"] = _with(["fx_answers"], _PARSED + """
SELECT chat_id, msg_id, parse_status, is_vacancy, title, company, array_to_string(stack, '|') AS stack,
  CAST(len(stack) AS INTEGER) AS n_stack, grade, salary, remote, match_score, reasoning,
  array_to_string(red_flags, '|') AS red_flags, should_apply
FROM parsed""")

Q["parse_status"] = _with(["fx_answers"], _PARSED + """
SELECT disposition, count(*) AS n FROM (
  SELECT CASE WHEN parse_status <> 'ok' THEN parse_status WHEN NOT is_vacancy THEN 'not_vacancy'
              WHEN match_score < 70 THEN 'below_threshold' ELSE 'posted' END AS disposition FROM parsed) x
GROUP BY disposition""")

_N = "CAST(coalesce(sum(CASE WHEN {c} THEN 1 ELSE 0 END), 0) AS BIGINT)"
_SENTENCES = ("(len(regexp_extract_all({x}, '[.!?\u2026]+(?:[ \t\n\r\f]|$)')) "
              "+ CASE WHEN length({x}) > 0 AND NOT regexp_matches({x}, '[.!?\u2026]$') THEN 1 ELSE 0 END)")

Q["contract_checks"] = _with(["fx_answers"], _PARSED + f"""
SELECT count(*) AS answers,
  {_N.format(c="grade NOT IN ('junior','middle','senior','staff','lead','unknown')")} AS bad_grade,
  {_N.format(c="remote NOT IN ('full','hybrid','onsite','unknown')")} AS bad_remote,
  {_N.format(c="match_score < 0 OR match_score > 100")} AS bad_score,
  {_N.format(c="should_apply <> (match_score >= 70 AND len(red_flags) = 0)")} AS apply_mismatch,
  {_N.format(c="match_score >= 70 AND len(red_flags) = 0")} AS apply_by_rule,
  {_N.format(c="is_vacancy")} AS vacancies,
  {_N.format(c="NOT is_vacancy AND match_score <> 0")} AS scored_non_vacancy,
  {_N.format(c=_SENTENCES.format(x="reasoning") + " > 2")} AS long_reasoning
FROM parsed WHERE parse_status = 'ok'""")

Q["call_outcomes"] = """
SELECT chat_id, msg_id, http_status, call_status,
  CASE WHEN call_status = 'transient' THEN 3 ELSE 1 END AS attempts,
  CASE WHEN call_status = 'transient' THEN 7 ELSE 0 END AS backoff_s
FROM (SELECT *, CASE WHEN http_status BETWEEN 200 AND 299 THEN 'ok'
                     WHEN http_status IS NULL OR http_status = 429 OR http_status >= 500 THEN 'transient'
                     ELSE 'crash' END AS call_status
      FROM (SELECT user_id AS chat_id, event_id AS msg_id,
              CAST(CASE event_id % 8 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 503 WHEN 3 THEN NULL
                   WHEN 4 THEN 400 WHEN 5 THEN 401 ELSE 200 END AS INTEGER) AS http_status FROM events) e) x"""

Q["inference_requests"] = _with(["fx_first"], f"""
SELECT chat_id, msg_id,
  '<source_chat>' || chat_title || '</source_chat>' || chr(10) || '<message>' || chr(10) || text || chr(10)
  || '</message>' || chr(10) || chr(10) || 'Return ONLY valid JSON matching the schema.' AS request
FROM fx_first WHERE {_worth('text')}""")

# scoring rules (FIXTURES.md fx_rules), fixed values:
# (rule_id, kind, pattern, weight) = (1, signal, the, 25), (2, signal, que, 30),
# (3, signal, der, 20), (4, hard, [0-9], -20), (5, blocker, @, -40); base 30,
# hard cap 39, blocker cap 29.
_RULES = """(VALUES (1, 'signal', 'the', 25), (2, 'signal', 'que', 30), (3, 'signal', 'der', 20),
                 (4, 'hard', '[0-9]', -20), (5, 'blocker', '@', -40)) r(rule_id, kind, pattern, weight)"""

Q["rule_hits"] = f"""
SELECT d.doc_id, r.rule_id, r.kind, r.pattern, r.weight
FROM documents d JOIN {_RULES} ON regexp_matches(d.text, r.pattern)"""


def _rule_score_sql(key: str, src: str, text: str = "text") -> str:
    return f"""
SELECT {key}, CAST(coalesce(sum(CASE WHEN r.kind = 'signal' AND h THEN 1 ELSE 0 END), 0) AS INTEGER) AS n_signals,
  coalesce(bool_or(r.kind = 'hard' AND h), false) AS any_hard,
  coalesce(bool_or(r.kind = 'blocker' AND h), false) AS any_blocker,
  CAST(30 + sum(CASE WHEN h THEN r.weight ELSE 0 END) AS INTEGER) AS raw_score
FROM (SELECT {key}, r.*, regexp_matches(s.{text}, r.pattern) AS h FROM {src} s, {_RULES}) r
GROUP BY {key}"""


_CAPPED = ("CAST(CASE WHEN any_blocker THEN least(greatest(0, least(100, raw_score)), 29) "
           "WHEN any_hard THEN least(greatest(0, least(100, raw_score)), 39) "
           "ELSE greatest(0, least(100, raw_score)) END AS INTEGER)")

Q["rule_scores"] = f"""
SELECT doc_id, n_signals, any_hard, any_blocker, raw_score, {_CAPPED} AS rule_score
FROM ({_rule_score_sql('doc_id', 'documents')}) x"""

Q["usage_totals"] = """
SELECT user_id AS chat_id, count(*) AS calls,
  CAST(sum(event_id % 700) AS BIGINT) AS input_tokens, CAST(sum(event_id % 600) AS BIGINT) AS output_tokens,
  CAST(sum(event_id % 5 * 100) AS BIGINT) AS cache_read_tokens, CAST(sum(event_id % 3 * 50) AS BIGINT) AS cache_create_tokens
FROM events GROUP BY user_id"""

# ---- routing and end to end ------------------------------------------------------
def _dispo(text: str, call: str, parse: str, vac: str, score: str) -> str:
    return (f"CASE WHEN NOT {_worth(text)} THEN 'too_short' WHEN {call} = 'transient' THEN 'transient' "
            f"WHEN {call} = 'crash' OR {parse} = 'crash' THEN 'crash' WHEN {parse} = 'parse_error' THEN 'parse_error' "
            f"WHEN NOT coalesce({vac}, false) THEN 'not_vacancy' WHEN {score} < 70 THEN 'below_threshold' "
            f"ELSE 'posted' END")


_OUT = """
  CAST(CASE WHEN disposition IN ('below_threshold', 'posted') THEN 1
            WHEN disposition IN ('too_short', 'parse_error', 'not_vacancy') THEN 0 END AS INTEGER) AS is_vacancy,
  CAST(CASE WHEN disposition IN ('parse_error', 'not_vacancy', 'below_threshold', 'posted') THEN match_score END
       AS INTEGER) AS score,
  CASE WHEN disposition = 'posted' THEN 1 ELSE 0 END AS posted,
  CASE WHEN disposition IN ('below_threshold', 'posted') THEN title END AS title"""

_ROUTED_FX = f"""
, routed AS (
  SELECT f.*, e.call_status, e.is_vacancy AS eval_vacancy, e.match_score, e.title AS eval_title, e.red_flags,
    {_dispo('f.text', 'e.call_status', "'ok'", 'e.is_vacancy', 'e.match_score')} AS disposition
  FROM fx_first f JOIN fx_eval e ON e.chat_id = f.chat_id AND e.msg_id = f.msg_id)"""

Q["dispositions"] = _with(["fx_first", "fx_eval"], _ROUTED_FX + f"""
SELECT chat_id, msg_id, disposition, {_OUT.replace('title END', 'eval_title END')},
  disposition <> 'transient' AS recorded
FROM routed""")

Q["disposition_funnel"] = _with(["fx_arrivals", "fx_first", "fx_eval"], _ROUTED_FX + """
SELECT a.source, CASE WHEN a.is_primary THEN r.disposition WHEN r.disposition = 'transient' THEN 'transient'
                      ELSE 'dedup_skip' END AS disposition, count(*) AS n
FROM fx_arrivals a LEFT JOIN routed r ON r.chat_id = a.chat_id AND r.msg_id = a.msg_id
GROUP BY 1, 2""")

_ESC = r"regexp_replace({x}, '([\\*_`\[])', '\\\1', 'g')"


def _esc(x: str) -> str:
    return _ESC.format(x=x)


Q["match_cards"] = _with(["fx_first", "fx_eval"], _ROUTED_FX + f"""
SELECT chat_id, msg_id, match_score AS score,
  '*' || {_esc("coalesce(nullif(eval_title, ''), 'Vacancy')")} || '*' || chr(10)
  || 'Score: ' || CAST(match_score AS VARCHAR) || '/100 · grade: unknown · remote: unknown' || chr(10)
  || 'Stack: —' || chr(10)
  || 'Salary: —' || chr(10)
  || 'Red flags: ' || {_esc("CASE WHEN len(red_flags) > 0 THEN array_to_string(red_flags, ', ') ELSE '—' END")}
  || chr(10) || chr(10) || chr(10) || chr(10)
  || 'Source: ' || {_esc('chat_title')}
  || coalesce(' · ' || {_LINK.format(c="chat_id", m="msg_id")}, '') AS card,
  {_LINK.format(c="chat_id", m="msg_id")} AS source_link
FROM routed WHERE disposition = 'posted'""")

Q["triage_end_to_end"] = _with(["fx_first", "fx_seen"], f"""
, fresh AS (SELECT * FROM fx_first f
            WHERE NOT EXISTS (SELECT 1 FROM fx_seen s WHERE s.chat_id = f.chat_id AND s.msg_id = f.msg_id)),
  scored AS (SELECT chat_id, msg_id, n_signals > 0 AS is_vac, {_CAPPED} AS match_score
             FROM ({_rule_score_sql('chat_id, msg_id', 'fresh')}) x),
  routed AS (SELECT f.chat_id, f.msg_id, f.source, '' AS title, s.match_score,
               {_dispo('f.text', "'ok'", "'ok'", 's.is_vac', 's.match_score')} AS disposition
             FROM fresh f JOIN scored s ON s.chat_id = f.chat_id AND s.msg_id = f.msg_id)
SELECT chat_id, msg_id, source, disposition, {_OUT} FROM routed
UNION ALL
SELECT f.chat_id, f.msg_id, f.source, 'dedup_skip', CAST(NULL AS INTEGER), CAST(NULL AS INTEGER),
       CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR)
FROM fx_first f WHERE EXISTS (SELECT 1 FROM fx_seen s WHERE s.chat_id = f.chat_id AND s.msg_id = f.msg_id)""")

# ---- streaming ---------------------------------------------------------------------
Q["stream_triage"] = f"""
WITH conv AS (SELECT conv_id AS chat_id, turn AS msg_id, trim(coalesce(text, ''), {WS}) AS text FROM conversations),
  fresh AS (SELECT DISTINCT * FROM conv c
            WHERE NOT EXISTS (SELECT 1 FROM conversations s WHERE s.turn = 0 AND s.conv_id = c.chat_id
                                                            AND s.turn = c.msg_id)),
  scored AS (SELECT chat_id, msg_id, n_signals > 0 AS is_vac, {_CAPPED} AS match_score
             FROM ({_rule_score_sql('chat_id, msg_id', 'fresh')}) x),
  routed AS (SELECT f.chat_id, f.msg_id, 'live' AS source, '' AS title, s.match_score,
               {_dispo('f.text', "CASE WHEN f.chat_id % 50 = 7 THEN 'transient' ELSE 'ok' END", "'ok'", 's.is_vac', 's.match_score')} AS disposition
             FROM fresh f JOIN scored s ON s.chat_id = f.chat_id AND s.msg_id = f.msg_id)
SELECT chat_id, msg_id, source, disposition, {_OUT} FROM routed"""

Q["scorer_hook"] = _with(["fx_first"], f"""
, e AS (
  SELECT chat_id, msg_id, text, length(text) AS n,
    CASE msg_id % 8 WHEN 0 THEN 'transient' WHEN 3 THEN 'transient' WHEN 5 THEN 'crash' ELSE 'ok' END AS call_status,
    CASE WHEN msg_id % 5 = 2 THEN 'parse_error' ELSE 'ok' END AS parse_status,
    msg_id % 5 <> 1 AS is_vac,
    CASE msg_id % 5 WHEN 0 THEN length(text) % 101 WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN length(text) % 101
         ELSE least(100, (7 * length(text)) % 150) END AS match_score,
    CASE WHEN msg_id % 5 = 0 THEN 'Role ' || CAST(msg_id AS VARCHAR) ELSE '' END AS title
  FROM fx_first),
  routed AS (SELECT *, {_dispo('text', 'call_status', 'parse_status', 'is_vac', 'match_score')} AS disposition FROM e)
SELECT chat_id, msg_id, disposition, {_OUT} FROM routed""")

_CODE = ("CAST(CASE ({e}) % 8 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 503 WHEN 3 THEN NULL "
         "WHEN 4 THEN 400 WHEN 5 THEN 401 ELSE 200 END AS INTEGER)")


def _ok(x: str) -> str:
    return f"coalesce({x} BETWEEN 200 AND 299, false)"


def _fatal(x: str) -> str:
    return f"coalesce(NOT ({x} BETWEEN 200 AND 299) AND {x} <> 429 AND {x} < 500, false)"


Q["call_attempts"] = f"""
WITH a AS (SELECT user_id AS chat_id, event_id AS msg_id, {_CODE.format(e='event_id')} AS s1,
             {_CODE.format(e='event_id + 1')} AS s2, {_CODE.format(e='event_id + 2')} AS s3 FROM events),
  b AS (SELECT *, CASE WHEN {_ok('s1')} THEN 1 WHEN {_ok('s2')} AND NOT {_fatal('s1')} THEN 2
                       WHEN {_ok('s3')} AND NOT {_fatal('s1')} AND NOT {_fatal('s2')} THEN 3 ELSE 0 END AS ok_at,
               CASE WHEN {_fatal('s1')} THEN 1 WHEN {_fatal('s2')} THEN 2 WHEN {_fatal('s3')} THEN 3 ELSE 0 END AS crash_at
        FROM a)
SELECT chat_id, msg_id,
  coalesce(CAST(s1 AS VARCHAR), 'none') || ',' || coalesce(CAST(s2 AS VARCHAR), 'none') || ','
    || coalesce(CAST(s3 AS VARCHAR), 'none') AS statuses,
  CASE WHEN ok_at > 0 AND (crash_at = 0 OR ok_at < crash_at) THEN 'ok' WHEN crash_at > 0 THEN 'crash'
       ELSE 'transient' END AS call_status,
  CAST(CASE WHEN ok_at > 0 AND (crash_at = 0 OR ok_at < crash_at) THEN ok_at WHEN crash_at > 0 THEN crash_at
       ELSE 3 END AS INTEGER) AS attempts,
  CAST(CASE WHEN ok_at > 0 AND (crash_at = 0 OR ok_at < crash_at) THEN pow(2, ok_at - 1) - 1
            WHEN crash_at > 0 THEN pow(2, crash_at - 1) - 1 ELSE 7 END AS INTEGER) AS backoff_s
FROM b"""

# ---- logs, sources and the assembled jobs ------------------------------------------
# of the replayed log the later run counts: only clicks recorded again changed
Q["seen_latest"] = _with(["fx_seen"], """
SELECT chat_id, msg_id, is_vacancy, CASE WHEN msg_id % 4 = 1 THEN CAST(msg_id % 100 AS INTEGER) ELSE score END AS score,
  posted, title, ts FROM fx_seen""")
Q["overall_stats_log"] = Q["overall_stats"]
Q["seen_since"] = _with(["fx_seen"], "SELECT * FROM fx_seen WHERE ts >= 1705276800")
Q["channel_scan"] = _with(["fx_channels"], "SELECT chat_id, username, title, last_msg_ts FROM fx_channels")
Q["allowlist_file"] = _with(["fx_sources"], """
SELECT CAST(row_number() OVER (ORDER BY pos) - 1 AS INTEGER) AS pos, kind, username, chat_id FROM fx_sources WHERE kind <> 'invalid'""")
Q["channel_arguments"] = _with(["fx_directory"], f"""
, a AS (SELECT DISTINCT unnest([CAST(chat_id AS VARCHAR), handle, ' @' || handle || ' ', '+' || CAST(abs(chat_id) AS VARCHAR)]) AS argument
        FROM fx_directory),
  b AS (SELECT argument, trim(argument, {WS}) AS s FROM a),
  c AS (SELECT *, s LIKE '-%' OR regexp_full_match(s, '[0-9]+') AS numeric FROM b)
SELECT argument, CASE WHEN numeric THEN TRY_CAST(s AS BIGINT) END AS chat_id, CASE WHEN NOT numeric THEN s END AS username,
  NOT numeric OR TRY_CAST(s AS BIGINT) IS NOT NULL AS valid FROM c""")
Q["list_unknown_type"] = Q["list_messages"]
Q["union_arrivals"] = _with(["fx_messages"], """
SELECT chat_id, source, count(*) AS n, min(msg_id) AS first, max(msg_id) AS last FROM fx_messages GROUP BY chat_id, source""")
Q["empty_answers"] = """
SELECT user_id AS chat_id, event_id AS msg_id, 'ok' AS parse_status, false AS is_vacancy, 'unknown' AS grade, 'unknown' AS remote,
  0 AS match_score, 0 AS n_stack FROM events WHERE event_id % 10 >= 5"""
# the scan reads on while no message so far, from the newest, was older than the cutoff
Q["backfill_job"] = _with(["fx_first", "fx_messages", "fx_resolved"], f"""
, history AS (SELECT * FROM (SELECT DISTINCT chat_id, msg_id, date_s FROM fx_messages WHERE source = 'backfill') m
              WHERE chat_id IN (SELECT chat_id FROM fx_resolved)),
  scan AS (SELECT *, row_number() OVER newest AS rn,
                  max(CASE WHEN date_s < 1704067200 THEN 1 ELSE 0 END) OVER newest AS stopped
           FROM history WINDOW newest AS (PARTITION BY chat_id ORDER BY msg_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  keys AS (SELECT chat_id, msg_id FROM scan WHERE rn <= 20 AND stopped = 0
           UNION SELECT chat_id, msg_id FROM fx_messages WHERE source = 'live' AND chat_id IN (SELECT chat_id FROM fx_resolved)),
  fresh AS (SELECT f.* FROM fx_first f JOIN keys USING (chat_id, msg_id)),
  scored AS (SELECT chat_id, msg_id, n_signals > 0 AS is_vac, {_CAPPED} AS match_score
             FROM ({_rule_score_sql('chat_id, msg_id', 'fresh')}) x),
  routed AS (SELECT f.chat_id, f.msg_id, '' AS title, s.match_score,
               {_dispo('f.text', "'ok'", "'ok'", 's.is_vac', 's.match_score')} AS disposition
             FROM fresh f JOIN scored s ON s.chat_id = f.chat_id AND s.msg_id = f.msg_id)
SELECT chat_id, msg_id, {_OUT}, CAST(1704067200 AS BIGINT) AS ts FROM routed""")

# ---- rules, ledgers, marks, cells ----------------------------------------------------
# profile texts of FIXTURES.md, line by line: section and heading are those of the last line that set them
FX["fx_profiles"] = """
SELECT p_partkey AS profile_id, '# Profile' || n || n || '## 1. Grade' || n || n || '**Middle**' || n || n || '- not a rule' || n || n || '## 5. Work Format' || n || n
  || '| Option | Status |' || n || '|---|---|' || n || '| ' || p_name || ' | Priority |' || n || '| ' || p_type || ' | No - not considering |' || n
  || '| ' || p_brand || ' only | Hard blocker |' || n || n || '## 8. Hard Blockers - not wanted' || n || n || '### Roles' || n
  || '- Requires ' || p_name || ' / ' || p_type || ' as core skill' || n || '- x' || n || n || '## 10. Evaluation' || n || n
  || '**Immediate disqualifiers (match_score < 30):**' || n || '- ' || p_brand || ' (licence), ' || p_type || ' or size ' || p_size || n || n
  || '**Mismatch (match_score < 40):**' || n || '* ' || p_type || n || n || '**Strong signals (match_score 75+):**' || n
  || '- Mentions of ' || p_name || ', ' || p_brand || ' or platform' || n || '- AI/ML product' || n AS text
FROM part, (SELECT chr(10) AS n) c"""
Q["profile_rules"] = _with(["fx_profiles"], r"""
, lines AS (SELECT profile_id, k, x[k + 1] AS line FROM (SELECT profile_id, x, unnest(range(len(x))) AS k FROM (SELECT profile_id, string_split(text, chr(10)) AS x FROM fx_profiles))),
  parts AS (SELECT *, CASE WHEN line LIKE '## %' THEN regexp_replace(line, '^## +(\d+\. *)?', '') END AS sec,
              CASE WHEN line LIKE '## %' THEN '' WHEN line LIKE '### %' THEN substr(line, 5)
                   WHEN line LIKE '**%' THEN rtrim(trim(line, '*'), ':') END AS head FROM lines),
  held AS (SELECT *, last_value(sec IGNORE NULLS) OVER w AS section, last_value(head IGNORE NULLS) OVER w AS heading FROM parts
           WINDOW w AS (PARTITION BY profile_id ORDER BY k)),
  items AS (SELECT *, CASE WHEN line LIKE '|%' THEN trim(string_split(line, '|')[2]) ELSE regexp_extract(line, '^[-*] +(.*)$', 1) END AS item,
              CASE WHEN line LIKE '|%' THEN lower(trim(string_split(line, '|')[3])) END AS status,
              try_cast(regexp_extract(heading, 'match_score < (\d+)', 1) AS INTEGER) AS below, try_cast(regexp_extract(heading, 'match_score (\d+)\+', 1) AS INTEGER) AS above
            FROM held WHERE line LIKE '|%' OR regexp_matches(line, '^[-*] +')),
  told AS (SELECT *, CASE WHEN status IS NOT NULL THEN CASE WHEN contains(status, 'hard blocker') THEN 'blocker' WHEN regexp_matches(status, '^no\b') THEN 'hard' END
                          WHEN below IS NOT NULL THEN CASE WHEN below <= 30 THEN 'blocker' ELSE 'hard' END WHEN above IS NOT NULL THEN 'signal'
                          WHEN contains(lower(section), 'blocker') THEN 'blocker' END AS kind FROM items),
  cut AS (SELECT *, regexp_split_to_array(regexp_replace(item, '\(.*$', ''), '\s*/\s*|\s*,\s*|\s+or\s+') AS alt FROM told WHERE kind IS NOT NULL),
  each AS (SELECT *, trim(regexp_replace(alt[t + 1], '^(Requires|Mentions of|Roles that require)\s+', '')) AS term FROM (SELECT *, unnest(range(len(alt))) AS t FROM cut))
SELECT profile_id, CAST(row_number() OVER (PARTITION BY profile_id ORDER BY k, t) AS INTEGER) AS rule_id, section, heading, kind,
  '(?i)' || CASE WHEN regexp_matches(term, '^\w') THEN '\b' ELSE '' END || regexp_replace(term, '([^\p{L}\p{N} ])', '\\\1', 'g')
    || CASE WHEN regexp_matches(term, '\w$') THEN '\b' ELSE '' END AS pattern,
  CAST(CASE kind WHEN 'signal' THEN ceil((above - 30) / 3.0) WHEN 'hard' THEN -20 ELSE -40 END AS INTEGER) AS weight
FROM each WHERE length(term) >= 2""")

Q["rule_hits_many"] = """
WITH words AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-z]{6,}')) AS pattern FROM benchmark)
SELECT pattern, count(*) AS n_docs, min(doc_id) AS first_doc FROM words JOIN documents ON contains(text, pattern) GROUP BY pattern"""

# a message is evaluated in the run it arrives with, then in each later one until it is not transient
Q["retry_ledger"] = _with(["fx_first"], f"""
, m AS (SELECT chat_id, msg_id, msg_id % 5 = 4 AS late, {_worth('text')} AS worth FROM fx_first),
  t AS (SELECT *, worth AND msg_id % 8 < 4 AS t0, worth AND (msg_id + 1) % 8 < 4 AS t1, worth AND (msg_id + 2) % 8 < 4 AS t2 FROM m)
SELECT chat_id, msg_id,
  CASE WHEN late THEN CASE WHEN t2 THEN 'waiting' ELSE 'recorded' END WHEN t0 AND t1 AND t2 THEN 'given up' ELSE 'recorded' END AS state,
  CAST(CASE WHEN late AND t2 THEN 1 WHEN NOT late AND t0 AND t1 AND t2 THEN 3 END AS INTEGER) AS tries,
  CAST(CASE WHEN late THEN CASE WHEN t2 THEN 1500 ELSE 1400 END WHEN NOT t0 THEN 1000 WHEN NOT t1 THEN 1150 WHEN NOT t2 THEN 1400 END AS BIGINT) AS at
FROM t""")


def _backfill_of(name: str, where: str) -> str:
    return f"""
  {name}_head AS (SELECT *, row_number() OVER (PARTITION BY chat_id ORDER BY msg_id DESC) AS rn FROM fx_first WHERE {where}),
  {name}_stop AS (SELECT *, max(CASE WHEN date_s < 1704067200 THEN msg_id END) OVER (PARTITION BY chat_id) AS stop FROM {name}_head WHERE rn <= 20),
  {name} AS (SELECT * EXCLUDE (rn, stop) FROM {name}_stop WHERE stop IS NULL OR msg_id > stop)"""


# both backfills read everything; what the first one recorded the second one skips
Q["backfill_marked"] = _with(["fx_first"], f"""
, {_backfill_of('b1', 'msg_id <= (SELECT max(doc_id) * 6 // 10 FROM documents)')}, {_backfill_of('b2', 'true')},
  fresh AS (SELECT *, 100 AS ts FROM b1 UNION ALL SELECT *, 200 FROM b2 WHERE (chat_id, msg_id) NOT IN (SELECT (chat_id, msg_id) FROM b1)),
  scored AS (SELECT chat_id, msg_id, n_signals > 0 AS is_vac, {_CAPPED} AS match_score FROM ({_rule_score_sql('chat_id, msg_id', 'fresh')}) x),
  routed AS (SELECT f.chat_id, f.msg_id, f.ts, '' AS title, s.match_score, {_dispo('f.text', "'ok'", "'ok'", 's.is_vac', 's.match_score')} AS disposition
             FROM fresh f JOIN scored s ON s.chat_id = f.chat_id AND s.msg_id = f.msg_id)
SELECT chat_id, msg_id, {_OUT}, CAST(ts AS BIGINT) AS ts FROM routed""")

Q["triage_bucketed"] = Q["triage_end_to_end"]
Q["overall_stats_cells"] = Q["overall_stats"]
Q["channel_stats_cells"] = Q["channel_stats"].replace("LEFT JOIN fx_seen s", """LEFT JOIN (SELECT * REPLACE (
  CASE WHEN msg_id % 4 = 1 THEN CAST(msg_id % 100 AS INTEGER) ELSE score END AS score) FROM fx_seen) s""")
Q["seen_compacted_days"] = _with(["fx_seen"], """
SELECT chat_id, msg_id, is_vacancy, CASE WHEN msg_id % 4 = 1 THEN CAST(msg_id % 100 AS INTEGER) ELSE score END AS score, posted, title,
  ts + CASE WHEN msg_id % 4 IN (1, 2) THEN 86400 ELSE 0 END AS ts, CAST(CASE WHEN msg_id % 4 IN (1, 2) THEN 2 ELSE 1 END AS BIGINT) AS run FROM fx_seen""")

Q["stream_cards"] = f"""
WITH conv AS (SELECT DISTINCT conv_id AS chat_id, turn AS msg_id, trim(coalesce(text, ''), {WS}) AS text FROM conversations),
  scored AS (SELECT chat_id, msg_id, n_signals > 0 AS is_vac, {_CAPPED} AS match_score FROM ({_rule_score_sql('chat_id, msg_id', 'conv')}) x),
  routed AS (SELECT f.chat_id, f.msg_id, '' AS title, s.match_score, {_dispo('f.text', "'ok'", "'ok'", 's.is_vac', 's.match_score')} AS disposition
             FROM conv f JOIN scored s ON s.chat_id = f.chat_id AND s.msg_id = f.msg_id)
SELECT chat_id, msg_id, is_vacancy, score, posted, CAST(1704067200 AS BIGINT) AS ts, CASE WHEN posted = 1 THEN score END AS card_score,
  CASE WHEN posted = 1 THEN '*Vacancy*' || chr(10) || 'Score: ' || score || '/100 · grade: unknown · remote: unknown' || chr(10) || 'Stack: —' || chr(10)
    || 'Salary: —' || chr(10) || 'Red flags: —' || chr(10) || chr(10) || chr(10) || chr(10) || 'Source: ' || chat_id END AS card,
  CAST(NULL AS VARCHAR) AS source_link
FROM (SELECT chat_id, msg_id, {_OUT} FROM routed)"""
