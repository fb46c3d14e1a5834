"""DuckDB oracle SQL for the registered queries.

Written from the semantics, not from our Spark code: the raw-event mapping of
``sources.synthetic`` is applied directly to ``events`` columns (a JSON round
trip is the identity), and every rule is restated in plain SQL.  Counts are
cast to BIGINT (DuckDB sums widen) and timestamps leave as
``%Y-%m-%d %H:%M:%S`` text.
"""

from __future__ import annotations

FMT = "'%Y-%m-%d %H:%M:%S'"

# parsed events (fixed mapping, see sources.synthetic)
EV = """ev AS (
  SELECT event_id,
         CAST(user_id % 40 AS VARCHAR) AS wiki,
         event_type,
         event_id % 5 = 0 AS bot,
         event_id % 3 = 0 AS is_minor,
         CAST(epoch_us(ts) // 1000000 AS BIGINT) AS sec
  FROM events)"""

LK = """lk AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS lk_wiki_key, n_name AS lk_wiki_label, r_name AS lk_language
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _window_end(seconds: int) -> str:
    return f"(TIMESTAMP '1970-01-01 00:00:00' + to_seconds((sec // {seconds} + 1) * {seconds}))"


def _totals_cte(seconds: int = 86_400, threshold: int = 15, name: str = "totals") -> str:
    return f"""tot_{name} AS (
  SELECT {_window_end(seconds)} AS window_end, wiki,
         COUNT(*) AS n, COUNT(*) FILTER (WHERE bot) AS b
  FROM ev GROUP BY 1, 2),
{name} AS (
  SELECT window_end, wiki,
         COALESCE(lk_wiki_label, wiki) AS wiki_label,
         COALESCE(lk_language, 'unknown') AS language,
         CAST(n AS BIGINT) AS edit_count, CAST(b AS BIGINT) AS bot_count,
         CAST(n - b AS BIGINT) AS human_count, n >= {threshold} AS anomaly_flag,
         window_end + INTERVAL 2 MINUTE AS updated_at
  FROM tot_{name} LEFT JOIN lk ON wiki = lk_wiki_key)"""


ACTIONS = f"""act AS (
  SELECT {_window_end(86_400)} AS window_end, wiki, event_type,
         COUNT(*) AS n, COUNT(*) FILTER (WHERE bot) AS b, COUNT(*) FILTER (WHERE is_minor) AS m
  FROM ev GROUP BY 1, 2, 3),
actions AS (
  SELECT window_end, wiki,
         COALESCE(lk_wiki_label, wiki) AS wiki_label,
         COALESCE(lk_language, 'unknown') AS language,
         event_type,
         CAST(n AS BIGINT) AS event_count, CAST(b AS BIGINT) AS bot_count,
         CAST(n - b AS BIGINT) AS human_count, CAST(m AS BIGINT) AS minor_count,
         window_end + INTERVAL 2 MINUTE AS updated_at
  FROM act LEFT JOIN lk ON wiki = lk_wiki_key)"""

TOTALS = _totals_cte()

# the middle of the time range, in whole seconds, and the watermark that the first file leaves
_HALVES = """half AS (
  SELECT mid, (SELECT MAX(sec) FROM ev WHERE sec < mid AND event_id % 7 <> 0) - 120 AS watermark
  FROM (SELECT (MIN(sec) + MAX(sec)) // 2 AS mid FROM ev))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


TOTALS_OUT = f"""strftime(window_end, {FMT}) AS window_end, wiki, wiki_label, language,
       edit_count, bot_count, human_count, anomaly_flag"""
TOTALS_OUT_UPDATED = TOTALS_OUT + f", strftime(updated_at, {FMT}) AS updated_at"
ACTIONS_OUT = f"""strftime(window_end, {FMT}) AS window_end, wiki, wiki_label, language, event_type,
       event_count, bot_count, human_count, minor_count"""
ACTIONS_OUT_UPDATED = ACTIONS_OUT + f", strftime(updated_at, {FMT}) AS updated_at"

# perturbed raw events of required_fields / epoch_normalise (fixed rules):
# wiki missing when event_id % 6 = 0, timestamp as a JSON string when % 10 = 0,
# text that is not JSON when % 14 = 0, epoch times 1e6 (out of range) when % 97 = 0.
KEPT_PERTURBED = "NOT (event_id % 6 = 0 OR event_id % 10 = 0 OR event_id % 14 = 0 OR event_id % 97 = 0)"

EPOCH_TS = """CASE WHEN event_id % 2 = 0 THEN CAST(epoch_us(ts) AS DOUBLE) / CAST(1000 AS DOUBLE)
                 ELSE CAST(epoch_us(ts) AS DOUBLE) / CAST(1000000 AS DOUBLE) END"""


ORACLE_SQL: dict[str, str] = {
    "event_parse": f"""
SELECT event_id, CAST(user_id % 40 AS VARCHAR) AS wiki, event_type AS type, event_id % 5 = 0 AS bot,
       {EPOCH_TS} AS event_unix_ts
FROM events""",
    "minor_flag": "SELECT event_id, event_id % 3 = 0 AS is_minor FROM events",
    "required_fields": f"""
SELECT event_id, CAST(user_id % 40 AS VARCHAR) AS wiki, strftime(ts, {FMT}) AS event_ts
FROM events WHERE {KEPT_PERTURBED}""",
    "epoch_normalise": f"""
SELECT event_id, event_unix_ts,
       CASE WHEN event_unix_ts > 1e12 THEN event_unix_ts / CAST(1000 AS DOUBLE) ELSE event_unix_ts END
         AS event_unix_sec,
       event_ts
FROM (SELECT event_id, {EPOCH_TS} AS event_unix_ts, strftime(ts, {FMT}) AS event_ts
      FROM events WHERE {KEPT_PERTURBED})""",
    "type_normalise": """
SELECT event_id,
       CASE WHEN event_id % 17 = 0 THEN rpad(event_type || '-', 80, 'x')
            WHEN event_id % 8 = 0 THEN 'unknown'
            WHEN event_id % 6 = 0 THEN 'unknown'
            ELSE event_type END AS event_type
FROM events""",
    "partition_cols": _with(EV, LK, _totals_cte(3_600, 15, "hourly")) + f"""
SELECT strftime(window_end, {FMT}) AS window_end_ts, strftime(window_end, '%Y-%m-%d') AS ds,
       strftime(window_end, '%H') AS hr, wiki, edit_count
FROM hourly""",
    "message_key": """
SELECT event_id,
       CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0
            THEN CASE WHEN event_id = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END
            ELSE 'u-' || CAST(event_id AS VARCHAR) END AS message_key
FROM events""",
    "feed_clean": """
SELECT event_id, reject_reason IS NULL AS accepted, reject_reason
FROM (SELECT event_id,
             CASE WHEN event_id % 9 = 0 THEN 'event'
                  WHEN event_id % 13 = 0 THEN 'bad_json'
                  WHEN event_id % 10 = 0 THEN 'done'
                  WHEN event_id % 16 = 5 THEN 'done'
                  WHEN event_id % 16 = 9 THEN 'bad_json' END AS reject_reason
      FROM events)""",
    "message_key_forms": """
SELECT event_id, CASE event_id % 12
  WHEN 0 THEN CASE WHEN event_id = 0 THEN NULL  -- 0.0 is falsy
                   ELSE event_id || '.0' END
  WHEN 1 THEN (event_id % 9 + 1) || 'e+20'
  WHEN 2 THEN rpad('9' || event_id, 50, '7')
  WHEN 3 THEN 'r' || event_id
  WHEN 4 THEN '0'
  WHEN 6 THEN 'True'
  WHEN 7 THEN 'f' || event_id
  WHEN 8 THEN 'n' || event_id
  WHEN 9 THEN CAST(event_id AS VARCHAR)
  WHEN 11 THEN (event_id % 9 + 1) || 'e-07' END AS message_key
FROM events""",
    # the key of each message, the last id its value names, and whether the value starts and ends as an object
    "publish_payload": """
WITH lines AS (
  SELECT event_id,
         CASE WHEN event_id % 9 = 0 THEN 'event'
              WHEN event_id % 13 = 0 THEN 'bad_json'
              WHEN event_id % 10 = 0 THEN 'done'
              WHEN event_id % 16 = 5 THEN 'done'
              WHEN event_id % 16 = 9 THEN 'bad_json'
              WHEN event_id % 16 = 11 THEN 'not_object' END AS reject_reason
  FROM events),
sent AS (
  SELECT CASE WHEN event_id % 16 IN (1, 3, 7) THEN NULLIF(CAST(event_id AS VARCHAR), '0')
              WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN NULLIF(CAST(event_id AS VARCHAR), '0')
              ELSE 'u-' || event_id END AS message_key,
         CAST(event_id AS BIGINT) AS value_id
  FROM lines WHERE reject_reason IS NULL)
SELECT message_key, value_id, TRUE AS whole, CAST(COUNT(*) AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS reject_reason
FROM sent GROUP BY message_key, value_id
UNION ALL
SELECT NULL, NULL, NULL, CAST(COUNT(*) AS BIGINT), reject_reason FROM lines WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
    "lookup_csv": _with(LK) + "SELECT lk_wiki_key, lk_wiki_label, lk_language FROM lk",
    "lookup_dim": _with(LK) + "SELECT lk_wiki_key, lk_wiki_label, lk_language FROM lk",
    "lookup_dup_keys": """
SELECT CAST(n_nationkey AS VARCHAR) AS lk_wiki_key, CAST(2 AS BIGINT) AS copies
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 3""",
    "enrich_join": _with(EV, LK) + """
SELECT event_id, wiki, COALESCE(lk_wiki_label, wiki) AS wiki_label, COALESCE(lk_language, 'unknown') AS language
FROM ev LEFT JOIN lk ON wiki = lk_wiki_key""",
    "totals_rollup": _with(EV, LK, TOTALS) + f"SELECT {TOTALS_OUT} FROM totals",
    "actions_rollup": _with(EV, LK, ACTIONS) + f"SELECT {ACTIONS_OUT} FROM actions",
    "totals_from_actions": _with(EV, LK, TOTALS) + f"SELECT {TOTALS_OUT} FROM totals",
    "contract_violations": _with(EV, LK, ACTIONS) + """
SELECT rule, violations FROM (
  SELECT 'wiki_too_long' AS rule, CAST(COUNT(*) FILTER (WHERE length(wiki) > 1) AS BIGINT) AS violations FROM actions
  UNION ALL
  SELECT 'event_type_too_long', CAST(COUNT(*) FILTER (WHERE length(event_type) > 5) AS BIGINT) FROM actions
  UNION ALL
  SELECT 'null_key', CAST(COUNT(*) FILTER (WHERE window_end IS NULL OR wiki IS NULL OR event_type IS NULL) AS BIGINT)
  FROM actions
  UNION ALL
  SELECT 'wiki_label_too_long', CAST(COUNT(*) FILTER (WHERE length(wiki_label) > 512) AS BIGINT) FROM actions
  UNION ALL
  SELECT 'language_too_long', CAST(COUNT(*) FILTER (WHERE length(language) > 32) AS BIGINT) FROM actions
  UNION ALL
  SELECT 'duplicate_key', CAST(COUNT(*) AS BIGINT) FROM (
    SELECT window_end, wiki, event_type FROM actions GROUP BY ALL HAVING COUNT(*) > 1)
) WHERE violations > 0""",
    "upsert_latest_totals": _with(EV, LK, TOTALS) + f"""
SELECT strftime(window_end, {FMT}) AS window_end, wiki, wiki_label, language,
       edit_count, bot_count, human_count, anomaly_flag,
       strftime(window_end + INTERVAL 3 MINUTE, {FMT}) AS updated_at, CAST(1 AS BIGINT) AS batch_id
FROM totals""",
    "upsert_latest_actions": _with(EV, LK, ACTIONS) + f"""
SELECT {ACTIONS_OUT},
       strftime(window_end + INTERVAL 3 MINUTE, {FMT}) AS updated_at, CAST(1 AS BIGINT) AS batch_id
FROM actions""",
    "current_incremental": _with(EV, LK, TOTALS) + f"""
SELECT {TOTALS_OUT}, strftime(window_end + INTERVAL 4 MINUTE, {FMT}) AS updated_at, CAST(1 AS BIGINT) AS batch_id FROM totals""",
    "backfill_totals": _with(EV, LK, TOTALS) + f"SELECT {TOTALS_OUT} FROM totals",
    "backfill_actions": _with(EV, LK, ACTIONS) + f"SELECT {ACTIONS_OUT} FROM actions",
    "warehouse_scan": _with(EV, LK, TOTALS) + f"""
SELECT strftime(window_end, {FMT}) AS window_end_ts, wiki, wiki_label, edit_count, bot_count, human_count,
       language, anomaly_flag, strftime(window_end, '%Y-%m-%d') AS ds, strftime(window_end, '%H') AS hr
FROM totals""",
    # windows closed by the final watermark: end <= max event time - 2 minutes
    "stream_totals": _with(EV, LK, TOTALS) + f"""
SELECT {TOTALS_OUT} FROM totals
WHERE window_end <= (SELECT TIMESTAMP '1970-01-01 00:00:00' + to_seconds(MAX(sec)) FROM ev) - INTERVAL 2 MINUTE""",
    "stream_actions": _with(EV, LK, ACTIONS) + f"""
SELECT {ACTIONS_OUT} FROM actions
WHERE window_end <= (SELECT TIMESTAMP '1970-01-01 00:00:00' + to_seconds(MAX(sec)) FROM ev) - INTERVAL 2 MINUTE""",
    # the third file holds every seventh event of the first half of the time range.  Late rows are judged
    # by the previous batch's watermark, the one that the first file left: rows of windows closed by it are dropped
    "stream_multi_batch": _with(EV, LK, _HALVES, _totals_cte().replace(
        "FROM ev ", "FROM ev, half WHERE NOT (sec < mid AND event_id % 7 = 0 AND (sec // 86400 + 1) * 86400 <= watermark) ")) + f"""
SELECT {TOTALS_OUT} FROM totals
WHERE window_end <= (SELECT TIMESTAMP '1970-01-01 00:00:00' + to_seconds(MAX(sec)) FROM ev) - INTERVAL 2 MINUTE""",
    "stream_restart": _with(EV, LK, _HALVES, _totals_cte().replace(
        "FROM ev ", "FROM ev, half WHERE NOT (sec < mid AND event_id % 7 = 0) ")) + f"""
SELECT {TOTALS_OUT} FROM totals
WHERE window_end <= (SELECT TIMESTAMP '1970-01-01 00:00:00' + to_seconds(MAX(sec)) FROM ev) - INTERVAL 2 MINUTE""",
    "stream_flushed": _with(EV, LK, TOTALS) + f"SELECT {TOTALS_OUT} FROM totals",
    "stream_dedup": _with(EV, LK, _totals_cte().replace(
        "FROM ev ", "FROM (SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE event_id % 350 = 0) AS ev ")) + f"""
SELECT {TOTALS_OUT} FROM totals""",
    "stream_late_rows": _with(EV, _HALVES) + f"""
SELECT event_id, wiki, event_type, strftime({_window_end(86_400)}, {FMT}) AS window_end,
       strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(newest - 120), {FMT}) AS watermark, CAST(2 AS BIGINT) AS batch_id
FROM ev, half, (SELECT MAX(sec) AS newest FROM ev WHERE NOT (sec < (SELECT mid FROM half) AND event_id % 7 = 0))
WHERE sec < mid AND event_id % 7 = 0 AND (sec // 86400 + 1) * 86400 <= newest - 120""",
    "parse_drops": """
WITH r AS (SELECT CASE WHEN event_id % 14 = 0 THEN 'malformed' WHEN event_id % 6 = 0 THEN 'no_wiki'
                       WHEN event_id % 10 = 0 THEN 'no_timestamp' WHEN event_id % 97 = 0 THEN 'bad_time' END AS reason FROM events),
names AS (SELECT unnest(['malformed', 'no_wiki', 'no_timestamp', 'bad_time']) AS reason)
SELECT reason, CAST((SELECT COUNT(*) FROM r WHERE r.reason = names.reason) AS BIGINT) AS n FROM names
UNION ALL SELECT 'rows', CAST(COUNT(*) AS BIGINT) FROM r""",
    "segment_replay": """
SELECT run, CAST(event_id % 3 AS INTEGER) AS log_partition, CAST(event_id // 3 AS BIGINT) AS log_offset, event_id
FROM events, (SELECT unnest(['earliest', 'offsets']) AS run)
WHERE run = 'earliest' OR event_id // 3 >= CASE event_id % 3 WHEN 0 THEN 700 WHEN 1 THEN 40 ELSE 0 END""",
    "delivered_once": """
SELECT event_id,
       CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN NULLIF(CAST(event_id AS VARCHAR), '0')
            ELSE 'u-' || event_id END AS message_key,
       CAST(1 AS BIGINT) AS n
FROM events""",
    "backfill_two_inputs": _with(EV, LK, TOTALS) + f"SELECT {TOTALS_OUT} FROM totals",
    "contract_kept_rows": _with(EV, LK, TOTALS) + f"""
SELECT strftime(window_end, {FMT}) AS window_end, wiki,
       CAST(CASE WHEN wiki = '3' THEN 600 ELSE length(wiki_label) END AS INTEGER) AS label_length, edit_count,
       CASE WHEN wiki = '3' THEN 'wiki_label_too_long' END AS rule
FROM totals""",
    "delivery_actions": _with(EV, LK) + f""",
typed AS (
  SELECT {_window_end(86_400)} AS window_end, wiki, bot, is_minor,
         CASE event_id % 5 WHEN 2 THEN 'unknown' WHEN 3 THEN substr(rpad(event_type, 64, 'x'), 1, 64)
              ELSE event_type END AS event_type
  FROM ev)
SELECT strftime(window_end, {FMT}) AS window_end, wiki, COALESCE(lk_wiki_label, wiki) AS wiki_label,
       COALESCE(lk_language, 'unknown') AS language, event_type, CAST(COUNT(*) AS BIGINT) AS event_count,
       CAST(COUNT(*) FILTER (WHERE bot) AS BIGINT) AS bot_count,
       CAST(COUNT(*) FILTER (WHERE NOT bot) AS BIGINT) AS human_count,
       CAST(COUNT(*) FILTER (WHERE is_minor) AS BIGINT) AS minor_count
FROM typed LEFT JOIN lk ON wiki = lk_wiki_key GROUP BY ALL""",
    "lookback_present": _with(EV, LK, TOTALS) + f"""
SELECT {TOTALS_OUT_UPDATED}, FALSE AS used_fallback FROM totals
WHERE window_end >= (SELECT MAX(window_end) FROM totals) - INTERVAL 10080 MINUTE""",
    "lookback_no_rows": _with(EV, LK, TOTALS) + f"""
SELECT {TOTALS_OUT_UPDATED}, FALSE AS used_fallback FROM totals WHERE wiki = 'no such wiki'""",
    "recent_actions": _with(EV, LK, ACTIONS) + f"""
SELECT {ACTIONS_OUT_UPDATED} FROM actions ORDER BY window_end DESC, wiki, event_type LIMIT 200""",
    # all stored versions: the batch over even events, then the batch over all
    "row_estimate": _with(EV) + f"""
SELECT CAST(COUNT(*) AS BIGINT) AS estimated_rows FROM (SELECT DISTINCT {_window_end(86_400)} AS window_end, wiki FROM ev)""",
    "table_stats": _with(EV, LK, TOTALS) + f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, strftime(MAX(updated_at), {FMT}) AS last_upsert,
       strftime(MAX(window_end), {FMT}) AS newest_window_end
FROM totals""",
    "lookback_totals": _with(EV, LK, TOTALS) + f"""
SELECT {TOTALS_OUT_UPDATED} FROM totals
WHERE window_end >= (SELECT MAX(window_end) FROM totals) - INTERVAL 10080 MINUTE""",
    "latest_totals": _with(EV, LK, TOTALS) + f"""
SELECT {TOTALS_OUT_UPDATED} FROM totals ORDER BY updated_at DESC, window_end, wiki LIMIT 2000""",
    "lookback_actions": _with(EV, LK, ACTIONS) + f"""
SELECT {ACTIONS_OUT_UPDATED} FROM actions
WHERE window_end >= (SELECT MAX(window_end) FROM actions) - INTERVAL 10080 MINUTE""",
    "latest_actions": _with(EV, LK, ACTIONS) + f"""
SELECT {ACTIONS_OUT_UPDATED} FROM actions ORDER BY updated_at DESC, window_end, wiki, event_type LIMIT 2000""",
    "lookback_or_latest": _with(EV, LK, TOTALS) + f"""
SELECT {TOTALS_OUT_UPDATED}, TRUE AS used_fallback
FROM totals ORDER BY updated_at DESC, window_end, wiki LIMIT 2000""",
    "recent_rows": _with(EV, LK, TOTALS) + f"""
SELECT {TOTALS_OUT_UPDATED} FROM totals ORDER BY window_end DESC, wiki LIMIT 150""",
    "top_wikis": _with(EV, LK, TOTALS) + """
SELECT wiki_label, CAST(SUM(edit_count) AS BIGINT) AS edit_count
FROM totals GROUP BY wiki_label ORDER BY edit_count DESC, wiki_label LIMIT 15""",
    "bot_vs_human": _with(EV, LK, TOTALS) + """
SELECT wiki_label, CAST(SUM(bot_count) AS BIGINT) AS bot_count, CAST(SUM(human_count) AS BIGINT) AS human_count
FROM totals GROUP BY wiki_label ORDER BY human_count DESC, wiki_label LIMIT 10""",
    "volume_pivot": _with(EV, LK, TOTALS) + f""",
top AS (SELECT wiki_label FROM totals GROUP BY wiki_label ORDER BY SUM(edit_count) DESC, wiki_label LIMIT 6),
wins AS (SELECT DISTINCT window_end FROM totals)
SELECT strftime(w.window_end, {FMT}) AS window_end, t.wiki_label,
       CAST(COALESCE((SELECT SUM(edit_count) FROM totals x
                      WHERE x.window_end = w.window_end AND x.wiki_label = t.wiki_label), 0) AS BIGINT) AS edit_count
FROM wins w CROSS JOIN top t""",
    "burst_windows": _with(EV, LK, TOTALS) + f"""
SELECT {TOTALS_OUT_UPDATED} FROM totals WHERE anomaly_flag
ORDER BY edit_count DESC, window_end, wiki LIMIT 20""",
    # the long form: one row per pair that occurs, however many types there are
    "event_mix": _with(EV, LK, ACTIONS) + f"""
SELECT strftime(window_end, {FMT}) AS window_end, event_type, CAST(SUM(event_count) AS BIGINT) AS event_count
FROM actions GROUP BY window_end, event_type""",
    "type_totals": _with(EV, LK, ACTIONS) + """
SELECT event_type, CAST(SUM(event_count) AS BIGINT) AS event_count FROM actions GROUP BY event_type""",
    "minor_share": _with(EV, LK, ACTIONS) + f"""
SELECT strftime(window_end, {FMT}) AS window_end, CAST(SUM(minor_count) AS BIGINT) AS minor_count,
       CAST(SUM(event_count) AS BIGINT) AS event_count,
       CAST(SUM(minor_count) AS DOUBLE) / CAST(GREATEST(SUM(event_count), 1) AS DOUBLE) AS minor_share
FROM actions WHERE lower(COALESCE(event_type, '')) = 'view' GROUP BY window_end""",
    "log_share": _with(EV, LK, ACTIONS) + """,
per AS (
  SELECT wiki_label,
         CAST(SUM(CASE WHEN event_type = 'error' THEN event_count ELSE 0 END) AS BIGINT) AS log_count,
         CAST(SUM(CASE WHEN event_type = 'view' THEN event_count ELSE 0 END) AS BIGINT) AS edit_count
  FROM actions GROUP BY wiki_label)
SELECT wiki_label, log_count, edit_count,
       CAST(log_count AS DOUBLE) / CAST(GREATEST(log_count + edit_count, 1) AS DOUBLE) AS log_share
FROM per
WHERE EXISTS (SELECT 1 FROM actions WHERE event_type = 'error')
  AND EXISTS (SELECT 1 FROM actions WHERE event_type = 'view')
ORDER BY log_share DESC, wiki_label LIMIT 12""",
    "staleness": _with(EV, LK, TOTALS) + f"""
SELECT strftime(MAX(updated_at), {FMT}) AS last_upsert,
       GREATEST(0.0, CAST(epoch_us(MAX(window_end) + INTERVAL 1 HOUR) - epoch_us(MAX(updated_at)) AS DOUBLE)
                     / CAST(60000000 AS DOUBLE)) AS age_minutes,
       GREATEST(0.0, CAST(epoch_us(MAX(window_end) + INTERVAL 1 HOUR) - epoch_us(MAX(updated_at)) AS DOUBLE)
                     / CAST(60000000 AS DOUBLE)) > 15.0 AS is_stale
FROM totals""",
    "view_last_update": _with(EV, LK, TOTALS) + f"""
SELECT strftime(MAX(updated_at), {FMT}) AS view_last_update FROM totals
WHERE window_end >= (SELECT MAX(window_end) FROM totals) - INTERVAL 10080 MINUTE""",
}
