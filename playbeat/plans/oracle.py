"""SQL on the events table for every registered query, written independently of the DataFrame code."""

from __future__ import annotations

B = 1704067200000
FILTER_DATE = "2024-01-10"

EVENTS = f"""
e AS (
  SELECT event_id, user_id, event_type, value, ts, epoch_us(ts) AS us,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""

HB = EVENTS + f""",
hb0 AS (
  SELECT event_id,
    'c' || (user_id % 3) AS "customerId", 'w' || (day(ts) // 7) AS "contentId", 'v' || user_id AS "clientId",
    CAST(ts AS DATE) AS edate,
    {B} + (us - {B}000) // 500000 AS server,
    CASE WHEN event_type = 'error' THEN 1 + event_id % 3 WHEN event_id % 11 <> 0 THEN 0 END AS bufferings,
    CASE WHEN event_type = 'error' THEN CAST(round(value * 1000) AS BIGINT)
         WHEN event_id % 11 <> 0 THEN 0 END AS buffering_ms,
    CAST(round(value * 1300) AS BIGINT) AS source_bytes,
    CASE WHEN event_id % 5 = 0 THEN CAST(round(value * 300) AS BIGINT) ELSE 0 END AS p2p_bytes,
    CAST(round(value * 1000) AS BIGINT) AS a_source, k * 1000 AS b_source,
    CASE event_type WHEN 'view' THEN '1080p' WHEN 'click' THEN '720p' WHEN 'purchase' THEN '360p'
                    WHEN 'signup' THEN '270p' END AS label_a,
    CASE k % 4 WHEN 0 THEN '1080p' WHEN 1 THEN '720p' WHEN 2 THEN '360p' ELSE '270p' END AS label_b
  FROM e),
hb AS (
  SELECT *, CAST(edate AS VARCHAR) AS "eventDate",
    CASE WHEN event_id % 17 <> 0 THEN server - event_id % 500 END AS agent,
    coalesce(CASE WHEN event_id % 17 <> 0 THEN server - event_id % 500 END, server) AS agent2,
    coalesce(bufferings, 0) AS buf0, coalesce(buffering_ms, 0) AS ms0,
    CASE WHEN label_a IS NULL THEN 0 WHEN label_a = label_b THEN 1 ELSE 2 END AS labels
  FROM hb0),
lab AS (
  SELECT event_id, "customerId", "contentId", "clientId", "eventDate", label_a AS quality_label,
         a_source AS source, p2p_bytes AS p2p FROM hb WHERE label_a IS NOT NULL
  UNION ALL
  SELECT event_id, "customerId", "contentId", "clientId", "eventDate", label_b, b_source, NULL
  FROM hb WHERE label_a <> label_b)"""

KEYS = '"customerId", "contentId", "clientId"'
SCAN = f"""{KEYS}, "eventDate", server, agent, CAST(bufferings AS BIGINT) AS bufferings,
  CAST(buffering_ms AS BIGINT) AS buffering_ms, source_bytes, p2p_bytes, CAST(labels AS BIGINT) AS labels"""


def sessions(keys: str = KEYS, interval: int = 30000, hb: str = "hb", lab: str = "lab", name: str = "ses") -> str:
    """Session metrics as CTEs: totals, bytes per label, and both joined."""
    by_date = "eventDate" in keys
    on = " AND ".join(f"t.{k.strip()} = l.{k.strip()}" for k in keys.split(","))
    day = '"eventDate"' if by_date else 'first("eventDate" ORDER BY server, "eventDate")'
    return f""",
{name}_tot AS (
  SELECT {keys}, {day} AS event_date, min(server) AS session_start_ms, max(server) AS session_end_ms,
    count(*) AS snapshot_count, CAST(sum(buf0) AS BIGINT) AS total_buffering_events,
    CAST(sum(ms0) AS BIGINT) AS total_buffering_time_ms,
    CAST(sum(source_bytes + p2p_bytes) AS BIGINT) AS total_received_bytes,
    CAST(sum(p2p_bytes) AS BIGINT) AS p2p_received_bytes,
    first(agent2 ORDER BY server, agent2) AS first_agent_ms,
    first(agent2 ORDER BY server DESC, agent2 DESC) AS last_agent_ms
  FROM {hb} GROUP BY {keys}),
{name}_pl AS (
  SELECT {keys}, quality_label, CAST(sum(source + coalesce(p2p, 0)) AS BIGINT) AS received_bytes
  FROM {lab} GROUP BY {keys}, quality_label),
{name}_q AS (
  SELECT {keys}, first(quality_label ORDER BY received_bytes DESC, quality_label) AS dominant_quality,
    count(*) AS labels, CAST(sum(received_bytes) AS BIGINT) AS label_bytes
  FROM {name}_pl GROUP BY {keys}),
{name}_w AS (
  SELECT *, greatest(last_agent_ms - first_agent_ms + {interval}, {interval}) AS watch_time_ms FROM {name}_tot),
{name} AS (
  SELECT t.*, coalesce(l.labels, 0) AS labels, coalesce(l.label_bytes, 0) AS label_bytes, l.dominant_quality,
    least(1.0, CAST(total_buffering_time_ms AS DOUBLE) / CAST(watch_time_ms AS DOUBLE)) AS buffering_ratio,
    CASE WHEN total_buffering_events > 0
      THEN CAST(total_buffering_time_ms AS DOUBLE) / CAST(total_buffering_events AS DOUBLE)
      END AS avg_buffering_duration_ms,
    CASE WHEN total_received_bytes > 0
      THEN CAST(p2p_received_bytes AS DOUBLE) / CAST(total_received_bytes AS DOUBLE) ELSE 0.0 END AS p2p_ratio
  FROM {name}_w t LEFT JOIN {name}_q l ON {on})"""


RENAMED = '"customerId" AS customer_id, "contentId" AS content_id, "clientId" AS client_id'
METRICS = f"""{RENAMED}, session_start_ms, session_end_ms, watch_time_ms, snapshot_count, total_buffering_events,
  total_buffering_time_ms, buffering_ratio, avg_buffering_duration_ms, dominant_quality, total_received_bytes,
  p2p_received_bytes, p2p_ratio, event_date, labels, label_bytes"""
BY_DATE = KEYS + ', "eventDate"'


def hb(select: str) -> str:
    return f"WITH {HB} {select}"


def ses(select: str, **kw) -> str:
    return f"WITH {HB}{sessions(**kw)} {select}"


PLAYER_ROWS = EVENTS + f""",
pe0 AS (
  SELECT 'c' || (user_id % 3) AS "customerId", 'w0' AS "contentId", 'v' || user_id AS "clientId",
    {B} + (us - {B}000) // 5000000 AS t, event_id,
    CASE event_type WHEN 'click' THEN 'waiting' WHEN 'error' THEN 'stalled' WHEN 'view' THEN 'playing'
                    WHEN 'signup' THEN 'level' WHEN 'purchase' THEN 'frag' END AS event,
    CASE WHEN event_type = 'signup' AND k % 10 <> 9 THEN
      CASE k % 4 WHEN 0 THEN 1080 WHEN 1 THEN 720 WHEN 2 THEN 360 ELSE 270 END END AS height,
    CASE WHEN event_type = 'signup' THEN k % 4 END AS level,
    CASE WHEN event_type = 'purchase' THEN CAST(round(value * 1000) AS BIGINT) END AS bytes
  FROM e)"""

WINDOWED = f"""
pe AS (
  SELECT *, @win AS win, first_t + (t - first_t) // 30000 * 30000 AS win_start,
    first_t + (t - first_t) // 30000 * 30000 + 30000 AS win_end,
    CASE WHEN event IN ('waiting', 'stalled') THEN 1 WHEN event = 'playing' THEN 0 END AS state,
    CASE WHEN event = 'level' THEN CASE WHEN height > 0 THEN height || 'p' ELSE 'level_' || level END END AS label
  FROM pe1),
filled AS (
  SELECT *, coalesce(last_value(label IGNORE NULLS) OVER
      (PARTITION BY {KEYS}, win ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      'unknown') AS quality_label
  FROM pe),
states AS (
  SELECT *, coalesce(lag(state) OVER w, 0) AS was,
    min(CASE WHEN state = 0 THEN t END) OVER
      (PARTITION BY {KEYS}, win ORDER BY t, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS resume
  FROM pe WHERE state IS NOT NULL
  WINDOW w AS (PARTITION BY {KEYS}, win ORDER BY t, event_id)),
stalls AS (
  SELECT {KEYS}, win, t AS start_ms, event_id, coalesce(resume, win_end) AS end_ms,
    coalesce(resume, win_end) - t AS duration_ms, first_t, last_t
  FROM states WHERE state = 1 AND was = 0),
wq AS (
  SELECT {KEYS}, win, quality_label, count(*) AS requests, CAST(sum(bytes) AS BIGINT) AS received
  FROM filled WHERE event = 'frag' GROUP BY ALL),
wins AS (SELECT DISTINCT {KEYS}, win, win_end FROM pe),
ahead AS (
  SELECT {KEYS}, first_t, win, lead(win) OVER (PARTITION BY {KEYS}, first_t ORDER BY win) AS next_win
  FROM (SELECT DISTINCT {KEYS}, first_t, win FROM pe)),
every AS (
  SELECT * FROM wins UNION ALL
  SELECT {KEYS}, win, @end AS win_end FROM (
    SELECT {KEYS}, first_t, unnest(range(win + @step, next_win, @step)) AS win FROM ahead WHERE @near))"""


def windowed(**words: str) -> str:
    out = WINDOWED
    for name, sql in words.items():
        out = out.replace(f"@{name}", sql)
    return out


BY_VIEWER = windowed(
    win="(t - first_t) // 30000", end="first_t + win * 30000 + 30000", step="1", near="(next_win - win) * 30000 <= 1800000"
)
BY_VISIT = windowed(win="first_t + (t - first_t) // 30000 * 30000", end="win + 30000", step="30000", near="true")

PLAYER = f"""{PLAYER_ROWS},
pe1 AS (
  SELECT *, min(t) OVER v AS first_t, max(t) OVER v AS last_t FROM pe0
  WINDOW v AS (PARTITION BY {KEYS})),{BY_VIEWER}"""

# visits: a start, the time after a stop, a pause and the first event begin one; a window is known by its start
VISITS = f"""{PLAYER_ROWS},
pe00 AS (SELECT * REPLACE (CASE event_id % 40 WHEN 0 THEN 'start' WHEN 1 THEN 'stop' ELSE event END AS event) FROM pe0),
moments AS (SELECT {KEYS}, t, bool_or(event = 'start') AS starts, bool_or(event = 'stop') AS stops FROM pe00 GROUP BY ALL),
marks AS (
  SELECT *, coalesce(starts OR lag(stops) OVER v OR t - lag(t) OVER v > 1800000, true) AS mark FROM moments
  WINDOW v AS (PARTITION BY {KEYS} ORDER BY t)),
spans AS (
  SELECT {KEYS}, t, max(CASE WHEN mark THEN t END) OVER (PARTITION BY {KEYS} ORDER BY t) AS first_t FROM marks),
pe1 AS (
  SELECT e.*, s.first_t, max(e.t) OVER (PARTITION BY e."customerId", e."clientId", s.first_t) AS last_t
  FROM pe00 e JOIN spans s ON e."customerId" = s."customerId" AND e."clientId" = s."clientId" AND e.t = s.t),
{BY_VISIT}"""


def beats(wins: str) -> str:
    """Heartbeat rows of the given windows."""
    return f"""
  SELECT w."customerId", w."contentId", w."clientId", w.win_end AS agent,
    CAST(CAST(make_timestamp(w.win_end * 1000) AS DATE) AS VARCHAR) AS "eventDate",
    coalesce(s.n, 0) AS bufferings, coalesce(s.ms, 0) AS buffering_ms,
    coalesce(f.requests, 0) AS requests, coalesce(f.received, 0) AS received, coalesce(f.labels, 0) AS labels
  FROM {wins} w
  LEFT JOIN (SELECT {KEYS}, win, count(*) AS n, CAST(sum(duration_ms) AS BIGINT) AS ms FROM stalls GROUP BY ALL) s
    ON s."clientId" = w."clientId" AND s."customerId" = w."customerId" AND s.win = w.win
  LEFT JOIN (SELECT {KEYS}, win, CAST(sum(requests) AS BIGINT) AS requests,
               CAST(sum(received) AS BIGINT) AS received, count(*) AS labels FROM wq GROUP BY ALL) f
    ON f."clientId" = w."clientId" AND f."customerId" = w."customerId" AND f.win = w.win"""


def pe(select: str) -> str:
    return f"WITH {PLAYER} {select}"


PLAYER_SESSIONS = f"""WITH {PLAYER},
hb AS (
  SELECT *, agent AS server, agent AS agent2, bufferings AS buf0, buffering_ms AS ms0, received AS source_bytes,
         0 AS p2p_bytes
  FROM ({beats('every')})),
lab AS (SELECT {KEYS}, quality_label, received AS source, 0 AS p2p FROM wq)
{sessions()} SELECT {METRICS} FROM ses"""

COERCED = """CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN NULL
  WHEN event_id % 29 = 0 THEN 1 ELSE bufferings END"""

SWITCHES = f"""
SELECT {KEYS}, count(*) AS level_events, count(*) FILTER (height > was) AS upshifts,
  count(*) FILTER (height < was) AS downshifts
FROM (SELECT {KEYS}, height, lag(height) OVER (PARTITION BY {KEYS} ORDER BY t, event_id) AS was
      FROM pe0 WHERE event = 'level' AND height > 0) GROUP BY {KEYS}"""

ENTRIES = f"""
SELECT {KEYS}, first_value(quality_label) OVER w AS dominant_quality, row_number() OVER w AS position,
  quality_label, received_bytes,
  CASE WHEN sum(received_bytes) OVER p > 0 THEN
    CAST(received_bytes AS DOUBLE) / CAST(sum(received_bytes) OVER p AS DOUBLE) ELSE 0.0 END * 100 AS share
FROM ses_pl
WINDOW w AS (PARTITION BY {KEYS} ORDER BY received_bytes DESC, quality_label), p AS (PARTITION BY {KEYS})"""

WINDOWED = hb("""
      SELECT "customerId", "contentId", server // 30000 * 30000 AS window_start_ms, count(*) AS heartbeats,
        count(*) FILTER (buf0 > 0) AS heartbeats_with_buffering, CAST(sum(buf0) AS BIGINT) AS bufferings,
        CAST(sum(ms0) AS BIGINT) AS buffering_ms, CAST(sum(source_bytes + p2p_bytes) AS BIGINT) AS received_bytes
      FROM hb GROUP BY 1, 2, 3""")

SQL: dict[str, str] = {
    "scan_heartbeats": hb(f"SELECT {SCAN} FROM hb"),
    "scan_table": hb(f"SELECT {SCAN} FROM hb"),
    "scan_table_date": hb(f"SELECT {SCAN} FROM hb WHERE edate = DATE '{FILTER_DATE}'"),
    "filter_date": hb(f"SELECT {SCAN} FROM hb WHERE edate = DATE '{FILTER_DATE}'"),
    "decode_payload": hb(f"""
      SELECT CASE WHEN c THEN NULL ELSE "customerId" END AS "customerId",
        CASE WHEN c THEN NULL ELSE "contentId" END AS "contentId",
        CASE WHEN c THEN NULL ELSE "clientId" END AS "clientId",
        CASE WHEN c THEN CAST(CAST(make_timestamp(server * 1000) AS DATE) AS VARCHAR) ELSE "eventDate" END AS "eventDate",
        server, CASE WHEN NOT c THEN agent END AS agent,
        CASE WHEN NOT c THEN CAST(bufferings AS BIGINT) END AS bufferings,
        CASE WHEN NOT c THEN CAST(buffering_ms AS BIGINT) END AS buffering_ms,
        CASE WHEN NOT c THEN source_bytes END AS source_bytes, CASE WHEN NOT c THEN p2p_bytes END AS p2p_bytes,
        CASE WHEN c THEN 0 ELSE labels END AS labels, c AS corrupt
      FROM (SELECT *, event_id % 13 = 0 AS c FROM hb)"""),
    "project_traffic": hb(f"""
      SELECT {KEYS}, quality_label, CAST(1 AS BIGINT) AS requests, CAST(1 AS DOUBLE) AS responses,
        source AS requested, source AS source_received, p2p AS p2p_received FROM lab"""),
    "decode_quality_map": hb("""
      SELECT h.event_id, l.quality_label, l.source + coalesce(l.p2p, 0) + 1 AS bytes
      FROM hb h LEFT JOIN lab l ON l.event_id = h.event_id"""),
    "coerce_types": hb(f"""
      SELECT {SCAN.replace('CAST(bufferings AS BIGINT)', f'CAST({COERCED} AS BIGINT)')} FROM hb"""),
    "quarantine_rows": hb("""
      SELECT CASE WHEN event_id % 19 = 0 OR event_id % 23 = 0 THEN 'player.bufferings' ELSE '' END AS reason,
        count(*) AS rows FROM hb GROUP BY 1"""),
    "project_flat": hb(f"""
      SELECT {KEYS}, "eventDate", server, agent2 AS agent, CAST(buf0 AS BIGINT) AS bufferings,
        CAST(ms0 AS BIGINT) AS buffering_ms, source_bytes, p2p_bytes FROM hb"""),
    "null_defaults": hb("SELECT event_id, CAST(buf0 AS BIGINT) AS bufferings, CAST(ms0 AS BIGINT) AS buffering_ms FROM hb"),
    "session_keys": hb("""
      SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN "customerId" ELSE '' END AS "customerId",
        "contentId", "clientId" FROM hb"""),
    "agent_fallback": hb("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN server ELSE agent2 END AS agent FROM hb"),
    "received_bytes": hb("SELECT event_id, source_bytes + p2p_bytes AS received_bytes FROM hb"),
    "safe_ratio": hb("""
      SELECT event_id, CASE WHEN bufferings > 0 THEN CAST(buffering_ms AS DOUBLE) / bufferings ELSE 0.0 END AS mean_or_zero,
        CASE WHEN bufferings > 0 THEN CAST(buffering_ms AS DOUBLE) / bufferings END AS mean_or_null,
        CASE WHEN bufferings > 0 THEN least(1.0, CAST(buffering_ms AS DOUBLE) / CAST(bufferings * 25000 AS DOUBLE))
          ELSE 0.0 END AS capped FROM hb"""),
    "epoch_to_date": hb("SELECT event_id, CAST(CAST(make_timestamp(server * 1000) AS DATE) AS VARCHAR) AS day FROM hb"),
    "quality_label": pe("SELECT event_id, label AS quality_label FROM pe WHERE event = 'level'"),
    "map_totals": hb("""
      SELECT event_id, CAST(labels AS BIGINT) AS requests, CAST(labels AS DOUBLE) AS responses,
        CASE labels WHEN 0 THEN 0 WHEN 1 THEN a_source ELSE a_source + b_source END AS requested,
        CASE labels WHEN 0 THEN 0 WHEN 1 THEN a_source ELSE a_source + b_source END AS received FROM hb"""),
    "session_metrics": ses(f"SELECT {METRICS} FROM ses"),
    "session_metrics_by_date": ses(f"SELECT {METRICS} FROM ses", keys=BY_DATE),
    "buffering_by_date": ses(f"""
      SELECT {KEYS}, event_date, session_start_ms, session_end_ms, snapshot_count, total_buffering_events,
        total_buffering_time_ms, total_received_bytes, p2p_received_bytes, first_agent_ms, last_agent_ms,
        watch_time_ms, buffering_ratio, avg_buffering_duration_ms, p2p_ratio FROM ses""", keys=BY_DATE),
    "session_span": ses(f"""
      SELECT {KEYS}, session_start_ms, session_end_ms, snapshot_count, first_agent_ms, last_agent_ms, event_date
      FROM ses"""),
    "watch_time": ses(f"SELECT {KEYS}, watch_time_ms FROM ses"),
    "buffering_totals": ses(f"SELECT {KEYS}, total_buffering_events, total_buffering_time_ms FROM ses"),
    "buffering_ratio": ses(f"SELECT {KEYS}, buffering_ratio FROM ses"),
    "avg_buffering": ses(f"SELECT {KEYS}, avg_buffering_duration_ms FROM ses"),
    "traffic_split": ses(f"SELECT {KEYS}, total_received_bytes, p2p_received_bytes, p2p_ratio FROM ses"),
    "min_snapshots": ses(f"SELECT {METRICS} FROM ses WHERE snapshot_count >= 14"),
    "sessions_sorted": ses(f"SELECT {METRICS} FROM ses ORDER BY 1, 2, 3"),
    "validate_metrics": hb(f""", bad AS (
        SELECT * REPLACE (CASE WHEN CAST(substr("clientId", 2) AS BIGINT) % 3 = 0
          THEN -p2p_bytes - 1 ELSE p2p_bytes END AS p2p_bytes) FROM hb)
      {sessions(hb='bad')}
      SELECT {RENAMED}, total_received_bytes, p2p_received_bytes, p2p_ratio,
        CASE WHEN p2p_ratio < 0 OR p2p_ratio > 1 THEN 'p2p_ratio_out_of_range' ELSE '' END AS reasons FROM ses"""),
    "explode_quality": hb(f'SELECT {KEYS}, "eventDate", quality_label, source + coalesce(p2p, 0) AS bytes FROM lab'),
    "explode_quality_outer": hb(f"""
      SELECT {KEYS}, "eventDate", quality_label, source + coalesce(p2p, 0) AS bytes FROM lab
      UNION ALL SELECT {KEYS}, "eventDate", NULL, 0 FROM hb WHERE labels = 0"""),
    "quality_bytes": ses("SELECT * FROM ses_pl"),
    "quality_share": ses(f"""
      SELECT *, CASE WHEN session_bytes > 0 THEN CAST(received_bytes AS DOUBLE) / CAST(session_bytes AS DOUBLE)
        ELSE 0.0 END * 100 AS share_pct
      FROM (SELECT *, CAST(sum(received_bytes) OVER (PARTITION BY {KEYS}) AS BIGINT) AS session_bytes FROM ses_pl)"""),
    "quality_rank": ses(f"""
      SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY received_bytes DESC, quality_label) AS position,
        rank() OVER (PARTITION BY {KEYS} ORDER BY received_bytes DESC) AS quality_rank FROM ses_pl"""),
    "dominant_quality": ses(f"SELECT {KEYS}, dominant_quality FROM ses_q"),
    "quality_breakdown": ses(ENTRIES),
    "quality_metrics": ses(ENTRIES),
    "quality_map": ses("SELECT * FROM ses_pl"),
    "join_dominant_breakdown": ses(f"""
      SELECT l."customerId", l."contentId", l."clientId", q.dominant_quality, l.quality_label, l.received_bytes
      FROM ses_pl l JOIN ses_q q ON q."customerId" = l."customerId" AND q."contentId" = l."contentId"
        AND q."clientId" = l."clientId" """),
    "flat_rows": ses(f"""
      SELECT {RENAMED}, event_date, session_start_ms, session_end_ms, watch_time_ms, snapshot_count,
        total_buffering_events, total_buffering_time_ms, buffering_ratio, avg_buffering_duration_ms,
        coalesce(dominant_quality, '') AS dominant_quality, total_received_bytes, p2p_received_bytes, p2p_ratio,
        {', '.join(f'''(SELECT coalesce(max(received_bytes), 0) FROM ses_pl l WHERE l."customerId" = s."customerId"
          AND l."contentId" = s."contentId" AND l."clientId" = s."clientId" AND quality_label = '{x}')
          AS "quality_bytes_{x}"''' for x in ('1080p', '270p', '360p', '720p'))},
        {', '.join(f'''(SELECT coalesce(max(CASE WHEN s.label_bytes > 0 THEN
            round(CAST(received_bytes AS DOUBLE) / CAST(s.label_bytes AS DOUBLE) * 100, 2) END), 0.0)
          FROM ses_pl l WHERE l."customerId" = s."customerId" AND l."contentId" = s."contentId"
          AND l."clientId" = s."clientId" AND quality_label = '{x}')
          AS "quality_pct_{x}"''' for x in ('1080p', '270p', '360p', '720p'))}
      FROM ses s"""),
    "distinct_labels": ses("SELECT DISTINCT quality_label FROM ses_pl ORDER BY 1"),
    "fleet_summary": ses("""
      SELECT count(*) AS viewers, count(*) FILTER (total_buffering_events > 0) AS viewers_with_buffering,
        CAST(count(*) FILTER (total_buffering_events > 0) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100
          AS buffering_viewers_pct,
        round(avg(buffering_ratio), 9) AS avg_buffering_ratio FROM ses"""),
    "fleet_summary_pct": ses("""
      SELECT count(*) AS total_viewers, round(avg(buffering_ratio) * 100, 7) AS avg_buf_ratio_pct,
        round(avg(p2p_ratio) * 100, 7) AS avg_p2p_pct FROM ses"""),
    "dominant_distribution": ses("""
      SELECT dominant_quality, count(*) AS count FROM ses WHERE dominant_quality IS NOT NULL
      GROUP BY 1 ORDER BY 2 DESC, 1"""),
    "write_roundtrip": ses(f"SELECT {METRICS} FROM ses"),
    "upsert_metrics": hb(f"""{sessions(keys=BY_DATE)}{sessions(keys=BY_DATE, interval=60000, name='late')}
      SELECT {METRICS} FROM ses WHERE event_date < '{FILTER_DATE}'
      UNION ALL SELECT {METRICS} FROM late WHERE event_date >= '{FILTER_DATE}'"""),
    "stream_sessions": ses(f"SELECT {METRICS} FROM ses"),
    "running_sessions": ses(f"SELECT {METRICS} FROM ses"),
    "merge_partials": ses(f"SELECT {METRICS} FROM ses"),
    "rerun_date": ses(f"SELECT {METRICS} FROM ses"),
    "job_with_quarantine": hb(f""",
good AS (SELECT * REPLACE (CASE WHEN event_id % 29 = 0 THEN 1 ELSE buf0 END AS buf0) FROM hb
         WHERE event_id % 19 <> 0 AND event_id % 23 <> 0),
good_lab AS (SELECT * FROM lab WHERE event_id % 19 <> 0 AND event_id % 23 <> 0)
{sessions(hb='good', lab='good_lab')} SELECT {METRICS} FROM ses"""),
    "window_metrics": WINDOWED,
    "stream_windows": WINDOWED,
    "assign_windows": pe(f"SELECT {KEYS}, event_id, t, win, win_start, win_end FROM pe"),
    "asof_quality": pe(f"SELECT {KEYS}, win, t, event_id, event, quality_label FROM filled WHERE event = 'frag'"),
    "buffer_intervals": pe(f"SELECT {KEYS}, win, start_ms, event_id, end_ms, duration_ms FROM stalls"),
    "window_quality_stats": pe(f"""
      SELECT {KEYS}, win, quality_label, requests, received AS requested, received FROM wq"""),
    "build_heartbeats": pe(beats("wins")),
    "densify_windows": pe(beats("every")),
    "visit_heartbeats": f"WITH {VISITS} {beats('every')}",
    "stream_visits": f"WITH {VISITS} {beats('every')}",
    "player_sessions": PLAYER_SESSIONS,
    "dedup_heartbeats": hb(f"""
      SELECT {SCAN.replace(', agent,', ', agent0 AS agent,')} FROM (
        SELECT *, agent AS agent0, row_number() OVER (PARTITION BY {KEYS}, server
          ORDER BY agent NULLS FIRST, edate, bufferings NULLS FIRST, buffering_ms NULLS FIRST, source_bytes) AS n
        FROM (SELECT * FROM hb UNION ALL SELECT * REPLACE (agent + 1 AS agent) FROM hb)) WHERE n = 1"""),
    "buffering_position": pe(f"""
      SELECT {KEYS}, start_ms, event_id, duration_ms, start_ms - first_t AS offset_ms,
        CASE WHEN (start_ms - first_t) * 2 >= last_t - first_t THEN 'late' ELSE 'early' END AS position
      FROM stalls"""),
    "buffering_clusters": pe("""
      SELECT "customerId", "contentId", start_ms // 60000 * 60000 AS bucket_ms,
        count(DISTINCT "clientId") AS viewers, count(*) AS stalls
      FROM stalls GROUP BY 1, 2, 3 HAVING count(DISTINCT "clientId") >= 2"""),
    "quality_switches": pe(SWITCHES),
    "segment_failures": pe("""
      SELECT quality_label, requests, loads, requests - loads AS failures,
        CAST(requests - loads AS DOUBLE) / CAST(requests AS DOUBLE) AS failure_rate
      FROM (SELECT quality_label, count(*) AS requests, count(*) FILTER (event_id % 7 <> 0) AS loads
            FROM filled WHERE event = 'frag' GROUP BY 1)"""),
    "buffering_spikes": hb("""
      SELECT *, CAST(buffering_viewers AS DOUBLE) / CAST(viewers AS DOUBLE) AS buffering_share FROM (
        SELECT "customerId", "contentId", server // 30000 * 30000 AS window_start_ms,
          count(DISTINCT "clientId") AS viewers, count(DISTINCT "clientId") FILTER (buf0 > 0) AS buffering_viewers
        FROM hb GROUP BY 1, 2, 3)
      WHERE CAST(buffering_viewers AS DOUBLE) / CAST(viewers AS DOUBLE) >= 0.15"""),
}
