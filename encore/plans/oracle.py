"""DuckDB oracle SQL for the registered queries.

Every statement starts from the driver's tables through the same test
mapping as ``encore.sources.fixtures`` (written independently in SQL), so the
oracle also checks the message / parse / enrich path.
"""

# The test mapping and the gold table as CTEs (fixed text).
PREFIX = """
WITH raw_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CAST(CASE WHEN event_id % 10 = 9 THEN user_id + 100000000 ELSE user_id END AS INTEGER) AS user_id,
         CASE WHEN event_type = 'signup' THEN NULL
              ELSE (CASE WHEN event_id % 7 = 6 THEN 'lost_' ELSE 'song_' END)
                   || json_extract_string(props, '$.k') END AS song_id,
         ts,
         CASE WHEN user_id = 8 OR event_type = 'error' THEN 'SKIP'
              WHEN event_type = 'click' THEN 'LIKE'
              ELSE 'PLAY' END AS event_type,
         CAST(floor(value) AS INTEGER) AS duration_seconds
  FROM events
),
dim_users AS (
  SELECT CAST(c_custkey AS INTEGER) AS user_id,
         c_name AS user_name,
         CASE WHEN c_custkey = 8 THEN 'NO_PLAY' ELSE n_name END AS country,
         CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'Premium' ELSE 'Free' END AS subscription_type,
         true AS is_current
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
dim_songs AS (
  SELECT 'song_' || CAST(p_partkey AS VARCHAR) AS song_id,
         p_name AS song_name, p_brand AS artist_name, p_type AS genre
  FROM part
),
valid_events AS (
  SELECT * FROM raw_events
  WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND song_id IS NOT NULL
),
gold AS (
  SELECT e.event_id, e.user_id,
         coalesce(u.user_name, 'Guest') AS user_name,
         e.song_id,
         coalesce(s.song_name, 'Unknown') AS song_name,
         coalesce(s.artist_name, 'Unknown') AS artist_name,
         coalesce(s.genre, 'Unknown') AS genre,
         coalesce(u.subscription_type, 'Free') AS subscription_type,
         coalesce(u.country, 'Unknown') AS country,
         e.event_type,
         date_trunc('second', e.ts) AS event_timestamp,
         CAST(year(e.ts) * 100 + month(e.ts) AS INTEGER) AS event_month,
         e.duration_seconds
  FROM valid_events e
  LEFT JOIN dim_users u ON e.user_id = u.user_id
  LEFT JOIN dim_songs s ON trim(e.song_id) = trim(s.song_id)
),
plays AS (
  SELECT country, song_name, artist_name, CAST(count(*) AS BIGINT) AS plays
  FROM gold WHERE event_type = 'PLAY' AND song_name <> ''
  GROUP BY country, song_name, artist_name
),
active_users AS (
  SELECT DISTINCT user_id, user_name, country FROM gold
  WHERE user_id > 0 AND user_name <> ''
),
faults AS (
  SELECT CASE event_id % 50 WHEN 2 THEN NULL WHEN 4 THEN CAST(event_id AS VARCHAR)
         ELSE CAST(event_id AS VARCHAR) || 'f' END AS event_id,
         CAST(CASE event_id % 50 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 5 THEN -1
              ELSE user_id END AS INTEGER) AS user_id,
         CASE WHEN event_id % 50 = 2 THEN NULL ELSE ' song_1 ' END AS song_id,
         CASE WHEN event_id % 50 IN (0, 2) THEN NULL ELSE ts END AS ts,
         CASE event_id % 50 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 6 THEN 'DANCE' ELSE 'PLAY' END
           AS event_type
  FROM events WHERE event_id % 50 <= 6
)
"""


def _recs_sql(where: str) -> str:
    """Exploded recommendations (user_id, user_name, rank, song) computed
    from the gold rows matching ``where``."""
    return f"""
    (WITH g AS (SELECT * FROM gold WHERE {where}),
    p AS (SELECT country, song_name, artist_name, count(*) AS plays FROM g
          WHERE event_type = 'PLAY' AND song_name <> '' GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY country
                 ORDER BY plays DESC, song_name, artist_name) AS rk FROM p),
    fb AS (SELECT song_name || ' - ' || artist_name AS song,
                  row_number() OVER (ORDER BY country, plays DESC, song_name, artist_name) AS rk
           FROM p ORDER BY country, plays DESC, song_name, artist_name LIMIT 3),
    u AS (SELECT DISTINCT user_id, user_name, country FROM g
          WHERE user_id > 0 AND user_name <> '')
    SELECT u.user_id, u.user_name, CAST(r.rk AS INTEGER) AS rank,
           r.song_name || ' - ' || r.artist_name AS song
    FROM u JOIN r ON u.country = r.country AND r.rk <= 3
    UNION ALL
    SELECT u.user_id, u.user_name, CAST(fb.rk AS INTEGER) AS rank, fb.song
    FROM u, fb WHERE u.country NOT IN (SELECT country FROM p))
    """


_SPLIT = "2024-01-16 00:00:00"
_FIRST = _recs_sql(f"event_timestamp < TIMESTAMP '{_SPLIT}'")
_SECOND = _recs_sql(f"event_timestamp >= TIMESTAMP '{_SPLIT}'")
_LATEST = f"""
    SELECT user_id, user_name, rank, song, TIMESTAMP '2024-02-01 00:00:00' AS updated_at
    FROM {_SECOND} s
    UNION ALL
    SELECT user_id, user_name, rank, song, TIMESTAMP '{_SPLIT}' AS updated_at
    FROM {_FIRST} f
    WHERE user_id NOT IN (SELECT user_id FROM {_SECOND} s2)"""

ORACLE = {
    "bronze_valid": """
        SELECT event_id, user_id, song_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
               event_type, 'kafka_music_events' AS source
        FROM valid_events""",
    "bronze_invalid": """
        SELECT event_id, user_id, song_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
               event_type, 'kafka_music_events' AS source, false AS is_valid,
               'MISSING_REQUIRED_FIELDS' AS error_type
        FROM raw_events
        WHERE event_id IS NULL OR user_id IS NULL OR song_id IS NULL""",
    "dim_users": "SELECT user_id, user_name, country, subscription_type, is_current FROM dim_users",
    "dim_songs": "SELECT song_id, song_name, artist_name, genre FROM dim_songs",
    "silver_enriched": """
        SELECT e.event_id, e.user_id, e.song_id, u.user_name, s.song_name, s.artist_name, s.genre,
               strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS event_timestamp, e.event_type,
               u.subscription_type, u.country
        FROM valid_events e
        LEFT JOIN dim_users u ON e.user_id = u.user_id
        LEFT JOIN dim_songs s ON trim(e.song_id) = trim(s.song_id)""",
    "gold_events": """
        SELECT event_id, user_id, user_name, song_id, song_name, artist_name, genre,
               subscription_type, country, event_type, event_timestamp, event_month
        FROM gold""",
    "total_plays": "SELECT count(*) AS total_plays FROM gold WHERE event_type = 'PLAY'",
    "avg_listening_minutes": """
        SELECT avg(CASE WHEN event_type = 'PLAY' THEN CAST(3.5 AS DOUBLE)
                        WHEN event_type = 'SKIP' THEN CAST(0.5 AS DOUBLE)
                        ELSE CAST(0 AS DOUBLE) END) AS avg_minutes
        FROM gold""",
    "top_songs": """
        SELECT song_name || ' - ' || artist_name AS song, count(*) AS plays
        FROM gold WHERE event_type = 'PLAY' AND song_name <> ''
        GROUP BY song_name, artist_name
        ORDER BY plays DESC, song ASC LIMIT 5""",
    "genre_distribution": """
        SELECT genre, count(*) AS total,
               count(*) / (SELECT count(*) FROM gold WHERE genre <> '') AS share
        FROM gold WHERE genre <> '' GROUP BY genre ORDER BY total DESC, genre""",
    "listening_trend": """
        SELECT time_bucket(INTERVAL '1 hour', event_timestamp) AS time, event_type,
               count(*) AS count
        FROM gold
        WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-01 00:00:00'
                                  AND TIMESTAMP '2024-01-31 23:59:59'
        GROUP BY 1, 2 ORDER BY 1, 2""",
    "country_distribution": """
        SELECT country, count(*) AS events FROM gold WHERE country <> ''
        GROUP BY country ORDER BY events DESC, country LIMIT 10""",
    "recent_users": """
        SELECT user_name, country, subscription_type, max(event_timestamp) AS last_seen
        FROM gold GROUP BY user_name, country, subscription_type
        ORDER BY last_seen DESC, user_name, country, subscription_type LIMIT 20""",
    "active_users": "SELECT user_id, user_name, country FROM active_users",
    "plays_by_country": """
        SELECT country, song_name, artist_name, plays FROM plays
        ORDER BY country, plays DESC, song_name, artist_name""",
    "recommendations": "SELECT * FROM " + _recs_sql("true"),
    # the streamed inputs must give exactly the batch recommendations
    "recommendations_incremental": "SELECT * FROM " + _recs_sql("true"),
    "latest_recommendations": _LATEST,
    "user_recommendations": f"""
        SELECT user_name, rank, song, updated_at FROM ({_LATEST}) l WHERE user_id = 7""",
    "recommendation_users": f"""
        SELECT DISTINCT user_id FROM (SELECT user_id FROM {_FIRST}
                                      UNION ALL SELECT user_id FROM {_SECOND}) t
        ORDER BY user_id""",
    "recommendation_engagement": f"""
        , g2 AS (SELECT user_id, song, TIMESTAMP '{_SPLIT}' AS made FROM {_FIRST}
                 UNION ALL SELECT user_id, song, TIMESTAMP '2024-02-01 00:00:00' FROM {_SECOND}),
        r AS (SELECT user_id, song, min(made) AS made FROM g2 GROUP BY 1, 2),
        a AS (SELECT r.song, count(*) AS recommended_users,
                     count(*) FILTER (WHERE EXISTS (
                       SELECT 1 FROM gold e WHERE e.user_id = r.user_id
                         AND e.song_name || ' - ' || e.artist_name = r.song
                         AND e.event_type IN ('PLAY', 'LIKE') AND e.event_timestamp > r.made)) AS engaged_users
              FROM r GROUP BY r.song)
        SELECT song, recommended_users, engaged_users,
               engaged_users / recommended_users AS engagement_rate
        FROM a ORDER BY recommended_users DESC, song""",
    "top_songs_day": """
        SELECT song_name || ' - ' || artist_name AS song, count(*) AS plays
        FROM gold WHERE event_type = 'PLAY' AND song_name <> ''
          AND CAST(event_timestamp AS DATE) = DATE '2024-01-15'
        GROUP BY song_name, artist_name
        ORDER BY plays DESC, song ASC LIMIT 5""",
    "top_artists": """
        SELECT artist_name, count(*) AS plays FROM gold
        WHERE event_type = 'PLAY' AND artist_name <> ''
        GROUP BY artist_name ORDER BY plays DESC, artist_name LIMIT 10""",
    "most_active_users": """
        SELECT user_id, user_name, count(*) AS events,
               count(*) FILTER (WHERE event_type = 'PLAY') AS plays
        FROM gold GROUP BY user_id, user_name
        ORDER BY events DESC, user_id, user_name LIMIT 10""",
    "daily_active_users": """
        SELECT date_trunc('day', event_timestamp) AS day, count(DISTINCT user_id) AS active_users
        FROM gold GROUP BY 1 ORDER BY 1""",
    "daily_volume": """
        SELECT date_trunc('day', event_timestamp) AS day,
               count(*) FILTER (WHERE event_type = 'PLAY') AS plays,
               count(*) FILTER (WHERE event_type = 'SKIP') AS skips,
               count(*) FILTER (WHERE event_type = 'LIKE') AS likes,
               count(*) AS events
        FROM gold GROUP BY 1 ORDER BY 1""",
    "genre_trend": """
        , wk AS (SELECT genre, date_trunc('week', event_timestamp) AS week,
                        count(*) AS plays
                 FROM gold WHERE event_type = 'PLAY' GROUP BY 1, 2)
        SELECT genre, week, plays, prev_plays, plays - prev_plays AS change
        FROM (SELECT a.genre, a.week, a.plays,
                     CASE WHEN a.week = f.first_week THEN NULL ELSE coalesce(b.plays, 0) END AS prev_plays
              FROM wk a JOIN (SELECT genre, min(week) AS first_week FROM wk GROUP BY 1) f USING (genre)
              LEFT JOIN wk b ON b.genre = a.genre AND b.week = a.week - INTERVAL 7 DAY)
        ORDER BY genre, week""",
    "growing_artists": """
        , w AS (SELECT CAST(date_trunc('week', max(event_timestamp)) AS DATE) AS wk FROM gold),
        s AS (SELECT artist_name,
                     count(*) FILTER (WHERE CAST(event_timestamp AS DATE) >= wk
                                        AND CAST(event_timestamp AS DATE) < wk + 7) AS plays,
                     count(*) FILTER (WHERE CAST(event_timestamp AS DATE) >= wk - 7
                                        AND CAST(event_timestamp AS DATE) < wk) AS prev_plays
              FROM gold, w
              WHERE event_type = 'PLAY'
                AND CAST(event_timestamp AS DATE) >= wk - 7
                AND CAST(event_timestamp AS DATE) < wk + 7
              GROUP BY artist_name)
        SELECT artist_name, plays, prev_plays, plays - prev_plays AS growth
        FROM s ORDER BY growth DESC, plays DESC, artist_name LIMIT 10""",
    "trending_songs": """
        , b AS (SELECT max(event_timestamp) AS t_end FROM gold),
        s AS (SELECT song_name || ' - ' || artist_name AS song,
                     count(*) FILTER (WHERE event_timestamp > t_end - INTERVAL 48 HOUR
                                        AND event_timestamp <= t_end) AS recent_plays,
                     count(*) FILTER (WHERE event_timestamp > t_end - INTERVAL 96 HOUR
                                        AND event_timestamp <= t_end - INTERVAL 48 HOUR) AS prev_plays
              FROM gold, b
              WHERE event_type = 'PLAY' AND event_timestamp > t_end - INTERVAL 96 HOUR
                AND event_timestamp <= t_end
              GROUP BY song_name, artist_name)
        SELECT song, recent_plays, prev_plays, recent_plays - prev_plays AS trend
        FROM s ORDER BY trend DESC, recent_plays DESC, song LIMIT 10""",
    "avg_duration": """
        SELECT event_type, count(*) AS events, avg(duration_seconds) AS avg_duration_seconds
        FROM valid_events GROUP BY event_type""",
    "user_engagement": """
        SELECT user_id, user_name,
               count(*) FILTER (WHERE event_type = 'PLAY') AS plays,
               count(*) FILTER (WHERE event_type = 'SKIP') AS skips,
               count(*) FILTER (WHERE event_type = 'LIKE') AS likes,
               count(*) AS events,
               count(*) FILTER (WHERE event_type = 'SKIP') / count(*) AS skip_rate,
               count(DISTINCT song_id) AS distinct_songs
        FROM gold GROUP BY user_id, user_name""",
    "hourly_pattern": """
        SELECT CAST(hour(event_timestamp) AS INTEGER) AS hour, count(*) AS events,
               count(*) FILTER (WHERE event_type = 'PLAY') AS plays
        FROM gold GROUP BY 1 ORDER BY 1""",
    "country_activity": """
        SELECT country, count(*) AS plays, count(DISTINCT user_id) AS listeners
        FROM gold WHERE event_type = 'PLAY' AND country <> ''
        GROUP BY country ORDER BY plays DESC, country""",
    "platform_growth": """
        , f AS (SELECT user_id, min(date_trunc('day', event_timestamp)) AS day FROM gold GROUP BY 1),
        d AS (SELECT day, count(*) AS new_users FROM f GROUP BY 1)
        SELECT day, new_users,
               CAST(sum(new_users) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING
                                          AND CURRENT ROW) AS BIGINT) AS total_users
        FROM d ORDER BY day""",
    "data_quality": """
        , q AS (SELECT count(*) AS checked,
                  count(*) FILTER (WHERE event_id IS NULL OR user_id IS NULL OR song_id IS NULL)
                    AS missing_required_fields,
                  count(*) FILTER (WHERE event_id IS NULL AND user_id IS NULL AND song_id IS NULL
                                     AND ts IS NULL AND event_type IS NULL) AS malformed_message,
                  (SELECT count(*) FROM events WHERE event_id % 50 = 3) AS wrong_type,
                  count(*) FILTER (WHERE ts IS NULL) AS bad_timestamp,
                  count(*) FILTER (WHERE event_type IS NULL
                                     OR event_type NOT IN ('PLAY', 'SKIP', 'LIKE'))
                    AS unknown_event_type,
                  count(*) FILTER (WHERE user_id <= 0) AS non_positive_user_id,
                  count(event_id) - count(DISTINCT event_id) AS duplicate_event_id
                FROM (SELECT event_id, user_id, song_id, ts, event_type FROM raw_events
                      UNION ALL SELECT * FROM faults))
        SELECT rule, checked, CAST(failed AS BIGINT) AS failed FROM (
          UNPIVOT q ON missing_required_fields, malformed_message, wrong_type, bad_timestamp,
                       unknown_event_type, non_positive_user_id, duplicate_event_id
          INTO NAME rule VALUE failed) u""",
    "bronze_quarantine": """
        SELECT event_id, user_id, song_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp", event_type,
               '{"event_id":"' || event_id || '","user_id":' || user_id || ',"timestamp":"'
                 || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","event_type":"' || event_type
                 || '","duration_seconds":' || duration_seconds || '}' AS raw_value,
               'MISSING_REQUIRED_FIELDS' AS error_type
        FROM raw_events WHERE song_id IS NULL
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, 'not json ' || event_id, 'MISSING_REQUIRED_FIELDS'
        FROM events WHERE event_id % 50 = 2
        UNION ALL
        SELECT event_id || 'f', NULL, ' song_1 ', strftime(ts, '%Y-%m-%d %H:%M:%S'), 'PLAY',
               '{"event_id":"' || event_id || 'f","user_id":"' || user_id || '","song_id":" song_1 ","timestamp":"'
                 || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","event_type":"PLAY"}', 'MISSING_REQUIRED_FIELDS'
        FROM events WHERE event_id % 50 = 3""",
    "gold_rejects": """
        SELECT f.event_id, f.user_id, coalesce(u.user_name, 'Guest') AS user_name, f.song_id,
               coalesce(s.song_name, 'Unknown') AS song_name, f.event_type
        FROM faults f LEFT JOIN dim_users u ON f.user_id = u.user_id
        LEFT JOIN dim_songs s ON trim(f.song_id) = s.song_id
        WHERE f.ts IS NULL AND f.event_id IS NOT NULL""",
    "gold_event_types": """
        SELECT coalesce(event_type, 'N/A') AS event_type, count(*) AS events FROM (
          SELECT event_type FROM gold
          UNION ALL SELECT event_type FROM faults
          WHERE ts IS NOT NULL AND event_id IS NOT NULL AND user_id IS NOT NULL) GROUP BY 1""",
    "dim_songs_newest": """
        SELECT song_id, song_name || CASE WHEN CAST(substr(song_id, 6) AS BIGINT) % 6 = 0 THEN ' v2' ELSE '' END
                 AS song_name, artist_name, genre
        FROM dim_songs""",
    "dim_users_newest": """
        SELECT user_id, user_name, CASE WHEN user_id % 6 = 0 THEN 'MOVED' ELSE country END AS country,
               subscription_type, is_current
        FROM dim_users""",
    "songs_landing_roundtrip": """
        SELECT 'song_' || p_partkey AS song_id, p_name AS song_name, p_brand AS artist_name,
               p_name || ' - Single' AS album_name, CAST(p_size AS BIGINT) AS duration_ms, p_type AS genre,
               '2024-01-01T00:00:00' AS ingested_at
        FROM part""",
    "users_landing_roundtrip": """
        SELECT CAST(user_id AS VARCHAR) AS user_id, user_name, country, subscription_type,
               '2024-01-01T00:00:00' AS ingested_at
        FROM dim_users""",
    "track_pages_roundtrip": """
        SELECT CASE WHEN p_size = 2 THEN NULL ELSE p_name END AS name,
               CASE WHEN p_size % 3 = 0 THEN '' ELSE 'mb-' || p_partkey END AS mbid,
               CASE WHEN p_size = 1 THEN '' ELSE p_brand END AS artist
        FROM part""",
    "recommendation_history": f"""
        SELECT user_id, user_name, rank, song, TIMESTAMP '{_SPLIT}' AS updated_at FROM {_FIRST} a
        UNION ALL
        SELECT user_id, user_name, rank, song, TIMESTAMP '2024-02-01 00:00:00' FROM {_SECOND} b""",
    "recommendation_candidates": """
        , p AS (SELECT DISTINCT user_id, country, song_id FROM gold WHERE event_type = 'PLAY'),
        c AS (SELECT country, song_id,
                     row_number() OVER (PARTITION BY country ORDER BY count(*) DESC, song_id) AS rk
              FROM gold WHERE event_type = 'PLAY' GROUP BY country, song_id),
        n AS (SELECT u.user_id, u.country, c.song_id,
                     row_number() OVER (PARTITION BY u.user_id, u.country ORDER BY c.rk) AS k
              FROM (SELECT DISTINCT user_id, country FROM p) u JOIN c ON u.country = c.country
              WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.user_id = u.user_id AND p.song_id = c.song_id))
        SELECT DISTINCT user_id, song_id FROM n WHERE k <= 50""",
    "track_catalog": """
        SELECT CASE WHEN mbid <> '' THEN mbid
                    ELSE 'lf_' || md5(name || chr(31) || artist) END AS song_id,
               name AS song_name, artist AS artist_name, name || ' - Single' AS album_name,
               CAST(NULL AS BIGINT) AS duration_ms, CAST(NULL AS VARCHAR) AS genre,
               '2024-02-01T00:00:00' AS ingested_at
        FROM (SELECT CASE WHEN p_size = 2 THEN NULL ELSE p_name END AS name,
                     CASE WHEN p_size % 3 = 0 THEN '' ELSE 'mb-' || CAST(p_partkey AS VARCHAR) END
                       AS mbid,
                     CASE WHEN p_size = 1 THEN '' ELSE p_brand END AS artist
              FROM part) t
        WHERE coalesce(name, '') <> '' AND coalesce(artist, '') <> ''""",
    "dim_users_upsert": """
        , upd AS (
          SELECT CAST(c_custkey AS INTEGER) AS user_id, c_name AS user_name, 'RELOCATED' AS country,
                 'Free' AS subscription_type, true AS is_current
          FROM customer JOIN nation ON c_nationkey = n_nationkey
          WHERE c_mktsegment = 'AUTOMOBILE'
          UNION ALL
          SELECT CAST(c_custkey + 100000000 AS INTEGER), c_name, n_name, 'Free', true
          FROM customer JOIN nation ON c_nationkey = n_nationkey
          WHERE c_mktsegment = 'BUILDING')
        SELECT * FROM dim_users WHERE user_id NOT IN (SELECT user_id FROM upd)
        UNION ALL SELECT * FROM upd""",
    "streaming_gold": """
        SELECT event_id, user_id, user_name, song_id, song_name, artist_name, genre,
               subscription_type, country, event_type, event_timestamp, event_month
        FROM gold""",
    "streaming_trend": """
        SELECT time_bucket(INTERVAL '1 hour', event_timestamp) AS time, event_type,
               count(*) AS count
        FROM gold GROUP BY 1, 2""",
    "streaming_dedupe": """
        SELECT event_id, user_id, song_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
               event_type
        FROM valid_events""",
    # late rows settled: every event once, as if nothing had come late
    "streaming_late_rows": """
        SELECT event_id, user_id, song_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
               event_type
        FROM valid_events""",
}

_VERSIONS = """
, uv AS (
  SELECT user_id, user_name, country, subscription_type, TIMESTAMP '2024-01-01 00:00:00' AS valid_from FROM dim_users
  UNION ALL
  SELECT user_id, user_name, 'MOVED', subscription_type, TIMESTAMP '2024-01-10 00:00:00' FROM dim_users
  WHERE user_id % 3 = 0
  UNION ALL
  SELECT user_id, user_name, CASE WHEN user_id % 3 = 0 THEN 'MOVED' ELSE country END, 'Premium',
         TIMESTAMP '2024-01-20 12:00:00' FROM dim_users
  WHERE user_id % 5 = 0 AND subscription_type <> 'Premium'),
uh AS (SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS valid_to FROM uv),
sk AS (SELECT *, CAST(substr(song_id, 6) AS BIGINT) AS k FROM dim_songs),
sv AS (
  SELECT song_id, song_name, artist_name, genre, CASE WHEN k % 7 = 0 THEN TIMESTAMP '2024-01-05 00:00:00'
         ELSE TIMESTAMP '2024-01-01 00:00:00' END AS valid_from FROM sk
  UNION ALL
  SELECT song_id, song_name || ' (remaster)', artist_name, genre, TIMESTAMP '2024-01-15 06:00:00' FROM sk WHERE k % 4 = 0),
sh AS (SELECT *, lead(valid_from) OVER (PARTITION BY song_id ORDER BY valid_from) AS valid_to FROM sv)
"""

_SESSIONS = """
, marked AS (
  SELECT user_id, event_timestamp AS t, event_type,
         CASE WHEN event_timestamp - lag(event_timestamp) OVER (PARTITION BY user_id ORDER BY event_timestamp)
              <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh
  FROM gold WHERE user_id IS NOT NULL),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS no FROM marked),
s AS (SELECT user_id, min(t) AS started, max(t) AS ended, count(*) AS events,
             count(*) FILTER (WHERE event_type = 'PLAY') AS plays, count(*) FILTER (WHERE event_type = 'SKIP') AS skips
      FROM numbered GROUP BY user_id, no)
"""

ORACLE |= {
    "dim_users_upsert_buckets": ORACLE["dim_users_upsert"],
    "message_types": """
        , f AS (
          SELECT unnest([
                   {'field': 'event_id', 'type': 'STRING'}, {'field': 'user_id', 'type': 'BIGINT'},
                   {'field': 'song_id', 'type': CASE WHEN song_id IS NULL THEN 'MISSING' ELSE 'STRING' END},
                   {'field': 'timestamp', 'type': 'STRING'}, {'field': 'event_type', 'type': 'STRING'},
                   {'field': 'duration_seconds', 'type': 'BIGINT'}]) AS x
          FROM raw_events
          UNION ALL
          SELECT unnest(CASE WHEN event_id % 50 = 2 THEN [{'field': '(message)', 'type': 'MALFORMED'}] ELSE [
                   {'field': 'event_id', 'type': 'STRING'},
                   {'field': 'user_id', 'type': CASE WHEN event_id % 50 = 3 THEN 'STRING' ELSE 'BIGINT' END},
                   {'field': 'song_id', 'type': 'STRING'}, {'field': 'timestamp', 'type': 'STRING'},
                   {'field': 'event_type', 'type': CASE WHEN event_id % 50 = 1 THEN 'VOID' ELSE 'STRING' END}] END)
          FROM events WHERE event_id % 50 <= 6)
        SELECT x.field AS field, x.type AS type, count(*) AS messages,
               x.type NOT IN ('MALFORMED', 'MISSING', 'VOID') AND NOT (x.field = 'user_id' AND x.type = 'STRING') AS ok
        FROM f GROUP BY 1, 2""",
    "listening_sessions": _SESSIONS + "SELECT * FROM s",
    "streaming_sessions": _SESSIONS + "SELECT * FROM s",
    "listening_patterns": _SESSIONS + """
        , d AS (SELECT *, epoch(ended) - epoch(started) AS seconds,
                       epoch(started) - epoch(lag(ended) OVER (PARTITION BY user_id ORDER BY started)) AS pause FROM s)
        SELECT user_id, count(*) AS sessions, CAST(sum(events) AS BIGINT) AS events,
               quantile_cont(seconds, 0.5) AS median_seconds, quantile_cont(seconds, 0.9) AS p90_seconds,
               CAST(max(seconds) AS BIGINT) AS longest_seconds, quantile_cont(events, 0.5) AS median_events,
               quantile_cont(pause, 0.5) AS median_pause_seconds
        FROM d GROUP BY user_id""",
    "listeners_by_week": """
        SELECT date_trunc('week', event_timestamp) AS week, country,
               count(DISTINCT user_id) AS listeners, true AS within_bound
        FROM gold GROUP BY 1, 2""",
    "top_songs_leaders": ORACLE["top_songs"],
}

_TIMES = ["2000-01-01 00:00:00", "2024-01-08 00:00:00", "2024-01-16 00:00:00", "2024-01-24 00:00:00"]
_GENERATIONS = " UNION ALL ".join(
    f"SELECT user_id, song, TIMESTAMP '{made}' AS made FROM "
    + _recs_sql(f"event_timestamp >= TIMESTAMP '{since}' AND event_timestamp < TIMESTAMP '{made}'") + f" g{i}"
    for i, (since, made) in enumerate(zip(_TIMES, _TIMES[1:])))

ORACLE |= {
    "recommendation_attribution": f"""
        , lists AS (SELECT user_id, made, list(song) AS songs FROM ({_GENERATIONS}) GROUP BY 1, 2),
        force AS (SELECT *, lead(made) OVER (PARTITION BY user_id ORDER BY made) AS until FROM lists),
        played AS (SELECT f.made, e.user_id, list_contains(f.songs, e.song_name || ' - ' || e.artist_name) AS hit
                   FROM gold e JOIN force f ON e.user_id = f.user_id AND e.event_timestamp >= f.made
                        AND (f.until IS NULL OR e.event_timestamp < f.until)
                   WHERE e.event_type = 'PLAY')
        SELECT l.made AS updated_at, l.users, coalesce(p.plays, 0) AS plays, coalesce(p.hits, 0) AS attributed_plays,
               coalesce(p.fans, 0) AS attributed_users, p.hits / p.plays AS attributed_share
        FROM (SELECT made, count(*) AS users FROM lists GROUP BY 1) l
        LEFT JOIN (SELECT made, count(*) AS plays, count(*) FILTER (WHERE hit) AS hits,
                          count(DISTINCT user_id) FILTER (WHERE hit) AS fans FROM played GROUP BY 1) p USING (made)""",
    "dim_users_history": _VERSIONS + "SELECT * FROM uh",
    "silver_point_in_time": _VERSIONS + """
        SELECT e.event_id, e.user_id, e.song_id, u.user_name, s.song_name, s.artist_name, s.genre,
               strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS event_timestamp, e.event_type,
               u.subscription_type, u.country
        FROM (SELECT *, date_trunc('second', ts) AS at FROM valid_events) e
        LEFT JOIN uh u ON e.user_id = u.user_id AND e.at >= u.valid_from
             AND (u.valid_to IS NULL OR e.at < u.valid_to)
        LEFT JOIN sh s ON trim(e.song_id) = s.song_id AND e.at >= s.valid_from
             AND (s.valid_to IS NULL OR e.at < s.valid_to)""",
    # filled in, gold is what a full rebuild gives
    "gold_backfilled": ORACLE["gold_events"],
}


def oracle_sql() -> dict[str, str]:
    return {k: PREFIX + v for k, v in ORACLE.items()}
