"""Independent SQL for the registered queries, in DuckDB's dialect.

The SQL is written from the model definitions, not from the Spark code. Rounded figures use
exact integer arithmetic (microseconds) on both sides. Epoch milliseconds are whole
milliseconds elapsed, ``epoch_us // 1000`` (``epoch_ms`` rounds to the nearest one).
"""

from __future__ import annotations

_ARTIST = """CASE p_size WHEN 1 THEN {blank} WHEN 2 THEN NULL ELSE concat(' ', p_brand, ' ') END"""
_LEVEL = """CASE c_mktsegment WHEN 'BUILDING' THEN 'paid' WHEN 'MACHINERY' THEN 'PAID'
    WHEN 'HOUSEHOLD' THEN NULL ELSE 'free' END"""


def _star(blank: str = "'  '") -> str:
    return f"""
star_raw AS (
  SELECT o_custkey::INT AS "userId", o_orderkey::INT AS "sessionId",
    l_linenumber::INT AS "itemInSession", {_ARTIST.format(blank=blank)} AS artist,
    p_name AS song, l_quantity * 10 AS length, {_LEVEL} AS level,
    epoch_us(l_shipdate) // 1000 + (l_orderkey * 7919 % 86400) * 1000 AS ts,
    CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, c_name AS "firstName",
    '' AS "lastName", o_orderpriority AS "userAgent", 'Logged In' AS auth,
    0::BIGINT AS registration
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey),
star AS (SELECT *, epoch_ms(ts)::DATE AS event_date FROM star_raw)"""


def _events(blank: str = "'  '", undated: bool = False) -> str:
    time = "epoch_us(ts) // 1000"
    shown = f"CASE WHEN event_id % 97 <> 0 THEN {time} END" if undated else time
    return f"""
-- Materialised: the engine fails when it pushes the page filter down to the parquet columns.
base_raw AS MATERIALIZED (
  SELECT event_id, event_type, cast(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CASE WHEN event_id % 89 <> 0 THEN user_id END::INT AS "userId",
    (user_id * 100 + dayofmonth(ts) + event_id % 3 * 31)::INT AS "sessionId",
    (event_id % 100)::INT AS "itemInSession", {_ARTIST.format(blank=blank)} AS artist,
    p_name AS song, value AS length, {_LEVEL} AS level, {shown} AS ts,
    CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender, c_name AS "firstName",
    CASE event_id % 5 WHEN 0 THEN chr(9) || 'Lee' || chr(160) WHEN 1 THEN chr(9) || ' '
      WHEN 2 THEN NULL ELSE '' END AS "lastName",
    'browser ' || event_id % 4 AS "userAgent", 'Logged In' AS auth,
    {time} - event_id % 1000 * 86400000 AS registration
  FROM events JOIN customer ON user_id = c_custkey
    JOIN part ON event_id % (SELECT count(*) FROM part) = p_partkey),
base AS (SELECT *, epoch_ms(ts)::DATE AS event_date FROM base_raw),
listen_events AS (SELECT * FROM base WHERE event_type IN ('click', 'view')),
page_view_events AS MATERIALIZED (
  SELECT *, CASE k % 10 WHEN 0 THEN 'Error' WHEN 1 THEN 'Upgrade' WHEN 2 THEN ' Save Settings '
      WHEN 3 THEN '  ' WHEN 4 THEN 'Home' WHEN 5 THEN ' Help' WHEN 6 THEN 'About'
      WHEN 7 THEN 'Logout' ELSE 'NextSong' END AS page,
    CASE WHEN k % 2 = 0 THEN 'GET' ELSE 'PUT' END AS method,
    (CASE WHEN k % 10 = 0 THEN 404 ELSE 200 END)::INT AS status
  FROM base),
auth_events AS (SELECT *, k % 4 <> 0 AS success FROM base WHERE event_type = 'signup'),
status_change_events AS (SELECT * FROM base WHERE event_type = 'purchase')"""


_IDS = """"userId"::BIGINT AS user_id, "sessionId"::BIGINT AS session_id,
    "itemInSession" AS item_in_session"""
_PERSON = """gender, nullif(trim("firstName"), '') AS first_name,
    nullif(trim("lastName", ' ' || chr(9) || chr(160)), '') AS last_name"""
_WHEN = """epoch_ms(ts) AS event_timestamp, event_date, hour(epoch_ms(ts))::INT AS hour_of_day,
    (dayofweek(epoch_ms(ts)) + 1)::INT AS day_of_week"""
_PAID = "lower(level) AS level, level = 'paid' AS is_paid"


def _silver_listen(raw: str) -> str:
    return f"""
silver_listen_events AS (
  SELECT {_IDS}, nullif(trim(artist), '') AS artist, nullif(trim(song), '') AS song,
    length::DOUBLE AS duration_seconds, {_PAID}, {_PERSON}, "userAgent" AS user_agent,
    registration, {_WHEN}, strftime(epoch_ms(ts), '%U')::INT AS week_of_year
  FROM {raw} WHERE "userId" IS NOT NULL AND song IS NOT NULL AND artist IS NOT NULL)"""


_SILVER_REST = f"""
silver_page_view_events AS (
  SELECT * FROM (
    SELECT {_IDS}, nullif(trim(page), '') AS page, {_PAID}, {_PERSON},
      nullif(trim("userAgent"), '') AS user_agent, {_WHEN}, method AS http_method,
      status AS http_status, auth, registration
    FROM page_view_events WHERE "userId" IS NOT NULL)
  WHERE page NOT IN ('Error', 'Upgrade', 'Submit Upgrade', 'Submit Downgrade',
    'Cancellation Confirmation', 'Save Settings', 'Submit Registration')),
silver_auth_events AS (
  SELECT {_IDS}, success AS is_successful, {_PAID}, {_PERSON}, registration, {_WHEN}
  FROM auth_events WHERE "userId" IS NOT NULL),
silver_status_change_events AS (
  SELECT {_IDS}, lower(level) AS level,
    CASE WHEN lower(level) = 'paid' THEN 'upgrade' WHEN lower(level) = 'free' THEN 'downgrade'
      ELSE 'other' END AS change_category,
    auth AS auth_status, {_PERSON}, registration, {_WHEN}
  FROM status_change_events WHERE "userId" IS NOT NULL)"""

_US = "sum(floor(duration_seconds * 1000000 + 0.5)::BIGINT)"
_N = "count(duration_seconds)"
_HOURS = f"(({_US} * 200 + 3600000000) // 7200000000)::DOUBLE / 100"
_MINUTES = f"(({_US} * 200 + 60000000) // 120000000)::DOUBLE / 100"
_MEAN = f"(({_US} * 200 + {_N} * 60000000) // nullif({_N} * 120000000, 0))::DOUBLE / 100"

_DAILY = f"""
gold_daily_listening_stats AS (
  SELECT event_date, count(*) AS total_plays, count(DISTINCT user_id) AS unique_listeners,
    count(DISTINCT artist) AS unique_artists, count(DISTINCT song) AS unique_songs,
    count(DISTINCT session_id) AS unique_sessions, {_HOURS} AS total_listening_hours,
    {_MEAN} AS avg_track_duration_minutes,
    count(*) FILTER (WHERE is_paid) AS paid_plays,
    count(*) FILTER (WHERE NOT is_paid) AS free_plays,
    ((count(*) FILTER (WHERE is_paid) * 2000 + count(*)) // (count(*) * 2))::DOUBLE / 10
      AS paid_play_pct
  FROM silver_listen_events GROUP BY event_date)"""
_ARTISTS = f"""
gold_top_artists_daily AS (
  SELECT event_date, artist, count(*) AS play_count,
    count(DISTINCT user_id) AS unique_listeners, count(DISTINCT song) AS unique_songs,
    {_HOURS} AS total_listening_hours,
    rank() OVER (PARTITION BY event_date ORDER BY count(*) DESC) AS daily_rank
  FROM silver_listen_events WHERE artist IS NOT NULL GROUP BY event_date, artist)"""
_SONGS = f"""
gold_top_songs_daily AS (
  SELECT event_date, song, artist, count(*) AS play_count,
    count(DISTINCT user_id) AS unique_listeners, {_MEAN} AS avg_duration_minutes,
    rank() OVER (PARTITION BY event_date ORDER BY count(*) DESC) AS daily_rank
  FROM silver_listen_events WHERE song IS NOT NULL GROUP BY event_date, song, artist)"""
_HEATMAP = f"""
gold_hourly_listening_heatmap AS (
  SELECT day_of_week, hour_of_day, count(*) AS play_count,
    count(DISTINCT user_id) AS unique_listeners, {_MEAN} AS avg_duration_minutes
  FROM silver_listen_events GROUP BY day_of_week, hour_of_day)"""
_ACTIVITY = f"""
gold_user_activity_daily AS (
  SELECT l.*, coalesce(page_view_count, 0) AS page_view_count,
    coalesce(unique_pages_visited, 0) AS unique_pages_visited,
    coalesce(sessions_with_page_views, 0) AS sessions_with_page_views,
    coalesce(upgrade_count, 0) AS upgrade_count,
    coalesce(downgrade_count, 0) AS downgrade_count, coalesce(churn_events, 0) AS churn_events
  FROM (SELECT event_date, user_id, max(first_name) AS first_name, max(last_name) AS last_name,
      max(gender) AS gender, max(level) AS level, count(*) AS play_count,
      count(DISTINCT session_id) AS sessions_with_plays,
      count(DISTINCT artist) AS unique_artists, {_MINUTES} AS total_listening_minutes
    FROM silver_listen_events GROUP BY event_date, user_id) l
  LEFT JOIN (SELECT event_date, user_id, count(*) AS page_view_count,
      count(DISTINCT page) AS unique_pages_visited,
      count(DISTINCT session_id) AS sessions_with_page_views
    FROM silver_page_view_events GROUP BY event_date, user_id) p USING (event_date, user_id)
  LEFT JOIN (SELECT event_date, user_id,
      count(*) FILTER (WHERE change_category = 'upgrade') AS upgrade_count,
      count(*) FILTER (WHERE change_category = 'downgrade') AS downgrade_count,
      count(*) FILTER (WHERE change_category = 'churn') AS churn_events
    FROM silver_status_change_events GROUP BY event_date, user_id) s
    USING (event_date, user_id))"""
_QOQ = """
gold_qoq_listener_growth AS (
  SELECT *, CASE WHEN qoq_growth_pct > 0 THEN 'growth' WHEN qoq_growth_pct < 0 THEN 'decline'
      WHEN qoq_growth_pct = 0 THEN 'flat' ELSE 'first quarter' END AS trend
  FROM (SELECT quarter_start, quarter_label, unique_listeners, p AS prev_quarter_listeners,
      (sign(unique_listeners - p)
        * ((abs(unique_listeners - p) * 2000 + p) // nullif(2 * p, 0)))::DOUBLE / 10
        AS qoq_growth_pct
    FROM (SELECT *, lag(unique_listeners) OVER (ORDER BY quarter_start) AS p
      FROM (SELECT date_trunc('quarter', event_date)::DATE AS quarter_start,
          year(event_date) || '-Q' || quarter(event_date) AS quarter_label,
          count(DISTINCT user_id) AS unique_listeners
        FROM silver_listen_events GROUP BY 1, 2))))"""

_GOLD = [_DAILY, _ARTISTS, _SONGS, _HEATMAP, _ACTIVITY, _QOQ]
_GOLD_NAMES = [
    "gold_daily_listening_stats",
    "gold_top_artists_daily",
    "gold_top_songs_daily",
    "gold_hourly_listening_heatmap",
    "gold_user_activity_daily",
    "gold_qoq_listener_growth",
]


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def _on_star(*ctes: str, select: str) -> str:
    return _with(_star(), _silver_listen("star"), *ctes, select=select)


def _on_events(
    *ctes: str, select: str, blank: str = "'  '", undated: bool = False
) -> str:
    return _with(
        _events(blank, undated), _silver_listen("listen_events"), _SILVER_REST, *ctes, select=select
    )


def _counts(tables: list[str], name: str = "table_name", count: str = "rows_loaded") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS {name}, true AS is_ready, count(*) AS {count} FROM {t}" for t in tables
    )


def _not_null(table: str, column: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", 'not_null' AS test, "
        f"count(*) FILTER (WHERE {column} IS NULL) AS failures FROM {table}"
    )


def _unique(table: str, column: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", 'unique' AS test, "
        f"count(*) AS failures FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)"
    )


def _accepted(table: str, column: str, values: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", 'accepted_values' AS test, "
        f"count(DISTINCT {column}) AS failures FROM {table} WHERE {column} NOT IN ({values})"
    )


_SILVER_AUDIT = "\nUNION ALL ".join(
    [
        *[
            _not_null("silver_listen_events", c)
            for c in (
                "user_id",
                "artist",
                "song",
                "duration_seconds",
                "event_timestamp",
                "event_date",
            )
        ],
        _accepted("silver_listen_events", "level", "'paid', 'free'"),
        *[
            _not_null(t, c)
            for t in (
                "silver_page_view_events",
                "silver_auth_events",
            )
            for c in ("user_id", "event_date")
        ],
        _not_null("silver_status_change_events", "user_id"),
        _accepted(
            "silver_status_change_events",
            "change_category",
            "'upgrade', 'downgrade', 'churn', 'other'",
        ),
    ]
)
_GOLD_AUDIT = "\nUNION ALL ".join(
    [
        _not_null("gold_daily_listening_stats", "event_date"),
        _unique("gold_daily_listening_stats", "event_date"),
        _not_null("gold_daily_listening_stats", "total_plays"),
        _not_null("gold_top_artists_daily", "event_date"),
        _not_null("gold_top_artists_daily", "artist"),
        _not_null("gold_top_songs_daily", "event_date"),
        _not_null("gold_top_songs_daily", "song"),
        _not_null("gold_user_activity_daily", "event_date"),
        _not_null("gold_user_activity_daily", "user_id"),
        _not_null("gold_hourly_listening_heatmap", "day_of_week"),
        _not_null("gold_hourly_listening_heatmap", "hour_of_day"),
        _not_null("gold_qoq_listener_growth", "quarter_start"),
        _unique("gold_qoq_listener_growth", "quarter_start"),
        _not_null("gold_qoq_listener_growth", "quarter_label"),
        _not_null("gold_qoq_listener_growth", "unique_listeners"),
    ]
)

_BRONZE = {
    "listen_events": (
        'artist, auth, "firstName", gender, "itemInSession", "lastName", length, level, '
        '"userAgent", registration, "sessionId", song, ts, "userId", event_date'
    ),
    "page_view_events": (
        'auth, "firstName", gender, "itemInSession", "lastName", level, method, page, '
        'registration, "sessionId", status, ts, "userId", "userAgent", artist, song, length, '
        "event_date"
    ),
    "auth_events": (
        'ts, "sessionId", level, "itemInSession", "userId", "lastName", "firstName", gender, '
        "registration, success, event_date"
    ),
    "status_change_events": (
        'auth, "firstName", gender, "itemInSession", "lastName", level, registration, '
        '"sessionId", ts, "userId", event_date'
    ),
}
_TOPICS = list(_BRONZE)


_BAD_LINES = """lines AS (SELECT event_id, event_id % 11 AS kind,
    '{"event_id": ' || event_id || ', "k": ' || event_id || ', "ts": ' || event_id
      || ', "userId": ' || event_id || '}' AS line FROM events)"""
_SILVER_COLUMNS = {
    "silver_listen_events": (
        "user_id,session_id,item_in_session,artist,song,duration_seconds,level,is_paid,gender,"
        "first_name,last_name,user_agent,registration,event_timestamp,event_date,hour_of_day,"
        "day_of_week,week_of_year"
    ),
    "silver_page_view_events": (
        "user_id,session_id,item_in_session,page,level,is_paid,gender,first_name,last_name,"
        "user_agent,event_timestamp,event_date,hour_of_day,day_of_week,http_method,http_status,"
        "auth,registration"
    ),
    "silver_auth_events": (
        "user_id,session_id,item_in_session,is_successful,level,is_paid,gender,first_name,"
        "last_name,registration,event_timestamp,event_date,hour_of_day,day_of_week"
    ),
    "silver_status_change_events": (
        "user_id,session_id,item_in_session,level,change_category,auth_status,gender,first_name,"
        "last_name,registration,event_timestamp,event_date,hour_of_day,day_of_week"
    ),
}


def _rows(tables: dict[str, str], count: str = "count(*)") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, {count} AS \"rows\" FROM {source}"
        for name, source in tables.items()
    )


def _late(table: str) -> str:
    """The days for which late events came in."""
    return (
        f"(SELECT event_date FROM {table} WHERE gender = 'F' "
        "AND event_date IN (DATE '2024-01-10', DATE '2024-01-20'))"
    )


def _rebuilt(table: str, late: str) -> str:
    """A table's rows, and those a run of the changed days writes anew."""
    return (
        f"SELECT '{table}' AS table_name, count(*) AS rows, count(*) FILTER ({late}) AS new_rows "
        f"FROM {table}"
    )


_CHANGED_DAYS = "\nUNION ALL ".join(
    [
        *[_rebuilt(f"silver_{t}", f"event_date IN {_late(t)}") for t in _TOPICS],
        *[
            _rebuilt(f"gold_{t}", f"event_date IN {_late('listen_events')}")
            for t in ("daily_listening_stats", "top_artists_daily", "top_songs_daily")
        ],
        _rebuilt("gold_user_activity_daily", f"event_date IN {_late('page_view_events')}"),
        *[
            _rebuilt(f"gold_{t}", f"EXISTS {_late('listen_events')}")
            for t in ("hourly_listening_heatmap", "qoq_listener_growth")
        ],
    ]
)


def _more() -> dict[str, str]:
    """Missing times, bad lines, order, restarts and the steps of the flow one by one."""
    undated = {
        "daily": (_DAILY, "gold_daily_listening_stats"),
        "artists": (_ARTISTS, "gold_top_artists_daily"),
        "songs": (_SONGS, "gold_top_songs_daily"),
        "activity": (_ACTIVITY, "gold_user_activity_daily"),
    }
    return {
        **{
            f"undated_{name}": _on_events(cte, select=f"SELECT * FROM {table}", undated=True)
            for name, (cte, table) in undated.items()
        },
        "dq_undated": _on_events(select=_SILVER_AUDIT, undated=True),
        "top_songs_top1": _on_star(
            _SONGS, select="SELECT * FROM gold_top_songs_daily WHERE daily_rank <= 1"
        ),
        "presented_order": _on_star(
            _HEATMAP,
            select="""SELECT day_of_week, hour_of_day,
              row_number() OVER (ORDER BY day_of_week, hour_of_day) AS position
            FROM gold_hourly_listening_heatmap""",
        ),
        "stream_dedup": _on_events(
            select=f"SELECT DISTINCT {_BRONZE['page_view_events']} FROM page_view_events"
        ),
        "stream_dedup_restart": _on_events(
            select=f"""SELECT (slice // 2 + 1)::INT AS run,
              sum(sum(n)) OVER (ORDER BY slice // 2)::BIGINT AS rows,
              sum(sum(n)) OVER (ORDER BY slice // 2)::BIGINT AS different
            FROM (
              SELECT (ts - (SELECT min(ts) FROM auth_events)) // 691200000 AS slice, count(*) AS n
              FROM (SELECT DISTINCT {_BRONZE['auth_events']} FROM auth_events) GROUP BY 1)
            GROUP BY slice // 2"""
        ),
        "stream_top_songs": _on_events(
            select="""SELECT window_start, window_start + INTERVAL 2 DAY AS window_end, song, plays,
              song_rank
            FROM (
              SELECT window_start, song, count(*) AS plays,
                rank() OVER (PARTITION BY window_start ORDER BY count(*) DESC) AS song_rank
              FROM (
                SELECT song, epoch_ms((ts // 86400000 - back) * 86400000) AS window_start
                FROM listen_events, (VALUES (0), (1)) AS days (back))
              GROUP BY window_start, song)
            WHERE song_rank <= 3 AND epoch_ms(window_start) + 172800000
              <= (SELECT max(ts) - 86400000 FROM listen_events)"""
        ),
        "stream_sessions": _on_events(
            select="""SELECT epoch_ms(min(ts)) AS session_start, epoch_ms(max(ts)) AS last_event,
              "userId", count(*) AS events
            FROM (
              SELECT *, sum(starts) OVER (PARTITION BY "userId" ORDER BY ts) AS session
              FROM (
                SELECT "userId", ts, (coalesce(ts - lag(ts) OVER (
                  PARTITION BY "userId" ORDER BY ts) >= 43200000, TRUE))::INT AS starts
                FROM page_view_events WHERE "userId" IS NOT NULL))
            GROUP BY "userId", session
            HAVING max(ts) + 43200000 <= (SELECT max(ts) - 3600000 FROM page_view_events)"""
        ),
        "ingest_counts": _with(
            _BAD_LINES,
            select="""SELECT 2::BIGINT AS batches, count(*) FILTER (kind <> 1) AS lines,
              count(*) FILTER (kind IN (3, 4, 5, 6)) AS malformed, 0::BIGINT AS rejected,
              count(*) FILTER (kind NOT IN (1, 3, 4, 5, 6)) AS rows
            FROM lines""",
        ),
        "paced_replay": _on_events(
            select="""SELECT batch_id, rows, first_ts, last_ts,
              coalesce(first_ts <= lag(last_ts) OVER (ORDER BY batch_id), FALSE) AS overlaps
            FROM (
              SELECT dense_rank() OVER (ORDER BY slice) - 1 AS batch_id, count(*) AS rows,
                min(ts) AS first_ts, max(ts) AS last_ts
              FROM (SELECT ts, (ts - min(ts) OVER ()) // 691200000 AS slice FROM listen_events)
              GROUP BY slice)"""
        ),
        "changed_days": _on_events(
            _ACTIVITY,
            blank="'Indie'",
            select=f"""SELECT *, event_date IN {_late('page_view_events')} AS rebuilt
            FROM gold_user_activity_daily""",
        ),
        "changed_days_tables": _on_events(*_GOLD, blank="'Indie'", select=_CHANGED_DAYS),
        "qoq_from_sets": _on_star(_QOQ, select="SELECT * FROM gold_qoq_listener_growth"),
        "listeners_from_sets": _on_star(
            select="\nUNION ALL ".join(
                f"SELECT '{span}' AS span, {key} AS key, "
                "count(DISTINCT user_id) AS unique_listeners FROM silver_listen_events GROUP BY 2"
                for span, key in (
                    ("day", "event_date::VARCHAR"),
                    ("cell", "day_of_week || ' ' || hour_of_day"),
                    ("year", "year(event_date)::VARCHAR"),
                )
            )
        ),
        "cohort_quarters": _with(
            _star(),
            """spans AS (
              SELECT o_custkey AS user, min(o_orderdate)::DATE AS low, max(o_orderdate)::DATE AS high
              FROM orders GROUP BY 1),
            quarters AS (
              SELECT DISTINCT make_date(1992 + q // 4, q % 4 * 3 + 1, 1) AS first
              FROM range(40) r(q))""",
            select="""SELECT CASE WHEN "userId" <= 700 THEN 'control' ELSE 'test' END AS cohort,
              year(first) || '_Q' || quarter(first) AS label, count(*) AS plays,
              count(DISTINCT "userId") AS users, min(event_date) AS first_day,
              max(event_date) AS last_day
            FROM star JOIN spans ON "userId" = "user" JOIN quarters
              ON event_date BETWEEN greatest(first, low)
                AND least((first + INTERVAL 3 MONTH)::DATE - 1, high)
            GROUP BY 1, 2""",
        ),
        "user_activity_bucketed": _on_events(
            _ACTIVITY, select="SELECT * FROM gold_user_activity_daily"
        ),
        "dq_observed": _on_events(select=_SILVER_AUDIT),
        "layer_creation": _on_events(
            select="""SELECT layer, TRUE AS created,
              CASE layer WHEN 'silver' THEN (SELECT count(*) FROM silver_auth_events) ELSE 0 END
                AS rows
            FROM (VALUES ('bronze'), ('silver'), ('gold')) AS layers (layer)"""
        ),
        "json_bad_lines": _with(
            _BAD_LINES,
            select="""SELECT event_id, event_id::INT AS k FROM lines
            WHERE kind NOT IN (1, 3, 4, 5, 6)""",
        ),
        "json_all_lines": _with(
            _BAD_LINES,
            select="""SELECT event_id, event_id::INT AS k FROM lines
            WHERE kind NOT IN (1, 3, 4, 5, 6)""",
        ),
        "replay_bad_lines": _with(
            _BAD_LINES,
            select="""SELECT event_id::VARCHAR AS key, 'auth-events' AS topic, event_id AS ts,
              line AS value FROM lines WHERE kind NOT IN (1, 2, 3, 4, 6, 7)""",
        ),
        "replay_order": _on_events(
            select="SELECT sum(n)::BIGINT AS messages, 0::BIGINT AS out_of_order FROM ("
            + "\nUNION ALL ".join(f"SELECT count(*) AS n FROM {t}" for t in _TOPICS)
            + ")"
        ),
        "stream_restart": _on_events(
            select="\nUNION ALL ".join(
                f"SELECT {run}::INT AS run, '{t}' AS table_name, "
                f"count(*) FILTER ({run} = 2 OR event_date >= DATE '2024-01-16') AS \"rows\" "
                f"FROM {t}"
                for t in _TOPICS
                for run in (1, 2)
            )
        ),
        "wap_empty_topic": _on_events(
            blank="'Indie'",
            select="\nUNION ALL ".join(
                f"SELECT '{t}' AS table_name, '{columns}' AS columns, "
                f"count(*) FILTER ('{t}' <> 'silver_status_change_events') AS \"rows\" FROM {t}"
                for t, columns in _SILVER_COLUMNS.items()
            ),
        ),
        "status_readiness": _on_events(
            *_GOLD,
            blank="'Indie'",
            select="""SELECT count(*) AS tables, 1::BIGINT AS refresh_times, 0::BIGINT AS missing,
              count(*) AS ready, count(*) AS as_read, sum(rows_loaded)::BIGINT AS rows_loaded
            FROM ("""
            + _counts(_GOLD_NAMES)
            + ")",
        ),
        "selected_run": _on_events(
            _HEATMAP,
            blank="'Indie'",
            select=_rows(
                {t: t for t in ("silver_listen_events", "gold_hourly_listening_heatmap")}
            ),
        ),
        "republish": _on_events(
            select=_rows({"step 2": "silver_auth_events"})
            + "".join(
                f"\nUNION ALL SELECT 'step {n}', count(*) FROM silver_auth_events "
                "WHERE gender = 'F'"
                for n in (1, 3)
            )
        ),
        "table_copy": _on_events(select="SELECT * FROM silver_status_change_events"),
    }


def oracle_sql() -> dict[str, str]:
    sql = {
        "silver_listen_events": _on_star(select="SELECT * FROM silver_listen_events"),
        "daily_listening_stats": _on_star(
            _DAILY, select="SELECT * FROM gold_daily_listening_stats"
        ),
        "top_artists_daily": _on_star(_ARTISTS, select="SELECT * FROM gold_top_artists_daily"),
        "top_songs_daily": _on_star(_SONGS, select="SELECT * FROM gold_top_songs_daily"),
        "top_artists_top3": _on_star(
            _ARTISTS, select="SELECT * FROM gold_top_artists_daily WHERE daily_rank <= 3"
        ),
        "top_songs_top10": _on_star(
            _SONGS, select="SELECT * FROM gold_top_songs_daily WHERE daily_rank <= 10"
        ),
        "hourly_listening_heatmap": _on_star(
            _HEATMAP, select="SELECT * FROM gold_hourly_listening_heatmap"
        ),
        "qoq_listener_growth": _on_star(_QOQ, select="SELECT * FROM gold_qoq_listener_growth"),
        "daily_listening_stats_events": _on_events(
            _DAILY, select="SELECT * FROM gold_daily_listening_stats"
        ),
        "top_artists_daily_events": _on_events(
            _ARTISTS, select="SELECT * FROM gold_top_artists_daily"
        ),
        "top_songs_daily_events": _on_events(
            _SONGS, select="SELECT * FROM gold_top_songs_daily"
        ),
        "user_activity_daily": _on_events(
            _ACTIVITY, select="SELECT * FROM gold_user_activity_daily"
        ),
        "pipeline_status": _on_events(*_GOLD, select=_counts(_GOLD_NAMES)),
        "dq_silver_audit": _on_events(select=_SILVER_AUDIT),
        "dq_gold_audit": _on_events(*_GOLD, select=_GOLD_AUDIT),
        "dq_not_null": _on_star(
            select="""SELECT "column", failures FROM ("""
            + "\nUNION ALL ".join(
                _not_null("silver_listen_events", c) for c in ("user_id", "artist", "is_paid")
            )
            + ")"
        ),
        "dq_unique": _on_events(
            select='SELECT "column", failures FROM ('
            + _unique("silver_auth_events", "session_id")
            + ")"
        ),
        "dq_accepted_values": _with(
            _star(),
            select='SELECT "column", failures FROM ('
            + _accepted("star", "level", "'paid', 'free'")
            + ")",
        ),
        "page_exclusion": _on_events(
            select="SELECT page, count(*) AS views FROM silver_page_view_events GROUP BY page"
        ),
        "blank_to_null": _with(
            _star(),
            select="""SELECT nullif(trim(artist), '') AS artist, count(*) AS plays FROM star
            GROUP BY 1""",
        ),
        "paid_case_quirk": _on_star(
            select="""SELECT level, is_paid, count(*) AS plays FROM silver_listen_events
            GROUP BY level, is_paid"""
        ),
        "change_category": _on_events(
            select="""SELECT change_category, count(*) AS changes
            FROM silver_status_change_events GROUP BY change_category"""
        ),
        "week_of_year": """SELECT l_shipdate::DATE AS ship_date,
            strftime(l_shipdate, '%U')::INT AS week_of_year, count(*) AS lines
            FROM lineitem GROUP BY 1, 2""",
        "time_parts": """SELECT event_id, epoch_ms(epoch_us(ts) // 1000) AS event_timestamp,
            ts::DATE AS event_date, hour(ts)::INT AS hour_of_day,
            (dayofweek(ts) + 1)::INT AS day_of_week,
            date_trunc('quarter', ts)::DATE AS quarter_start,
            year(ts) || '-Q' || quarter(ts) AS quarter_label
            FROM events""",
        "quarter_calendar": """WITH spans AS (
            SELECT o_custkey, min(o_orderdate)::DATE AS s, max(o_orderdate)::DATE AS e
            FROM orders GROUP BY o_custkey),
          quarters AS (
            SELECT o_custkey, s, e, unnest(generate_series(date_trunc('quarter', s)::TIMESTAMP,
              e::TIMESTAMP, INTERVAL 3 MONTH))::DATE AS q FROM spans)
          SELECT o_custkey, greatest(q, s) AS range_start,
            least((q + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE, e) AS range_end,
            year(q) || '_Q' || quarter(q) AS label FROM quarters""",
        "cohort_split": _with(
            _star(),
            select="""SELECT CASE WHEN "userId" <= 700 THEN 'control' ELSE 'test' END AS cohort,
              event_date, count(*) AS plays, count(DISTINCT "userId") AS users
            FROM star GROUP BY 1, 2""",
        ),
        "json_decode": """SELECT event_id, cast(json_extract_string(props, '$.k') AS INT) AS k
            FROM events""",
        "bronze_between": _on_events(
            select="""SELECT event_date, count(*) AS plays FROM silver_listen_events
            WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
            GROUP BY event_date"""
        ),
        "silver_dedup": _with(
            _events(),
            """one_each AS (SELECT * EXCLUDE (n) FROM (
              SELECT *, row_number() OVER (PARTITION BY "userId", "sessionId"
                ORDER BY ts NULLS FIRST, "itemInSession" NULLS FIRST) AS n
              FROM listen_events WHERE "userId" IS NOT NULL AND artist IS NOT NULL) WHERE n = 1)""",
            _silver_listen("one_each"),
            select="SELECT * FROM silver_listen_events",
        ),
        "message_encode": _on_events(
            select='''SELECT coalesce("userId"::VARCHAR, '') AS key, 'page-view-events' AS topic, ts, page,
            artist, length AS duration FROM page_view_events'''
        ),
        "replay_messages": _on_events(
            select="\nUNION ALL ".join(
                f"SELECT coalesce(\"userId\"::VARCHAR, '') AS key, '{t.replace('_', '-')}' AS topic, ts FROM {t}"
                for t in _TOPICS
            )
        ),
        "stream_rejects": _on_events(
            select="""SELECT rejected, count(*) AS "rows", count(DISTINCT "userId") AS users
            FROM (SELECT "userId", gender = 'F' AS rejected FROM auth_events) GROUP BY rejected"""
        ),
        "wap_run": _on_events(
            *_GOLD,
            blank="'Indie'",
            select=_counts(
                [
                    "silver_listen_events",
                    "silver_auth_events",
                    "silver_page_view_events",
                    "silver_status_change_events",
                    *_GOLD_NAMES,
                ]
            ),
        ),
    }
    sql |= _more()
    for name in ("page_view", "auth", "status_change"):
        sql[f"silver_{name}_events"] = _on_events(select=f"SELECT * FROM silver_{name}_events")
    for name, columns in _BRONZE.items():
        sql[f"stream_ingest_{name}"] = _on_events(select=f"SELECT {columns} FROM {name}")
    return sql
