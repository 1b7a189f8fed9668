"""DuckDB SQL for each registered query, over the driver's pre-registered views.

Written independently of the Spark code from the same definitions; it is the
correctness gate. Geometry constants are inserted as the exact doubles the Spark
expressions compute, so boundary comparisons agree bit for bit.
"""

from __future__ import annotations

import re

from touchline.functions.geometry import (
    FRAME_SECONDS,
    PENALTY_AREA_LENGTH_M,
    PENALTY_AREA_WIDTH_M,
    PITCH_LENGTH_M,
    PITCH_WIDTH_M,
)
from touchline.operators import events as ev


def _d(value: float) -> str:
    return f"{float(value)!r}::DOUBLE"


HALF_L = PITCH_LENGTH_M / 2.0
HALF_W = PITCH_WIDTH_M / 2.0
INNER = HALF_L - PENALTY_AREA_LENGTH_M
AREA_HALF_W = PENALTY_AREA_WIDTH_M / 2.0

TRACKING = """
t AS (
  SELECT strftime(ts, '%Y-%m-%d') AS match_date,
         epoch_us(ts) // 1000 AS wall_ms,
         CASE WHEN hour(ts) < 12 THEN 1 ELSE 2 END AS period,
         event_id AS frame_idx,
         CASE WHEN user_id % 2 = 0 THEN 'home' ELSE 'away' END AS side,
         'p' || CAST(user_id AS VARCHAR) AS player_id,
         value AS speed,
         ((event_id * 7919) % 1160) / 10.0::DOUBLE - 58.0::DOUBLE AS x,
         ((event_id * 104729) % 760) / 10.0::DOUBLE - 38.0::DOUBLE AS y,
         CASE WHEN event_type = 'error' THEN 'Dead' ELSE 'Alive' END AS ball_status,
         ((epoch_us(ts) // 1000) % 43200000) / 1000.0::DOUBLE AS game_clock
  FROM events
)"""

BALL_ROWS = """
b AS (
  SELECT match_date AS match_id, wall_ms, frame_idx, period, game_clock, ball_status, x, y,
         0.0::DOUBLE AS z, speed AS ball_speed,
         CASE WHEN side = 'home' THEN 'A' ELSE 'B' END AS ball_team
  FROM t
)"""

# Ball rows as the feed carries them: positions in whole centimetres.
FEED_ROWS = """
b AS (
  SELECT match_date AS match_id,
         strftime(make_timestamp(wall_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS match_time,
         wall_ms, frame_idx, ball_status,
         CAST(round(x * 100) AS BIGINT) / 100.0::DOUBLE AS x,
         CAST(round(y * 100) AS BIGINT) / 100.0::DOUBLE AS y,
         0.0::DOUBLE AS z, speed AS ball_speed,
         CASE WHEN side = 'home' THEN 'A' ELSE 'B' END AS ball_team
  FROM t
)"""

FLAGS = f"""
f AS (
  SELECT *,
         (abs(x) < {_d(HALF_L)} AND abs(x) > {_d(INNER)} AND abs(y) < {_d(AREA_HALF_W)}) AS in_box,
         (abs(x) < {_d(HALF_L)} AND abs(y) < {_d(HALF_W)}) AS in_field
  FROM b
)"""

BALL = BALL_ROWS + "," + FLAGS

# Per-row directional speed inside (match, side, player, period).
SPEED_ROWS = """
sx AS (
  SELECT *, abs(x - px) / nullif(game_clock - pt, 0) AS speed_x
  FROM (
    SELECT *, lag(x) OVER w AS px, lag(game_clock) OVER w AS pt
    FROM t
    WINDOW w AS (PARTITION BY match_date, side, player_id, period ORDER BY game_clock, frame_idx)
  )
)"""

PERFORMANCE = """
perf AS (
  SELECT match_date, side, player_id,
         round(avg(speed), 6) AS player_avg_speed,
         max(speed) AS player_max_speed,
         max(speed_x) AS maximum_speed_x
  FROM sx
  GROUP BY match_date, side, player_id
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _ranked(partition: str, order: str, n: int) -> str:
    return (
        _with(TRACKING, SPEED_ROWS, PERFORMANCE)
        + f"""SELECT * FROM (
  SELECT perf.*, row_number() OVER (PARTITION BY {partition} ORDER BY {order}) AS rank FROM perf
) WHERE rank <= {n}"""
    )


def _box_stats(condition: str) -> str:
    return _with(TRACKING, BALL) + f"""SELECT match_id, true AS ball_inside_box,
       count(*) * {_d(FRAME_SECONDS)} / 60.0::DOUBLE AS minutes_inside_box,
       count(*) AS n_times_inside_box
FROM f WHERE {condition}
GROUP BY match_id"""


TS = "strftime(make_timestamp(wall_ms * 1000), '%Y-%m-%d %H:%M:%S.%g')"
POS = "printf('[%.2f, %.2f]', x, y)"

def _sql_text(template: str, **columns: str) -> str:
    """An event message template as SQL: literals and columns joined with ``||``."""
    parts = re.split(r"\{(\w+)\}", template)
    return " || ".join(columns[x] if i % 2 else f"'{x}'" for i, x in enumerate(parts) if x)


def events_sql(half_l: str, half_w: str) -> str:
    """The events of flagged rows ``f``; the half pitch sizes are SQL expressions."""
    return f"""
p AS (
  SELECT *, {TS} AS ts_text, {POS} AS pos_text,
         coalesce(lag(ball_status) OVER w, 'Alive') AS old_status,
         coalesce(lag(in_box) OVER w, false) AS old_box,
         coalesce(lag(in_field) OVER w, true) AS old_field
  FROM f
  WINDOW w AS (PARTITION BY match_id ORDER BY wall_ms, frame_idx)
),
ev AS (
  SELECT match_id, wall_ms, frame_idx, 1 AS seq, 'STATUS_CHANGED' AS kind,
         old_status AS old_value, ball_status AS new_value,
         NULL::VARCHAR AS restart, NULL::VARCHAR AS team, x, y,
         NULL::DOUBLE AS restart_x, NULL::DOUBLE AS restart_y,
         {_sql_text(ev.MSG_STATUS, ts='ts_text', old='old_status', new='ball_status')} AS message
  FROM p WHERE ball_status <> old_status
  UNION ALL
  SELECT match_id, wall_ms, frame_idx, 2,
         CASE WHEN in_box THEN 'BOX_ENTERED' ELSE 'BOX_LEFT' END,
         CAST(old_box AS VARCHAR), CAST(in_box AS VARCHAR),
         NULL, NULL, x, y, NULL, NULL,
         CASE WHEN in_box
              THEN {_sql_text(ev.MSG_BOX_ENTERED, ts='ts_text', pos='pos_text')}
              ELSE {_sql_text(ev.MSG_BOX_LEFT, ts='ts_text', pos='pos_text')}
         END
  FROM p WHERE in_box <> old_box
  UNION ALL
  SELECT match_id, wall_ms, frame_idx, 3,
         CASE WHEN in_field THEN 'FIELD_REENTERED' ELSE 'FIELD_LEFT' END,
         CAST(old_field AS VARCHAR), CAST(in_field AS VARCHAR),
         CASE WHEN NOT in_field THEN restart_kind END,
         CASE WHEN NOT in_field THEN restart_team END,
         x, y,
         CASE WHEN NOT in_field THEN (CASE WHEN abs(x) >= {half_l} THEN sign(x) * {half_l} ELSE x END) END,
         CASE WHEN NOT in_field THEN (CASE WHEN y >= 0 THEN {half_w} ELSE -{half_w} END) END,
         CASE WHEN in_field
              THEN {_sql_text(ev.MSG_FIELD_REENTERED, ts='ts_text', pos='pos_text')}
              ELSE {_sql_text(ev.MSG_FIELD_LEFT, ts='ts_text', restart='restart_kind', team='restart_team', pos='pos_text')}
         END
  FROM (
    SELECT *, CASE WHEN abs(x) >= {half_l} THEN 'corner' ELSE 'throw-in' END AS restart_kind,
              CASE WHEN ball_team = 'A' THEN 'home' ELSE 'away' END AS restart_team
    FROM p
  ) WHERE in_field <> old_field
)"""


EVENTS = events_sql(_d(HALF_L), _d(HALF_W))

STATE_COLS = "wall_ms, frame_idx, ball_status, x, y, ball_team, in_box, in_field"

ORACLE: dict[str, str] = {
    "player_speed_stats": _with(TRACKING) + """SELECT match_date, side, player_id,
       round(avg(speed), 6) AS player_avg_speed, max(speed) AS player_max_speed
FROM t GROUP BY match_date, side, player_id""",
    "max_speed_x": _with(TRACKING, SPEED_ROWS) + """SELECT match_date, side, player_id, max(speed_x) AS maximum_speed_x
FROM sx GROUP BY match_date, side, player_id""",
    # Input with gaps (x of every 11th row, clock of every 13th): all nulls count as 0.
    "max_speed_x_zero_fill": _with(TRACKING) + """SELECT side, player_id,
       max(abs(x0 - coalesce(px, 0.0::DOUBLE)) / nullif(t0 - coalesce(pt, 0.0::DOUBLE), 0)) AS maximum_speed_x
FROM (
  SELECT *, lag(x0) OVER w AS px, lag(t0) OVER w AS pt
  FROM (SELECT *, CASE WHEN frame_idx % 11 = 0 THEN 0.0::DOUBLE ELSE x END AS x0,
               CASE WHEN frame_idx % 13 = 0 THEN 0.0::DOUBLE ELSE game_clock END AS t0 FROM t)
  WINDOW w AS (PARTITION BY side, player_id ORDER BY period, t0, frame_idx)
)
GROUP BY side, player_id""",
    "frame_speed_x": _with(TRACKING, SPEED_ROWS) + """SELECT match_date, side, player_id, period, frame_idx, game_clock, speed_x
FROM sx WHERE pt IS NOT NULL""",
    "player_performance": _with(TRACKING, SPEED_ROWS, PERFORMANCE) + "SELECT * FROM perf",
    "player_performance_join": _with(TRACKING, SPEED_ROWS, PERFORMANCE) + "SELECT * FROM perf",
    "top_players": _ranked("side, match_date", "player_avg_speed DESC NULLS LAST, player_id", 5),
    "bottom_players": _ranked("side, match_date", "player_avg_speed ASC NULLS LAST, player_id", 5),
    "top_players_overall": _ranked("side", "player_avg_speed DESC NULLS LAST, player_id, match_date", 5),
    "side_report": _with(TRACKING, SPEED_ROWS, PERFORMANCE) + "SELECT * FROM perf WHERE side = 'home'",
    "sample_players": _ranked("side", "md5(player_id || '|' || match_date || '|' || '0')", 10),
    "ball_in_box_stats": _box_stats("in_box"),
    "ball_in_left_box_stats": _box_stats(
        f"x > -{_d(HALF_L)} AND x < -{_d(INNER)} AND y > -{_d(AREA_HALF_W)} AND y < {_d(AREA_HALF_W)}"
    ),
    "ball_in_field": _with(TRACKING, BALL) + "SELECT match_id, wall_ms, frame_idx, x, y, in_box, in_field FROM f",
    "latest_ball_state": _with(TRACKING, BALL) + f"""SELECT match_id, {STATE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY wall_ms DESC, frame_idx DESC) AS rn FROM f
) WHERE rn = 1""",
    "sampled_ball_state": _with(TRACKING, BALL) + f"""SELECT match_id, window_start_ms, {STATE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY match_id, window_start_ms ORDER BY wall_ms DESC, frame_idx DESC) AS rn
  FROM (SELECT *, wall_ms - (wall_ms % 3000) AS window_start_ms FROM f)
) WHERE rn = 1""",
    "match_calendar": _with(TRACKING) + """SELECT match_date, first_wall_ms, last_wall_ms,
       strftime(make_timestamp(first_wall_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS kickoff_time,
       strftime(make_timestamp(last_wall_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS final_time,
       n_frames
FROM (SELECT match_date, min(wall_ms) AS first_wall_ms, max(wall_ms) AS last_wall_ms, count(*) AS n_frames
      FROM t GROUP BY match_date)""",
    "live_events": _with(TRACKING, BALL, EVENTS) + "SELECT * FROM ev",
    "ball_out_restarts": _with(TRACKING, BALL, EVENTS)
    + """SELECT match_id, wall_ms, frame_idx, restart, team, x, y, restart_x, restart_y
FROM ev WHERE kind = 'FIELD_LEFT'""",
}


# -- nested frames: events grouped 16 consecutive ids per frame within a match half --
FRAMES = """
g AS (SELECT *, frame_idx // 16 AS frame_no FROM t),
fk AS (
  SELECT match_date, period, frame_no,
         min(game_clock) AS gameClock, min(wall_ms) AS wallClock,
         arg_min(ball_status, frame_idx) AS first_status,
         arg_min(side, frame_idx) AS first_side,
         arg_min(x, frame_idx) AS bx, arg_min(y, frame_idx) AS by_, arg_min(speed, frame_idx) AS bspeed,
         count(*) FILTER (WHERE side = 'home') AS n_home,
         count(*) FILTER (WHERE side = 'away') AS n_away
  FROM g GROUP BY match_date, period, frame_no
),
up AS (
  SELECT fk.match_date, fk.period, fk.frame_no AS frame_idx, fk.gameClock AS game_clock,
         fk.wallClock AS wall_ms, fk.first_status = 'Alive' AS live, fk.first_side AS last_touch,
         g.side, g.player_id, g.speed, g.x, g.y, 0.0::DOUBLE AS z, fk.n_home, fk.n_away
  FROM g JOIN fk ON g.match_date = fk.match_date AND g.period = fk.period AND g.frame_no = fk.frame_no
)"""

UP_COLS = "match_date, period, frame_idx, game_clock, wall_ms, live, last_touch, side, player_id, speed, x, y, z"

PITCH = """
m AS (
  SELECT match_date AS match_id,
         strftime(make_timestamp(min(wall_ms) * 1000), '%Y-%m-%d %H:%M:%S') AS kickoff_text,
         100.0::DOUBLE + (day(CAST(match_date AS DATE)) % 6) AS pitch_length,
         64.0::DOUBLE + (day(CAST(match_date AS DATE)) % 5) AS pitch_width
  FROM t GROUP BY match_date
)"""

# What the merged tables hold before the load: other values, a match and players it lacks.
STORED_BEFORE = """, old AS (
  SELECT * REPLACE (-1.0::DOUBLE AS player_avg_speed) FROM perf WHERE match_date <= '2024-01-15' AND side = 'home'),
stored AS (
  SELECT match_date, side, player_id, player_avg_speed, player_max_speed, maximum_speed_x FROM old
  UNION ALL
  SELECT '2023-12-31', side, player_id, player_avg_speed, player_max_speed, maximum_speed_x FROM old WHERE match_date = '2024-01-01'
  UNION ALL
  SELECT match_date, 'home', 'p-other', -2.0::DOUBLE, max(player_max_speed), 0.5::DOUBLE FROM old GROUP BY match_date)
"""

ORACLE.update({
    "scan_frames_json": _with(TRACKING, FRAMES) + """SELECT match_date, period, frame_no AS frame_idx,
       gameClock AS game_clock, wallClock AS wall_ms, first_status = 'Alive' AS live, first_side AS last_touch,
       n_home, n_away, bx AS ball_x, by_ AS ball_y, bspeed AS ball_speed
FROM fk""",
    "unified_players": _with(TRACKING, FRAMES) + f"SELECT {UP_COLS} FROM up",
    "unified_ball": _with(TRACKING, FRAMES) + f"""SELECT match_date AS match_id, wallClock AS wall_ms,
       frame_no AS frame_idx, period, gameClock AS game_clock, first_status = 'Alive' AS live,
       bx AS x, by_ AS y, 0.0::DOUBLE AS z, bspeed AS ball_speed,
       (abs(bx) < {_d(HALF_L)} AND abs(bx) > {_d(INNER)} AND abs(by_) < {_d(AREA_HALF_W)}) AS ball_inside_box
FROM fk""",
    "split_by_side": _with(TRACKING, FRAMES) + f"SELECT {UP_COLS} FROM up WHERE side = 'home'",
    "dedup_players": _with(TRACKING, FRAMES) + f"SELECT DISTINCT {UP_COLS} FROM up WHERE n_home > 0 AND n_away > 0",
    # Frames with faults by frame number (unknown period, no clock, short ball, nameless player)
    # and unreadable lines, which have no match.
    "frame_quality_report": _with(TRACKING, FRAMES) + """SELECT match_date AS match_id, count(*) AS n_frames,
       0::BIGINT AS n_corrupt, count(*) FILTER (WHERE frame_no % 60 = 0) AS n_missing_clock,
       count(*) FILTER (WHERE frame_no % 50 = 0) AS n_bad_period,
       count(*) FILTER (WHERE frame_no % 7 = 0) AS n_short_ball_xyz,
       count(*) FILTER (WHERE frame_no % 9 = 0 AND n_home > 0) AS n_bad_player,
       count(*) FILTER (WHERE n_home = 0) AS n_no_home,
       count(*) FILTER (WHERE n_away = 0) AS n_no_away
FROM fk GROUP BY match_date
UNION ALL
SELECT NULL, n, n, n, n, n, 0, n, n FROM (SELECT count(*) AS n FROM fk WHERE frame_no % 40 = 0) WHERE n > 0""",
    "ingest_accounting": _with(TRACKING, FRAMES) + """, q AS (
  SELECT match_date || '-' || m AS match_date, frame_no, CASE WHEN m = 'A' THEN period ELSE period + 2 END AS period,
         n_home, n_away, frame_no % 60 = 0 OR frame_no % 50 = 0 AS bad,
         CASE WHEN frame_no % 9 = 0 AND n_home > 0 THEN 1 ELSE 0 END AS nameless
  FROM fk, (VALUES ('A'), ('B')) AS v(m))
SELECT match_date, coalesce(sum(n_home + n_away - nameless) FILTER (WHERE NOT bad), 0)::BIGINT AS player_rows,
       count(*) FILTER (WHERE NOT bad AND frame_no % 7 <> 0) AS ball_rows,
       count(*) FILTER (WHERE bad) AS frame_rejects,
       coalesce(sum(nameless) FILTER (WHERE NOT bad), 0)::BIGINT AS player_rejects,
       count(*) FILTER (WHERE NOT bad AND frame_no % 7 = 0) AS ball_rejects,
       max(CASE WHEN NOT bad AND n_home + n_away > nameless THEN period END)::INTEGER AS last_period
FROM q GROUP BY match_date
UNION ALL
SELECT NULL, 0, 0, n, 0, 0, NULL FROM (SELECT count(DISTINCT frame_no) AS n FROM fk WHERE frame_no % 40 = 0) WHERE n > 0""",
    "scan_match_metadata": _with(TRACKING, PITCH) + "SELECT match_id, kickoff_text, pitch_length, pitch_width FROM m",
    "ball_in_box_by_pitch": _with(TRACKING, BALL, PITCH) + f"""SELECT b.match_id, m.pitch_length, true AS ball_inside_box,
       count(*) * {_d(FRAME_SECONDS)} / 60.0::DOUBLE AS minutes_inside_box,
       count(*) AS n_times_inside_box
FROM b JOIN m ON b.match_id = m.match_id
WHERE abs(x) < m.pitch_length / 2.0::DOUBLE
  AND abs(x) > m.pitch_length / 2.0::DOUBLE - {_d(PENALTY_AREA_LENGTH_M)}
  AND abs(y) < {_d(AREA_HALF_W)}
GROUP BY b.match_id, m.pitch_length""",
    "scan_table": _with(TRACKING) + """SELECT wall_ms, period, frame_idx, side, player_id, speed, x, y,
       ball_status, game_clock, match_date FROM t""",
    "write_partitioned": _with(TRACKING, SPEED_ROWS, PERFORMANCE) + """SELECT * REPLACE (
       CASE WHEN match_date > '2024-01-15' THEN -3.0::DOUBLE ELSE player_avg_speed END AS player_avg_speed) FROM perf""",
    "merge_insert_only": _with(TRACKING, SPEED_ROWS, PERFORMANCE) + STORED_BEFORE + """SELECT * FROM stored
UNION ALL SELECT * FROM perf WHERE (match_date, side, player_id) NOT IN (SELECT (match_date, side, player_id) FROM stored)""",
    "upsert_by_key": _with(TRACKING, SPEED_ROWS, PERFORMANCE) + STORED_BEFORE + """SELECT * FROM perf
UNION ALL SELECT * FROM stored WHERE (match_date, side, player_id) NOT IN (SELECT (match_date, side, player_id) FROM perf)""",
    "incremental_load": _with(TRACKING, SPEED_ROWS, PERFORMANCE) + STORED_BEFORE + """SELECT * FROM stored
UNION ALL SELECT * FROM perf WHERE match_date NOT IN (SELECT match_date FROM stored)""",
    "features_as_of": _with(TRACKING, SPEED_ROWS, PERFORMANCE) + """SELECT side, player_id, player_avg_speed,
       player_max_speed, maximum_speed_x, match_date
FROM (
  SELECT *, row_number() OVER (PARTITION BY side, player_id ORDER BY match_date DESC) AS rn
  FROM perf WHERE match_date <= '2024-01-20'
) WHERE rn = 1""",
})

# The same merges, stored in buckets.
ORACLE["merge_bucketed"] = ORACLE["merge_insert_only"]

ORACLE.update({
    "stream_ball_rows": _with(TRACKING, FEED_ROWS, FLAGS) + """SELECT match_id, match_time, wall_ms, frame_idx,
       x, y, z, ball_status, ball_speed, ball_team, in_box, in_field FROM f""",
    "stream_live_events": _with(TRACKING, FEED_ROWS, FLAGS, EVENTS) + "SELECT * FROM ev",
})

ORACLE["stream_sampled_ball_state"] = _with(TRACKING, FEED_ROWS, FLAGS) + f"""SELECT match_id, window_start_ms, {STATE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY match_id, window_start_ms ORDER BY wall_ms DESC, frame_idx DESC) AS rn
  FROM (SELECT *, wall_ms - (wall_ms % 3000) AS window_start_ms FROM f)
) WHERE rn = 1"""

ORACLE["stream_latest_ball_state"] = _with(TRACKING, FEED_ROWS, FLAGS) + f"""SELECT match_id, {STATE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY wall_ms DESC, frame_idx DESC) AS rn FROM f
) WHERE rn = 1"""

ORACLE["stream_live_events_ordered"] = _with(TRACKING, FEED_ROWS, FLAGS, EVENTS) + "SELECT * FROM ev"

# Each match's own pitch: the flags, the restart rule and spot use its half sizes.
PITCH_FLAGS = f"""
f AS (
  SELECT b.*, m.pitch_length / 2.0::DOUBLE AS half_l, m.pitch_width / 2.0::DOUBLE AS half_w,
         (abs(x) < m.pitch_length / 2.0::DOUBLE AND abs(x) > m.pitch_length / 2.0::DOUBLE - {_d(PENALTY_AREA_LENGTH_M)}
          AND abs(y) < {_d(AREA_HALF_W)}) AS in_box,
         (abs(x) < m.pitch_length / 2.0::DOUBLE AND abs(y) < m.pitch_width / 2.0::DOUBLE) AS in_field
  FROM b JOIN m ON b.match_id = m.match_id
)"""
ORACLE["live_events_by_pitch"] = _with(TRACKING, PITCH, BALL_ROWS, PITCH_FLAGS, events_sql("half_l", "half_w")) + "SELECT * FROM ev"
ORACLE["stream_live_events_by_pitch"] = (
    _with(TRACKING, PITCH, FEED_ROWS, PITCH_FLAGS, events_sql("half_l", "half_w")) + "SELECT * FROM ev"
)

# Six days of seven are described; the others have the default pitch.
LATE_PITCH = f"""
late AS (
  SELECT d.match_id, coalesce(m.pitch_length, {_d(PITCH_LENGTH_M)}) AS pitch_length, coalesce(m.pitch_width, {_d(PITCH_WIDTH_M)}) AS pitch_width
  FROM (SELECT DISTINCT match_id FROM b) d LEFT JOIN m ON d.match_id = m.match_id AND day(d.match_id::DATE) % 7 <> 0
)"""
ORACLE["stream_live_events_late_pitch"] = _with(
    TRACKING, PITCH, FEED_ROWS, LATE_PITCH, PITCH_FLAGS.replace("JOIN m ON", "JOIN late m ON"), events_sql("half_l", "half_w")) + "SELECT * FROM ev"

# What a poller sees: events between the newest rows of successive 3 s windows.
SAMPLED = """
s AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY match_id, wall_ms - (wall_ms % 3000) ORDER BY wall_ms DESC, frame_idx DESC) AS rn FROM f
  ) WHERE rn = 1)"""
SAMPLED_EVENTS = EVENTS.replace("FROM f\n", "FROM s\n", 1)
ORACLE["sampled_live_events"] = _with(TRACKING, BALL, SAMPLED, SAMPLED_EVENTS) + "SELECT * FROM ev"
ORACLE["stream_sampled_live_events"] = _with(TRACKING, FEED_ROWS, FLAGS, SAMPLED, SAMPLED_EVENTS) + "SELECT * FROM ev"

# Whole lines of the changed feed, and what its rules make differ from the contract.
ORACLE["schema_drift_report"] = _with(TRACKING, FRAMES) + """, w AS (SELECT * FROM fk WHERE frame_no % 13 <> 0)
SELECT * FROM (
  SELECT match_date AS match_id, '$.weather' AS path, 'unknown' AS problem, 'STRING' AS found, count(*) AS n FROM w WHERE frame_no % 5 = 0 GROUP BY match_date
  UNION ALL SELECT match_date, '$.gameClock', 'retyped', 'STRING', count(*) FROM w WHERE frame_no % 7 = 0 GROUP BY match_date
  UNION ALL SELECT match_date, '$.lastTouch', 'missing', NULL, count(*) FROM w WHERE frame_no % 3 = 0 GROUP BY match_date
  UNION ALL SELECT match_date, '$.homePlayers[].speed', 'missing', NULL, sum(n_home)::BIGINT FROM w WHERE frame_no % 4 = 0 GROUP BY match_date
  UNION ALL SELECT NULL, '$', 'unparsable', NULL, count(*) FROM fk WHERE frame_no % 13 = 0
) WHERE n > 0"""

ORACLE["features_after_late_rows"] = ORACLE["player_performance"]
ORACLE["features_point_in_time"] = _with(TRACKING, SPEED_ROWS, PERFORMANCE) + """SELECT t.frame_idx, t.side, t.player_id, t.match_date,
       p.match_date AS feature_date, p.player_avg_speed, p.player_max_speed, p.maximum_speed_x
FROM t ASOF LEFT JOIN perf p ON t.side = p.side AND t.player_id = p.player_id AND t.match_date > p.match_date"""

ORACLE["box_visits"] = _with(TRACKING, BALL) + """SELECT match_id, min(wall_ms) AS start_ms, max(wall_ms) AS end_ms,
       (max(wall_ms) - min(wall_ms)) / 1000.0::DOUBLE AS seconds, count(*) AS n_rows
FROM (
  SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY wall_ms, frame_idx)
            - row_number() OVER (PARTITION BY match_id, in_box ORDER BY wall_ms, frame_idx) AS island
  FROM f WHERE in_box IS NOT NULL
) WHERE in_box GROUP BY match_id, island"""

ORACLE["stream_ball_rows_once"] = ORACLE["stream_ball_rows"]
ORACLE["stream_live_events_after_history"] = ORACLE["stream_live_events"]
ORACLE["stream_live_events_by_slot"] = ORACLE["stream_live_events"]

ORACLE["dedup_frames"] = _with(TRACKING, FRAMES) + f"SELECT {UP_COLS} FROM up"
