"""Live ball events: changes of status, penalty-area presence and field presence.

The reference polls the newest stored row every 3 s and compares it with three
driver variables, so it misses changes between polls. Here every row is compared
with the match's previous row (by wall clock, then frame), starting from the
initial state below, in one distributed plan: the previous values come from
:func:`touchline.operators.sequence.with_previous`, bucketed by wall-clock slots so
a long match is never a single task. A row may yield up to three events, in the order
status, area, field; a null flag yields none and leaves the state as it was.

The streaming form (:mod:`touchline.streaming.live`) applies the same rules with
per-match state and is checked equal to this one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.clock import display_time
from touchline.functions.geometry import (
    PITCH_LENGTH_M,
    PITCH_WIDTH_M,
    restart_kind,
    restart_spot,
    restart_team,
)
from touchline.operators.ball import SAMPLE_MS, ball_flags, sampled_ball_state
from touchline.operators.joins import join_lookup
from touchline.operators.sequence import SLOT_SECONDS, time_slot, with_previous

# The state before a match's first row.
INITIAL_STATUS = "Alive"
INITIAL_IN_BOX = False
INITIAL_IN_FIELD = True

# Event message texts ({ts}, {old}, {new}, {restart}, {team}, {pos}).
MSG_STATUS = "Timestamp: {ts}; Ball change status from {old} to {new}"
MSG_BOX_ENTERED = "Timestamp: {ts}; Action is coming! Ball is going to inside penalty box!; Position: {pos}"
MSG_BOX_LEFT = "Timestamp: {ts}; There is no more danger! Ball is going outside the penalty box!; Position: {pos}"
MSG_FIELD_REENTERED = "Timestamp: {ts}; Ball is back on the field!; Position: {pos}"
MSG_FIELD_LEFT = "Timestamp: {ts}; Ball is outside of the field!; {restart} for {team} team; Position: {pos}"

ORDER = ["wall_ms", "frame_idx"]
#: Per-match pitch size, carried to the restart rule where the rows have it.
PITCH_COLUMNS = ["pitch_length", "pitch_width"]


def _render(template: str, **parts: Column) -> Column:
    """``str.format``-style template → ``concat`` of literals and columns."""
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        if head:
            pieces.append(F.lit(head))
        pieces.append(parts[name])
    if rest:
        pieces.append(F.lit(rest))
    return F.concat(*pieces)


def position_text(x: Column, y: Column) -> Column:
    return F.format_string("[%.2f, %.2f]", x, y)


def _raw_event(seq: int, kind: Column, old: Column, new: Column) -> Column:
    return F.struct(
        F.lit(seq).alias("seq"),
        kind.alias("kind"),
        old.cast("string").alias("old_value"),
        new.cast("string").alias("new_value"),
    )


def events_from_previous(rows: DataFrame) -> DataFrame:
    """Rows carrying ``prev_ball_status``/``prev_in_box``/``prev_in_field`` →
    raw events (``seq``, ``kind``, ``old_value``, ``new_value``)."""
    status, in_box, in_fld = F.col("ball_status"), F.col("in_box"), F.col("in_field")
    old_status = F.coalesce(F.col("prev_ball_status"), F.lit(INITIAL_STATUS))
    old_box = F.coalesce(F.col("prev_in_box"), F.lit(INITIAL_IN_BOX))
    old_field = F.coalesce(F.col("prev_in_field"), F.lit(INITIAL_IN_FIELD))
    found = F.filter(
        F.array(
            F.when(status != old_status, _raw_event(1, F.lit("STATUS_CHANGED"), old_status, status)),
            F.when(in_box != old_box, _raw_event(
                2, F.when(in_box, F.lit("BOX_ENTERED")).otherwise(F.lit("BOX_LEFT")), old_box, in_box)),
            F.when(in_fld != old_field, _raw_event(
                3, F.when(in_fld, F.lit("FIELD_REENTERED")).otherwise(F.lit("FIELD_LEFT")), old_field, in_fld)),
        ),
        lambda e: e.isNotNull(),
    )
    pitch = [c for c in PITCH_COLUMNS if c in rows.columns]
    return rows.select("match_id", "wall_ms", "frame_idx", "x", "y", "ball_team", *pitch, F.inline(found))


def decorate_events(raw: DataFrame, length=PITCH_LENGTH_M, width=PITCH_WIDTH_M) -> DataFrame:
    """Raw events → restart kind, team and spot for a ball leaving the field,
    and the message text. Shared by the batch and the streaming path."""
    kind, x, y = F.col("kind"), F.col("x"), F.col("y")
    left = kind == F.lit("FIELD_LEFT")
    restart = restart_kind(x, length)
    team = restart_team(F.col("ball_team"))
    spot_x, spot_y = restart_spot(x, y, length, width)
    ts = display_time(F.col("wall_ms"))
    pos = position_text(x, y)
    old, new = F.col("old_value"), F.col("new_value")
    message = (
        F.when(kind == "STATUS_CHANGED", _render(MSG_STATUS, ts=ts, old=old, new=new))
        .when(kind == "BOX_ENTERED", _render(MSG_BOX_ENTERED, ts=ts, pos=pos))
        .when(kind == "BOX_LEFT", _render(MSG_BOX_LEFT, ts=ts, pos=pos))
        .when(kind == "FIELD_REENTERED", _render(MSG_FIELD_REENTERED, ts=ts, pos=pos))
        .when(left, _render(MSG_FIELD_LEFT, ts=ts, restart=restart, team=team, pos=pos))
    )
    return raw.select(
        "match_id", "wall_ms", "frame_idx", F.col("seq").cast("int").alias("seq"), "kind",
        "old_value", "new_value",
        F.when(left, restart).alias("restart"),
        F.when(left, team).alias("team"),
        "x", "y",
        F.when(left, spot_x).alias("restart_x"),
        F.when(left, spot_y).alias("restart_y"),
        message.alias("message"),
    )


def live_events(flagged: DataFrame, length=PITCH_LENGTH_M, width=PITCH_WIDTH_M,
                slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Flagged ball rows (see :func:`touchline.operators.ball.ball_flags`) → events.

    Rows are ordered by wall clock, the frame index breaking ties (it may restart or be
    null). Rows without a clock have no place in the order: :func:`unordered` returns them.
    """
    ordered = flagged.where(F.col("wall_ms").isNotNull())
    rows = with_previous(
        ordered, ["match_id"], ORDER, time_slot("wall_ms", slot_seconds * 1000.0),
        ["ball_status", "in_box", "in_field"], ignore_nulls=True,
    )
    return decorate_events(events_from_previous(rows), length, width)


def unordered(flagged: DataFrame) -> DataFrame:
    """The rows that :func:`live_events` cannot place: those without a wall clock."""
    return flagged.where(F.col("wall_ms").isNull())


def live_events_by_pitch(ball_df: DataFrame, metadata: DataFrame, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Live events with each match's own pitch size for the area, the field and the
    restart spot; matches without metadata have the default pitch."""
    sized = with_pitch(ball_df, metadata)
    length, width = F.col("pitch_length"), F.col("pitch_width")
    return live_events(ball_flags(sized, length, width), length, width, slot_seconds)


def with_pitch(ball_df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Ball rows (batch or stream) with ``pitch_length`` and ``pitch_width`` of their match."""
    joined = join_lookup(ball_df, metadata.select("match_id", *PITCH_COLUMNS), ["match_id"], how="left")
    return joined.fillna({"pitch_length": PITCH_LENGTH_M, "pitch_width": PITCH_WIDTH_M})


def sampled_live_events(flagged: DataFrame, every_ms: int = SAMPLE_MS, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Events as a poller sees them: changes between the newest rows of successive
    ``every_ms`` windows, not between all rows."""
    return live_events(sampled_ball_state(flagged, every_ms), slot_seconds=slot_seconds)


def ball_out_restarts(events: DataFrame) -> DataFrame:
    """Throw-ins and corners: the ball leaving the field, with the restart spot."""
    return events.where(F.col("kind") == "FIELD_LEFT").select(
        "match_id", "wall_ms", "frame_idx", "restart", "team", "x", "y", "restart_x", "restart_y"
    )
