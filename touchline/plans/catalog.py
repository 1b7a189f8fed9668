"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables at ``sf_dir`` (through the tracking
adapter) or data Spark derives and writes from them, so its work grows with
the tables. The matching DuckDB SQL is in :mod:`touchline.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.clock import display_time, match_date
from touchline.operators import asof, ball, bucketed, drift, events, frames, ranking, speed, tables, visits
from touchline.plans import jobs
from touchline.session import checkpoint_base, configure, shared_dir
from touchline.sources import adapter, files
from touchline.streaming import ingest, late_metadata, live, marks, sampling, slots
from touchline.streaming import lines as lines_mod

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return adapter.tracking(spark, sf_dir)


def flagged_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball.ball_flags(adapter.ball_rows(tracking(spark, sf_dir)))


def _rank_bigint(df: DataFrame) -> DataFrame:
    return df.withColumn("rank", F.col("rank").cast("bigint"))


# -- speed features ---------------------------------------------------------------

@query("player_speed_stats")
def q_player_speed_stats(spark, sf_dir):
    return speed.player_speed_stats(tracking(spark, sf_dir))


@query("max_speed_x")
def q_max_speed_x(spark, sf_dir):
    return speed.max_speed_x(tracking(spark, sf_dir))


@query("max_speed_x_zero_fill")
def q_max_speed_x_zero_fill(spark, sf_dir):
    # Some rows lack a position or a clock: nulls count as 0, as in the reference.
    return speed.max_speed_x_zero_fill(adapter.with_gaps(tracking(spark, sf_dir)))


@query("frame_speed_x")
def q_frame_speed_x(spark, sf_dir):
    return speed.frame_speed_x(tracking(spark, sf_dir))


@query("player_performance")
def q_player_performance(spark, sf_dir):
    return speed.player_performance(tracking(spark, sf_dir))


@query("player_performance_join")
def q_player_performance_join(spark, sf_dir):
    return speed.player_performance_join(tracking(spark, sf_dir))


# -- leaderboards -----------------------------------------------------------------

# Leaderboards come ordered (side, match, rank), as the reference shows them;
# the sort runs over at most n rows per group.

@query("top_players")
def q_top_players(spark, sf_dir):
    board = ranking.top_players(q_player_performance(spark, sf_dir))
    return _rank_bigint(board).orderBy("side", "match_date", "rank")


@query("bottom_players")
def q_bottom_players(spark, sf_dir):
    board = ranking.bottom_players(q_player_performance(spark, sf_dir))
    return _rank_bigint(board).orderBy("side", "match_date", "rank")


@query("top_players_overall")
def q_top_players_overall(spark, sf_dir):
    return _rank_bigint(ranking.top_players_overall(q_player_performance(spark, sf_dir)))


@query("side_report")
def q_side_report(spark, sf_dir):
    return ranking.side_report(q_player_performance(spark, sf_dir), "home")


@query("sample_players")
def q_sample_players(spark, sf_dir):
    return _rank_bigint(ranking.sample_players(q_player_performance(spark, sf_dir)))


# -- ball -------------------------------------------------------------------------

@query("ball_in_box_stats")
def q_ball_in_box_stats(spark, sf_dir):
    return ball.ball_in_box_stats(adapter.ball_rows(tracking(spark, sf_dir)), ends="both")


@query("ball_in_left_box_stats")
def q_ball_in_left_box_stats(spark, sf_dir):
    return ball.ball_in_box_stats(adapter.ball_rows(tracking(spark, sf_dir)), ends="left")


@query("ball_in_field")
def q_ball_in_field(spark, sf_dir):
    return ball.ball_in_field(adapter.ball_rows(tracking(spark, sf_dir)))


@query("latest_ball_state")
def q_latest_ball_state(spark, sf_dir):
    return ball.latest_ball_state(flagged_ball(spark, sf_dir))


@query("sampled_ball_state")
def q_sampled_ball_state(spark, sf_dir):
    return ball.sampled_ball_state(flagged_ball(spark, sf_dir))


@query("match_calendar")
def q_match_calendar(spark, sf_dir):
    t = tracking(spark, sf_dir)
    return t.groupBy("match_date").agg(
        F.min("wall_ms").alias("first_wall_ms"),
        F.max("wall_ms").alias("last_wall_ms"),
        F.count(F.lit(1)).alias("n_frames"),
    ).select(
        "match_date", "first_wall_ms", "last_wall_ms",
        display_time(F.col("first_wall_ms")).alias("kickoff_time"),
        display_time(F.col("last_wall_ms")).alias("final_time"),
        "n_frames",
    )


# -- live events ------------------------------------------------------------------

@query("live_events")
def q_live_events(spark, sf_dir):
    return events.live_events(flagged_ball(spark, sf_dir))


@query("live_events_by_pitch")
def q_live_events_by_pitch(spark, sf_dir):
    """Events with each match's own pitch size, from the metadata elements."""
    meta = files.read_match_metadata(spark, metadata_from_events(spark, sf_dir))
    return events.live_events_by_pitch(adapter.ball_rows(tracking(spark, sf_dir)), meta)


@query("sampled_live_events")
def q_sampled_live_events(spark, sf_dir):
    return events.sampled_live_events(flagged_ball(spark, sf_dir))


@query("ball_out_restarts")
def q_ball_out_restarts(spark, sf_dir):
    return events.ball_out_restarts(q_live_events(spark, sf_dir))


# -- nested frames, metadata, stored tables ----------------------------------------
# These queries first write Spark-derived inputs (frames as JSON lines, metadata
# as XML, tables as Parquet) under the shared checkpoint folder, then read them
# back with explicit schemas, as a user's own files would be read.

def frames_from_events(spark: SparkSession, sf_dir: str) -> str:
    path = shared_dir(spark, "frames")
    files.write_frames(adapter.nested_frames(tracking(spark, sf_dir)), path)
    return path


def metadata_from_events(spark: SparkSession, sf_dir: str) -> str:
    path = shared_dir(spark, "metadata")
    files.write_match_metadata(adapter.match_metadata(tracking(spark, sf_dir)), path)
    return path


@query("scan_frames_json")
def q_scan_frames_json(spark, sf_dir):
    fr = files.read_frames(spark, frames_from_events(spark, sf_dir))
    return fr.select(
        match_date(F.col("wallClock")).alias("match_date"),
        "period",
        F.col("frameIdx").alias("frame_idx"),
        F.col("gameClock").alias("game_clock"),
        F.col("wallClock").alias("wall_ms"),
        "live",
        F.col("lastTouch").alias("last_touch"),
        F.size("homePlayers").cast("bigint").alias("n_home"),
        F.size("awayPlayers").cast("bigint").alias("n_away"),
        F.get(F.col("ball.xyz"), 0).alias("ball_x"),
        F.get(F.col("ball.xyz"), 1).alias("ball_y"),
        F.col("ball.speed").alias("ball_speed"),
    )


@query("unified_players")
def q_unified_players(spark, sf_dir):
    return frames.unified_players(files.read_frames(spark, frames_from_events(spark, sf_dir)))


@query("unified_ball")
def q_unified_ball(spark, sf_dir):
    return frames.unified_ball(files.read_frames(spark, frames_from_events(spark, sf_dir)))


@query("split_by_side")
def q_split_by_side(spark, sf_dir):
    return frames.split_by_side(q_unified_players(spark, sf_dir), "home")


@query("dedup_players")
def q_dedup_players(spark, sf_dir):
    return frames.dedup_players(files.read_frames(spark, frames_from_events(spark, sf_dir)))


def faulty_frames(spark: SparkSession, sf_dir: str, two_matches: bool) -> str:
    """Frames with faults as JSON lines, and unreadable lines beside them."""
    path = shared_dir(spark, "faulty_frames")
    nested = adapter.nested_frames(tracking(spark, sf_dir))
    if two_matches:
        nested = adapter.two_matches_a_day(nested)
    files.write_frames(adapter.with_faults(nested), path)
    adapter.broken_lines(nested).write.mode("append").text(path)
    return path


@query("frame_quality_report")
def q_frame_quality_report(spark, sf_dir):
    """Counts per rule over frames with faults; unreadable lines have no match."""
    fr = files.read_frames(spark, faulty_frames(spark, sf_dir, two_matches=False), keep_corrupt=True)
    return frames.frame_quality_report(fr)


@query("schema_drift_report")
def q_schema_drift_report(spark, sf_dir):
    """What differs from the contract in the frames of a feed that changed."""
    path = shared_dir(spark, "drifted_frames")
    adapter.drifted_lines(adapter.nested_frames(tracking(spark, sf_dir))).write.text(path)
    return drift.drift_report(spark.read.text(path))


@query("ingest_accounting")
def q_ingest_accounting(spark, sf_dir):
    """Two matches a day, extra time and bad rows through the ingest job, run twice: what
    went in is stored or rejected, per match and part (the re-run stores nothing again)."""
    path = faulty_frames(spark, sf_dir, two_matches=True)
    players, ball_rows = shared_dir(spark, "acc_players"), shared_dir(spark, "acc_ball")
    first, again = shared_dir(spark, "acc_rejects"), shared_dir(spark, "acc_rejects_again")
    jobs.ingest(spark, path, None, players, ball_rows, first)
    jobs.ingest(spark, path, None, players, ball_rows, again)
    one = lambda part: F.count(F.when(F.col("part") == part, 1)).alias(f"{part}_rejects")
    stored = files.read_table(spark, players).groupBy("match_date").agg(
        F.count("*").alias("player_rows"), F.max("period").cast("int").alias("last_period"))
    balls = files.read_table(spark, ball_rows).groupBy("match_date").agg(F.count("*").alias("ball_rows"))
    rejected = spark.read.schema("match_date string, part string").json(first).groupBy("match_date").agg(
        one("frame"), one("player"), one("ball"))
    out = rejected.join(stored, "match_date", "full").join(balls, "match_date", "full")
    return out.select("match_date", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in
                                      ("player_rows", "ball_rows", "frame_rejects", "player_rejects", "ball_rejects")], "last_period")


@query("scan_match_metadata")
def q_scan_match_metadata(spark, sf_dir):
    meta = files.read_match_metadata(spark, metadata_from_events(spark, sf_dir))
    return meta.select(
        "match_id",
        F.date_format("kickoff", "yyyy-MM-dd HH:mm:ss").alias("kickoff_text"),
        "pitch_length",
        "pitch_width",
    )


@query("ball_in_box_by_pitch")
def q_ball_in_box_by_pitch(spark, sf_dir):
    meta = files.read_match_metadata(spark, metadata_from_events(spark, sf_dir))
    return ball.ball_in_box_by_pitch(adapter.ball_rows(tracking(spark, sf_dir)), meta)


@query("scan_table")
def q_scan_table(spark, sf_dir):
    path = shared_dir(spark, "tracking")
    tables.write_partitioned(tracking(spark, sf_dir), path)
    return files.read_table(spark, path, schemas.TRACKING)


def _features_table(spark: SparkSession, path: str) -> DataFrame:
    return files.read_table(spark, path, schemas.PLAYER_FEATURES)


def _materialized(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Reliable checkpoint (shared checkpoint folder) of a small aggregated table
    that several writes below reuse, so it is computed once."""
    checkpoint_base(spark)
    return df.checkpoint(eager=True)


FIRST_HALF_END = "2024-01-15"
# A match that the source of the merges below does not have, and a player in the ones it has.
OTHER_MATCH, OTHER_PLAYER = "2023-12-31", "p-other"
FEATURE_KEYS = ["match_date", "side", "player_id"]


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _materialized(spark, speed.player_performance(tracking(spark, sf_dir)))


def _stored_before(feats: DataFrame) -> DataFrame:
    """What the tables hold before a load: the first half of the matches with other values
    (-1), the home side only; a match and players that the load does not have."""
    old = feats.where((F.col("match_date") <= FIRST_HALF_END) & (F.col("side") == "home")).withColumn("player_avg_speed", F.lit(-1.0))
    other_match = old.where("match_date = '2024-01-01'").withColumn("match_date", F.lit(OTHER_MATCH))
    other_player = old.groupBy("match_date").agg(F.lit("home").alias("side"), F.lit(OTHER_PLAYER).alias("player_id"),
                                                 F.lit(-2.0).alias("player_avg_speed"), F.max("player_max_speed").alias("player_max_speed"),
                                                 F.lit(0.5).alias("maximum_speed_x"))
    return old.unionByName(other_match).unionByName(other_player)


@query("write_partitioned")
def q_write_partitioned(spark, sf_dir):
    """A second overwrite with other values of the later matches replaces those partitions
    and leaves the others alone."""
    path = shared_dir(spark, "player_features")
    feats = _features(spark, sf_dir)
    tables.write_partitioned(feats, path)
    later = feats.where(F.col("match_date") > FIRST_HALF_END)
    tables.write_partitioned(later.withColumn("player_avg_speed", F.lit(-3.0)), path)
    return _features_table(spark, path)


@query("merge_insert_only")
def q_merge_insert_only(spark, sf_dir):
    """Merged twice into a table that holds some of the keys with other values: those stay,
    the rest is inserted once."""
    path = shared_dir(spark, "player_features")
    feats = _features(spark, sf_dir)
    tables.merge_insert_only(spark, _stored_before(feats), path, FEATURE_KEYS, schema=schemas.PLAYER_FEATURES)
    for _ in range(2):
        tables.merge_insert_only(spark, feats, path, FEATURE_KEYS, schema=schemas.PLAYER_FEATURES)
    return _features_table(spark, path)


@query("merge_bucketed")
def q_merge_bucketed(spark, sf_dir):
    """The merges of ``merge_insert_only`` into a bucketed table, whose rows stay in place."""
    path = shared_dir(spark, "player_features_bucketed")
    feats = _features(spark, sf_dir)
    for load in (_stored_before(feats), feats, feats):
        name = bucketed.merge_insert_only(spark, load, path, schemas.PLAYER_FEATURES, FEATURE_KEYS, buckets=8)
    return spark.table(name)


@query("upsert_by_key")
def q_upsert_by_key(spark, sf_dir):
    """Upserted into the same table: the load's keys get its values, keys and matches that
    it does not have stay."""
    path = shared_dir(spark, "player_features")
    feats = _features(spark, sf_dir)
    tables.upsert_by_key(spark, _stored_before(feats), path, FEATURE_KEYS, schema=schemas.PLAYER_FEATURES)
    tables.upsert_by_key(spark, feats, path, FEATURE_KEYS, schema=schemas.PLAYER_FEATURES)
    return _features_table(spark, path)


@query("incremental_load")
def q_incremental_load(spark, sf_dir):
    """The table holds some matches with other values; a load of all rows builds features
    only for the matches it lacks."""
    path = shared_dir(spark, "player_features")
    t = tracking(spark, sf_dir)
    tables.write_partitioned(_stored_before(_features(spark, sf_dir)), path)
    tables.incremental_load(spark, t, path, speed.player_performance, schema=schemas.PLAYER_FEATURES)
    return _features_table(spark, path)


AS_OF_CUTOFF = "2024-01-20"


@query("features_as_of")
def q_features_as_of(spark, sf_dir):
    path = shared_dir(spark, "player_features")
    tables.write_partitioned(speed.player_performance(tracking(spark, sf_dir)), path)
    return tables.features_as_of(_features_table(spark, path), AS_OF_CUTOFF)


@query("features_after_late_rows")
def q_features_after_late_rows(spark, sf_dir):
    """Some rows of every match come after its features are stored: the partials of their
    slots are worked out again and merged."""
    players, parts, feats = (shared_dir(spark, n) for n in ("late_players", "partials", "late_features"))
    rows = tracking(spark, sf_dir)
    late = F.pmod("frame_idx", F.lit(17)) == 0
    tables.write_partitioned(rows.where(~late), players)
    jobs.merge_late_features(spark, rows.where(~late), players, parts, feats)
    tables.write_partitioned(rows.where(late), players, mode="append")
    jobs.merge_late_features(spark, rows.where(late), players, parts, feats)
    return _features_table(spark, feats)


@query("features_point_in_time")
def q_features_point_in_time(spark, sf_dir):
    """Every tracking row asks for its player's features before its own match day."""
    path = shared_dir(spark, "player_features")
    rows = tracking(spark, sf_dir)
    tables.write_partitioned(speed.player_performance(rows), path)
    day = lambda c: F.unix_date(F.to_date(c))
    feats = _features_table(spark, path).withColumnRenamed("match_date", "feature_date")
    asked = rows.select("frame_idx", "side", "player_id", "match_date", day("match_date").alias("day"))
    out = asof.as_of_join(asked, feats.withColumn("feature_day", day("feature_date")), ["side", "player_id"], "day", "feature_day",
                          slot_width=7, inclusive=False, salts=4)
    return out.drop("day", "feature_day")


@query("box_visits")
def q_box_visits(spark, sf_dir):
    return visits.visits(flagged_ball(spark, sf_dir))


# -- streaming ----------------------------------------------------------------------
# The feed is written as text lines derived from the events table; the streams
# run with trigger(availableNow) and checkpoints under the shared folder, and the
# registered query reads what the sink committed.

def feed_from_events(spark: SparkSession, sf_dir: str, end_mark: bool = False) -> str:
    """The feed as text files; with ``end_mark`` a last line that ends it."""
    path = shared_dir(spark, "feed")
    lines = adapter.stream_lines(tracking(spark, sf_dir))
    lines.write.mode("overwrite").text(path)
    if end_mark:
        marks.end_mark_lines(spark.read.text(path)).write.mode("append").text(path)
    return path


def _finished(spark: SparkSession, out: DataFrame, name: str) -> DataFrame:
    """Run a stream over what its source has and read what the sink committed."""
    sink, ckpt = shared_dir(spark, name), shared_dir(spark, f"{name}_ckpt")
    q = (
        out.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", ckpt).option("path", sink)
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return files.read_table(spark, sink, out.schema)


def _feed_rows(spark: SparkSession, feed: str) -> DataFrame:
    return lines_mod.split_parsed(lines_mod.parse_ball_lines(ingest.read_lines(spark, "text", feed)))[0]


# Micro-batches of so many files, whatever the backlog.
FILES_PER_TRIGGER = 64

STREAM_COLUMNS = [
    "match_id", "match_time", "wall_ms", "frame_idx", "x", "y", "z",
    "ball_status", "ball_speed", "ball_team", "in_box", "in_field",
]


@query("stream_ball_rows")
def q_stream_ball_rows(spark, sf_dir):
    feed = feed_from_events(spark, sf_dir)
    sink, ckpt, quarantine = (shared_dir(spark, n) for n in ("ball_rows", "ball_rows_ckpt", "quarantine"))
    lines = ingest.read_lines(spark, "text", feed, FILES_PER_TRIGGER)
    schema = lines_mod.parse_ball_lines(lines).schema
    for q in ingest.start_ball_stream(lines, sink, ckpt, quarantine, available_now=True):
        q.awaitTermination()
    return files.read_table(spark, sink, schema).select(*STREAM_COLUMNS)


@query("stream_ball_rows_once")
def q_stream_ball_rows_once(spark, sf_dir):
    """Every part of the feed is delivered twice, in different micro-batches: each row is
    stored once."""
    sink, ckpt = shared_dir(spark, "ball_rows_once"), shared_dir(spark, "ball_rows_once_ckpt")
    lines = ingest.read_lines(spark, "text", growing_feed(spark, sf_dir, deliveries=2), FILES_PER_SLICE)
    schema = lines_mod.parse_ball_lines(lines).schema
    for q in ingest.start_ball_stream(lines, sink, ckpt, available_now=True, repeats_within="8 days"):
        q.awaitTermination()
    rows = files.read_table(spark, sink, schema).where(~marks.is_end_mark(F.col("ball_status")))
    return rows.select(*STREAM_COLUMNS)


@query("stream_live_events")
def q_stream_live_events(spark, sf_dir):
    feed = feed_from_events(spark, sf_dir)
    sink, ckpt = shared_dir(spark, "live_events"), shared_dir(spark, "live_events_ckpt")
    good, _ = lines_mod.split_parsed(lines_mod.parse_ball_lines(ingest.read_lines(spark, "text", feed)))
    out = live.live_event_stream(good)
    q = (
        out.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", ckpt).option("path", sink)
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return files.read_table(spark, sink, out.schema)


@query("stream_sampled_ball_state")
def q_stream_sampled_ball_state(spark, sf_dir):
    """Windows closed by the watermark; the feed's end mark closes the last ones."""
    rows = _feed_rows(spark, feed_from_events(spark, sf_dir, end_mark=True))
    return _finished(spark, sampling.sampled_state_stream(rows), "sampled")


# A feed that grows: so many slices of the clock, each of so many files, written in turn.
FEED_SLICES, FILES_PER_SLICE = 4, 4


def growing_feed(spark: SparkSession, sf_dir: str, slices: int = FEED_SLICES, deliveries: int = 1,
                 ahead_ms: int = marks.MARK_AHEAD_MS) -> str:
    """The feed as it grows: slices in clock order, so that a stream that takes the files
    of one slice at a time has several micro-batches; the end mark comes last. With more
    ``deliveries`` every slice is sent again in later files."""
    path = shared_dir(spark, "growing_feed")
    lines = adapter.stream_lines(tracking(spark, sf_dir))
    clock = F.split("value", ":")[0].try_cast("bigint")
    lo, hi = lines.agg(F.min(clock), F.max(clock)).first()
    for i in range(slices if lo is not None else 0):
        start, end = lo + (hi + 1 - lo) * i // slices, lo + (hi + 1 - lo) * (i + 1) // slices
        for _ in range(deliveries):
            lines.where((clock >= start) & (clock < end)).repartition(FILES_PER_SLICE).write.mode("append").text(path)
    marks.end_mark_lines(spark.read.text(path), ahead_ms).write.mode("append").text(path)
    return path


def _growing_rows(spark: SparkSession, feed: str) -> DataFrame:
    return lines_mod.split_parsed(lines_mod.parse_ball_lines(ingest.read_lines(spark, "text", feed, FILES_PER_SLICE)))[0]


@query("stream_sampled_live_events")
def q_stream_sampled_live_events(spark, sf_dir):
    """The poller's loop as one stream: window aggregate, then per-match state, over the
    micro-batches of a growing feed."""
    rows = _growing_rows(spark, growing_feed(spark, sf_dir))
    return _finished(spark, sampling.sampled_event_stream(rows), "sampled_events")


@query("stream_live_events_after_history")
def q_stream_live_events_after_history(spark, sf_dir):
    """The first half of every match from a batch table, the rest live: the events of both
    parts are those of the whole."""
    rows = tracking(spark, sf_dir)
    past = lines_mod.parse_ball_lines(adapter.stream_lines(rows.where(F.col("period") == 1)))
    feed = shared_dir(spark, "second_halves")
    adapter.stream_lines(rows.where(F.col("period") == 2)).write.text(feed)
    later = _finished(spark, live.live_event_stream(_feed_rows(spark, feed), history=past), "events_after_history")
    return events.live_events(past).unionByName(later)


@query("stream_live_events_by_slot")
def q_stream_live_events_by_slot(spark, sf_dir):
    """State by (match, hour), then by match: the events of a growing feed."""
    rows = _growing_rows(spark, growing_feed(spark, sf_dir))
    return _finished(spark, slots.slot_event_stream(rows, ORDERED_DELAY, width_ms=3_600_000), "events_by_slot")


@query("stream_live_events_by_pitch")
def q_stream_live_events_by_pitch(spark, sf_dir):
    """Live events with each match's pitch size, looked up in the stream."""
    meta = files.read_match_metadata(spark, metadata_from_events(spark, sf_dir))
    rows = _feed_rows(spark, feed_from_events(spark, sf_dir))
    return _finished(spark, live.live_event_stream(rows, metadata=meta), "live_events_pitch")


# Metadata as a stream: sent so long after a match's first row, for six days of seven, and
# waited for as long as the patience. The end marks lie beyond delay and patience.
KNOWN_AFTER_MS, LATE_DELAY, LATE_BEFORE, LATE_PATIENCE = 12 * 3_600_000, "8 days", "1 day", "1 day"
LATE_MARK_MS = 12 * 86_400_000
LATE_META_SCHEMA = "match_id string, pitch_length double, pitch_width double, known_ms long"


def growing_metadata(spark: SparkSession, sf_dir: str, slices: int = FEED_SLICES) -> str:
    """Metadata files in the order in which they are sent, and the mark that ends them."""
    path = shared_dir(spark, "growing_metadata")
    rows = tracking(spark, sf_dir)
    known = rows.groupBy("match_date").agg((F.min("wall_ms") + F.lit(KNOWN_AFTER_MS)).alias("known_ms"))
    sizes = adapter.match_metadata(rows).where(F.dayofmonth(F.to_date("match_date")) % 7 != 0)
    sent = sizes.join(known, "match_date").select(
        F.col("match_date").alias("match_id"), F.col("fPitchXSizeMeters").alias("pitch_length"), F.col("fPitchYSizeMeters").alias("pitch_width"), "known_ms")
    sent.limit(0).write.json(path)
    lo, hi = sent.agg(F.min("known_ms"), F.max("known_ms")).first()
    for i in range(slices if lo is not None else 0):
        start, end = lo + (hi + 1 - lo) * i // slices, lo + (hi + 1 - lo) * (i + 1) // slices
        sent.where((F.col("known_ms") >= start) & (F.col("known_ms") < end)).repartition(1).write.mode("append").json(path)
    last = rows.agg(F.max("wall_ms")).first()[0]
    if last is not None:
        mark = late_metadata.metadata_end_mark(last + LATE_MARK_MS)
        spark.createDataFrame([mark], LATE_META_SCHEMA).write.mode("append").json(path)
    return path


@query("stream_live_events_late_pitch")
def q_stream_live_events_late_pitch(spark, sf_dir):
    """Pitch sizes that come half a day after kick-off, or never, joined in the stream; the
    events of the sized rows it stored."""
    rows = _growing_rows(spark, growing_feed(spark, sf_dir, ahead_ms=LATE_MARK_MS)).drop("in_box", "in_field")
    meta = spark.readStream.schema(LATE_META_SCHEMA).option("maxFilesPerTrigger", 1).json(growing_metadata(spark, sf_dir))
    sized = _finished(spark, late_metadata.sized_rows(rows, meta, LATE_DELAY, LATE_BEFORE, LATE_PATIENCE), "late_sized")
    length, width = F.col("pitch_length"), F.col("pitch_width")
    return events.live_events(ball.ball_flags(sized, length, width), length, width)


@query("stream_latest_ball_state")
def q_stream_latest_ball_state(spark, sf_dir):
    """Batch read of the ingest stream's committed output (the reference's
    re-scan of the growing folder), then the newest row per match."""
    feed = feed_from_events(spark, sf_dir)
    sink, ckpt = shared_dir(spark, "ball_rows"), shared_dir(spark, "ball_rows_ckpt")
    lines = ingest.read_lines(spark, "text", feed, FILES_PER_TRIGGER)
    schema = lines_mod.parse_ball_lines(lines).schema
    for q in ingest.start_ball_stream(lines, sink, ckpt, available_now=True):
        q.awaitTermination()
    return ball.latest_ball_state(files.read_table(spark, sink, schema))


ORDERED_DELAY = "10 seconds"


@query("stream_live_events_ordered")
def q_stream_live_events_ordered(spark, sf_dir):
    """Event-time mode: rows are processed in clock order whatever the arrival order, once
    the watermark (newest clock - 10 s) has passed them; the end mark releases the tail."""
    rows = _feed_rows(spark, feed_from_events(spark, sf_dir, end_mark=True))
    return _finished(spark, live.live_event_stream(rows, delay=ORDERED_DELAY), "live_events_ordered")


@query("dedup_frames")
def q_dedup_frames(spark, sf_dir):
    """Frames delivered twice (the derived JSON written a second time, as a
    replayed feed would), de-duplicated once at frame level, then flattened."""
    path = shared_dir(spark, "frames_twice")
    nested = adapter.nested_frames(tracking(spark, sf_dir))
    files.write_frames(nested, path)
    nested.write.mode("append").json(path)
    return frames.unified_players(frames.dedup_frames(files.read_frames(spark, path)))
