"""Command-line jobs: the reference's four programs as Spark jobs.

    python -m touchline.plans.jobs ingest   --frames F --metadata M --players P --ball B
    python -m touchline.plans.jobs features --players P --ball B --player-features PF --ball-features BF
    python -m touchline.plans.jobs refresh  --matches M1,M2 --players P --ball B --player-features PF --ball-features BF
    python -m touchline.plans.jobs stream   --source text --path DIR --sink S --checkpoint C [--quarantine Q]
    python -m touchline.plans.jobs live     --source text --path DIR --sink S --checkpoint C [--delay "10 seconds"]

``ingest`` and ``features`` insert only matches (or keys) not yet stored, so a
re-run after a failure adds nothing twice. The stream jobs resume from their
checkpoints. Paths are cluster paths; nothing is collected to the driver.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.geometry import in_penalty_area
from touchline import schemas
from touchline.operators import ball, frames, partials, speed, tables
from touchline.operators.joins import join_lookup
from touchline.session import build_session, configure, shared_dir
from touchline.sources import files
from touchline.streaming import ingest as stream_ingest
from touchline.streaming import live
from touchline.streaming.lines import parse_ball_lines, split_parsed

PLAYER_ROW_KEYS = ["match_date", "period", "frame_idx", "side", "player_id"]
BALL_ROW_KEYS = ["match_date", "period", "frame_idx"]
FEATURE_KEYS = ["match_date", "side", "player_id"]


def ingest(spark: SparkSession, frames_path: str, metadata_path: str | None, players_path: str,
           ball_path: str, quarantine_path: str | None = None) -> dict[str, int]:
    """Frames (JSON lines) + match metadata (XML) → player and ball tables.

    Rows failing the quality rules go to ``quarantine_path`` (by default next to the
    player table), one row per rejected frame, player or ball, so nothing vanishes: the
    returned counts of rows read, stored or already stored, and rejected add up. Rows
    already stored (match, period, frame, player) are skipped, so late files and further
    matches of a day are added. The ball's penalty-area flag uses each match's pitch
    length from the metadata (the default pitch where a match has none).
    """
    configure(spark)
    raw = files.read_frames(spark, frames_path, keep_corrupt=True)
    # Parse the JSON once: the distinct flagged frames are staged as Parquet in the shared
    # checkpoint folder (cuts the lineage; columnar re-reads), then split.
    staged = shared_dir(spark, "ingest-frames")
    frames.quality_flags(frames.dedup_frames(raw)).write.parquet(staged)
    flagged = spark.read.parquet(staged)
    players, ball_rows, rejects = frames.quality_rows(flagged)
    rejects.write.mode("append").json(quarantine_path or players_path.rstrip("/") + "_rejects")
    if metadata_path:
        meta = files.read_match_metadata(spark, metadata_path).select("match_id", "pitch_length")
        ball_rows = join_lookup(ball_rows, meta, ["match_id"], how="left").withColumn(
            "ball_inside_box",
            F.coalesce(
                in_penalty_area(F.col("x"), F.col("y"), F.col("pitch_length")),
                F.col("ball_inside_box"),
            ),
        ).drop("pitch_length")
    # A frame may list a player twice; both entries are stored, so that counts add up.
    tables.merge_insert_only(spark, players, players_path, PLAYER_ROW_KEYS, repeated_keys=True)
    tables.merge_insert_only(spark, ball_rows.withColumnRenamed("match_id", "match_date"), ball_path, BALL_ROW_KEYS, repeated_keys=True)
    per_part = {r["part"]: r["n"] for r in rejects.groupBy("part").agg(F.count("*").alias("n")).collect()}
    sizes = flagged.agg(
        F.count("*").alias("frames"),
        F.sum(F.coalesce(F.size("homePlayers"), F.lit(0)) + F.coalesce(F.size("awayPlayers"), F.lit(0))).alias("players")).first()
    counts = {"frames_read": sizes["frames"], "player_entries_read": sizes["players"] or 0,
              "player_rows": players.count(), "ball_rows": ball_rows.count(),
              **{f"{part}_rejects": per_part.get(part, 0) for part in ("frame", "player", "ball")}}
    drop_staged(spark, staged)  # both tables are written: the copy of the input goes
    return counts


def features(spark: SparkSession, players_path: str, ball_path: str, player_features_path: str,
             ball_features_path: str) -> None:
    """Player and ball feature tables from the stored player and ball tables.

    Matches whose features are stored are skipped before any work is done on them
    (:func:`touchline.operators.tables.incremental_load`). A match whose rows came in
    several files is rebuilt by :func:`refresh_features` once all are in."""
    configure(spark)
    players = files.read_table(spark, players_path)
    tables.incremental_load(spark, players, player_features_path, speed.player_performance)
    ball_rows = files.read_table(spark, ball_path)
    tables.incremental_load(spark, ball_rows, ball_features_path, _box_features)


def refresh_features(spark: SparkSession, matches: list[str], players_path: str, ball_path: str,
                     player_features_path: str, ball_features_path: str) -> None:
    """Rebuild and replace the features of the named matches (late or corrected input)."""
    configure(spark)
    wanted = F.col("match_date").isin(matches)
    tables.write_partitioned(speed.player_performance(files.read_table(spark, players_path).where(wanted)), player_features_path)
    tables.write_partitioned(_box_features(files.read_table(spark, ball_path).where(wanted)), ball_features_path)


def merge_late_features(spark: SparkSession, late: DataFrame, players_path: str, partials_path: str,
                        player_features_path: str) -> None:
    """Bring partials and features up to date after the rows ``late`` were stored in the
    player table: the slots that they fall in are worked out again, the features of their
    players are merged from the partials. Also builds both tables, where they do not exist,
    from the matches of ``late``. A re-run changes nothing."""
    configure(spark)
    if not files.path_exists(spark, partials_path):
        known = files.read_table(spark, players_path).join(late.select("match_date").distinct(), ["match_date"], "left_semi")
        tables.write_partitioned(partials.slot_partials(known), partials_path)
        changed = late.select(*FEATURE_KEYS).distinct()
    else:
        slots = partials.touched_slots(late)
        stored = files.read_table(spark, players_path)
        rows = tables.null_safe_join(partials.with_slot(tables.touched_partitions(stored, late)), slots, partials.SLOT_KEYS, "left_semi")
        tables.upsert_by_key(spark, partials.slot_partials(rows.drop("slot")), partials_path, partials.SLOT_KEYS, schema=partials.SCHEMA)
        changed = slots.select(*FEATURE_KEYS).distinct()
    held = tables.touched_partitions(files.read_table(spark, partials_path, partials.SCHEMA), late)
    merged = partials.features(tables.null_safe_join(held, changed, FEATURE_KEYS, "left_semi"))
    tables.upsert_by_key(spark, merged, player_features_path, FEATURE_KEYS, schema=schemas.PLAYER_FEATURES)


def _box_features(ball_rows: DataFrame) -> DataFrame:
    return ball.box_minutes(ball_rows.where(F.col("ball_inside_box")), ["match_date"])


def drop_staged(spark: SparkSession, path: str) -> None:
    """Remove a staged copy that :func:`touchline.session.shared_dir` named."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def _lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    opts = {k: v for k, v in (("host", args.host), ("port", args.port)) if v}
    return stream_ingest.read_lines(spark, args.source, args.path, args.max_files_per_trigger, **opts)


def _match_id(args: argparse.Namespace):
    """The column that names the match, so that two feeds of a day are two matches."""
    if args.match_id_from_file:
        found = F.regexp_extract(F.input_file_name(), args.match_id_from_file, 1)
        return F.when(found != "", found)
    return F.lit(args.match_id) if args.match_id else None


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="touchline")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--frames", required=True)
    a.add_argument("--metadata")
    a.add_argument("--players", required=True)
    a.add_argument("--ball", required=True)
    a.add_argument("--quarantine")
    for name in ("features", "refresh"):
        f = sub.add_parser(name)
        f.add_argument("--players", required=True)
        f.add_argument("--ball", required=True)
        f.add_argument("--player-features", required=True)
        f.add_argument("--ball-features", required=True)
    f.add_argument("--matches", required=True, help="ids of the matches to rebuild, with commas between them")
    for name in ("stream", "live"):
        s = sub.add_parser(name)
        s.add_argument("--source", default="text", help="text, socket or kafka")
        s.add_argument("--path")
        s.add_argument("--host")
        s.add_argument("--port")
        # A backlog is read in micro-batches of so many files.
        s.add_argument("--max-files-per-trigger", type=int, default=64)
        s.add_argument("--sink", required=True)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--match-id", help="the feed's match; without it the clock's UTC day")
        s.add_argument("--match-id-from-file", help="regular expression whose first group names the match in the input file's path")
        s.add_argument("--available-now", action="store_true")
        if name == "stream":
            s.add_argument("--quarantine")
            s.add_argument("--repeats-within", help='store lines that are sent again once, e.g. "10 minutes"')
        else:
            s.add_argument("--delay")
            s.add_argument("--metadata", help="match metadata (XML): each match's own pitch size")
            s.add_argument("--late", help="folder for rows that came too late (arrival mode)")
    args = p.parse_args(argv)
    spark = build_session(app_name=f"touchline-{args.job}")

    if args.job == "ingest":
        print(ingest(spark, args.frames, args.metadata, args.players, args.ball, args.quarantine))
    elif args.job == "features":
        features(spark, args.players, args.ball, args.player_features, args.ball_features)
    elif args.job == "refresh":
        refresh_features(spark, args.matches.split(","), args.players, args.ball, args.player_features, args.ball_features)
    elif args.job == "stream":
        # Unusable lines are always kept: without a folder of their own, next to the sink.
        quarantine = args.quarantine or args.sink.rstrip("/") + "_rejects"
        for q in stream_ingest.start_ball_stream(_lines(spark, args), args.sink, args.checkpoint, quarantine,
                                                 available_now=args.available_now, match_id=_match_id(args),
                                                 repeats_within=args.repeats_within):
            q.awaitTermination()
    else:
        good, _ = split_parsed(parse_ball_lines(_lines(spark, args), match_id=_match_id(args)))
        meta = files.read_match_metadata(spark, args.metadata) if args.metadata else None
        out = live.live_event_stream(good, delay=args.delay, metadata=meta, late_rows=bool(args.late))
        writer = out.writeStream.outputMode("append").option("checkpointLocation", args.checkpoint)
        if args.late:
            writer = writer.foreachBatch(_late_writer(args.sink, args.late))
        else:
            writer = writer.format("parquet").option("path", args.sink)
        if args.available_now:
            writer = writer.trigger(availableNow=True)
        writer.start().awaitTermination()


def _late_writer(sink: str, late: str):
    """``foreachBatch`` body: events and late rows of a micro-batch to folders of their own
    (``batch_id=<n>``, overwritten when a batch is replayed)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        is_late = F.col("kind") == live.LATE_ROW
        rows.where(~is_late).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        rows.where(is_late).write.mode("overwrite").parquet(f"{late}/batch_id={batch_id}")
        rows.unpersist()

    return write


if __name__ == "__main__":
    main()
