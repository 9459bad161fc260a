"""The queries that are checked against SQL, over the whole of the tables given.

They leave UTC as the time zone of the session, and views named after what they filled.

Times come out without time zone, in UTC, so that they compare with those of other engines.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.series import elapsed_seconds, value_at_second
from feedloom.operators.counts import received_count, received_total
from feedloom.operators.due import due_times, due_times_stepped
from feedloom.operators.edits import (
    edit_events,
    edit_flags,
    edit_rows,
    first_edits,
    flag_code,
    for_channel,
    parse_edits,
    rejected_edits,
)
from feedloom.operators.log import backlog, log_head, replay_range, with_ordinals
from feedloom.operators.tweets import parse_statuses, rejected_statuses, tweet_rows
from feedloom.plans.fixtures import (
    coloured,
    land_raw_edits,
    land_raw_statuses,
    raw_edits,
    raw_statuses,
)
from feedloom.schemas import EDIT_EVENT, EDIT_ROW, RAW_EDIT
from feedloom.session import new_folder
from feedloom.sources.edits import hand_over, read_edits_stream, read_raw_edits
from feedloom.sources.manifest import land_log, log_head_of
from feedloom.sources.tweets import read_tweets
from feedloom.streaming.folders import append_folders, read_folders, received_so_far
from feedloom.streaming.progress import wait_for_rows
from feedloom.streaming.sinks import (
    append_numbered,
    append_table,
    latest_snapshot,
    live_table,
    open_table,
    run_available,
    snapshots,
    written,
)

Query = Callable[[SparkSession, str], DataFrame]

DEMO_CHANNEL = "#fr.wikipedia"
CURVE_START_MS = 1704070800000  # 2024-01-01T01:00:00Z, later than the first events


def _utc(df: DataFrame, name: str = "timestamp") -> DataFrame:
    return df.withColumn(name, F.col(name).cast("timestamp_ntz"))


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(edit_rows(parse_edits(raw_edits(spark, sf_dir))))


def edits_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(edit_rows(parse_edits(for_channel(raw_edits(spark, sf_dir), DEMO_CHANNEL))))


def edit_events_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_events(parse_edits(raw_edits(spark, sf_dir)))


def edit_flag_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = flag_code(edit_flags(parse_edits(raw_edits(spark, sf_dir))))
    return flagged.select(
        "ordinal",
        "isMinor",
        "isNew",
        "isUnpatrolled",
        "isBotEdit",
        "isSpecial",
        "isTalk",
        "flag",
        "flag_mask",
    )


def edit_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_edits(raw_edits(spark, sf_dir))


def irc_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(edit_rows(parse_edits(coloured(raw_edits(spark, sf_dir)))))


def head_of_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = first_edits(raw_edits(spark, sf_dir))
    time = F.timestamp_millis("received_ms").alias("timestamp")
    return _utc(head.select("ordinal", time, *EDIT_ROW.names[1:]))


def head_of_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_head(raw_edits(spark, sf_dir))


def _head(raw: DataFrame) -> int:
    return log_head(raw).first()["head"]


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_edits(spark, sf_dir)
    head = _head(raw)
    return replay_range(raw, head // 4, head * 3 // 4)


def left_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_edits(spark, sf_dir)
    return backlog(raw, _head(raw) // 2)


def log_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ordinals(raw_edits(spark, sf_dir).drop("ordinal"))


def log_ordinals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "log-ordinals-stream")
    stream = raw_edits(spark, sf_dir, streaming=True).drop("ordinal")
    run_available(append_numbered(stream, f"{out}/log", f"{out}/checkpoint", every=None))
    return written(spark, f"{out}/log", RAW_EDIT)


def _fill_table(stream: DataFrame, name: str) -> DataFrame:
    """Streams into a table that SQL knows as ``name``."""
    spark = stream.sparkSession
    out = new_folder(spark, name)
    run_available(append_table(stream, name, f"{out}/checkpoint", f"{out}/table"))
    return open_table(spark, name, f"{out}/table", stream.schema)


def edits_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    _fill_table(edit_rows(parse_edits(raw_edits(spark, sf_dir, streaming=True))), "edits_all")
    return _utc(spark.sql("SELECT * FROM edits_all"))


def edits_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    _fill_table(edit_rows(parse_edits(raw_edits(spark, sf_dir, streaming=True))), "edits_counted")
    return spark.sql("SELECT count(*) AS n FROM edits_counted")


def edits_channel_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One channel of a log with a folder per channel, in small batches, into a table."""
    log = land_raw_edits(spark, sf_dir)
    stream = read_edits_stream(spark, log, DEMO_CHANNEL, max_files_per_trigger=4)
    _fill_table(stream, "edits_of_channel")
    return _utc(spark.sql("SELECT * FROM edits_of_channel"))


def edit_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "edit-events-stream")
    stream = edit_events(parse_edits(raw_edits(spark, sf_dir, streaming=True)))
    run_available(append_folders(stream, f"{out}/table", f"{out}/checkpoint", every=None))
    return read_folders(spark, f"{out}/table", EDIT_EVENT)


def edit_events_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file of the log in each batch; those in the middle hold nothing that is wanted."""
    out = new_folder(spark, "edit-events-gaps")
    raw = raw_edits(spark, sf_dir)
    head = _head(raw)
    log = land_log(raw, f"{out}/log", files=10)
    stream = read_raw_edits(spark, log, None, streaming=True, max_files_per_trigger=1)
    wanted = stream.where(
        (F.col("ordinal") <= head // 4) | (F.col("ordinal") > head * 3 // 4)
    )
    table = f"{out}/table"
    events = edit_events(parse_edits(wanted))
    run_available(append_folders(events, table, f"{out}/checkpoint", None, close_every=3))
    return read_folders(spark, table, EDIT_EVENT)


def received_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running count after a restart: the log has grown between the two runs."""
    out = new_folder(spark, "received-running")
    raw = raw_edits(spark, sf_dir)
    half = _head(raw) // 2
    for part in (raw.where(F.col("ordinal") <= half), raw.where(F.col("ordinal") > half)):
        part.write.mode("append").parquet(f"{out}/log")
        edits = parse_edits(read_raw_edits(spark, f"{out}/log", None, streaming=True))
        run_available(append_folders(edits, f"{out}/table", f"{out}/checkpoint", every=None))
    return received_so_far(spark, f"{out}/table").select("received")


def edits_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three looks at one table: before its stream, while it runs, and when more has come."""
    out = new_folder(spark, "edits-live")
    raw = raw_edits(spark, sf_dir)
    half = _head(raw) // 2
    live_table(spark, "edits_live", f"{out}/table", EDIT_ROW)

    def look(number: int) -> DataFrame:
        n = spark.sql("SELECT count(*) AS n FROM edits_live")
        return n.select(F.lit(number).alias("look"), "n")

    looks = [look(0)]
    raw.where(F.col("ordinal") <= half).write.parquet(f"{out}/log")
    stream = read_edits_stream(spark, f"{out}/log", None)
    query = append_table(stream, "edits_live", f"{out}/checkpoint", f"{out}/table", "0 seconds")
    try:
        if half > 0:
            wait_for_rows(spark, query, timeout_s=600)
        looks.append(look(1))
        raw.where(F.col("ordinal") > half).write.mode("append").parquet(f"{out}/log")
        query.processAllAvailable()
        looks.append(look(2))
    finally:
        query.stop()
    return looks[0].unionByName(looks[1]).unionByName(looks[2])


def edits_handed_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the log as a table, what comes after it as a stream."""
    log = land_log(raw_edits(spark, sf_dir))
    half = log_head_of(spark, log).first()["head"] // 2
    table, stream, _ = hand_over(spark, log, None, max_files_per_trigger=8, at=half)
    return _utc(table.unionByName(_fill_table(stream, "edits_after")))


def range_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = land_log(raw_edits(spark, sf_dir))
    head = log_head_of(spark, log).first()["head"]
    return read_raw_edits(spark, log, None, start=head // 4, end=head * 3 // 4)


def head_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_head_of(spark, land_log(raw_edits(spark, sf_dir)))


def channel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "received-count")
    stream = received_count(parse_edits(raw_edits(spark, sf_dir, streaming=True)))
    run_available(snapshots(stream, f"{out}/table", f"{out}/checkpoint", every=None))
    return latest_snapshot(spark, f"{out}/table")


def total_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return received_total(channel_counts(spark, sf_dir))


def rate_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = raw_edits(spark, sf_dir)
    second = elapsed_seconds(F.col("received_ms"), CURVE_START_MS)
    return log.select("ordinal", second.alias("second")).select(
        "ordinal",
        "second",
        value_at_second(F.col("second"), 1, 0).alias("steady"),
        value_at_second(F.col("second"), 10, 4).alias("short_ramp"),
        value_at_second(F.col("second"), 3, 9).alias("starved_ramp"),
        value_at_second(F.col("second"), 2_000_003, 1_500_000).alias("long_ramp"),
    )


def due(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = raw_edits(spark, sf_dir).select("ordinal")
    return _utc(due_times(log, 1, 500, CURVE_START_MS, rows_per_second=7, ramp_up="6500ms"), "due")


def due_stepped(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = raw_edits(spark, sf_dir).select("ordinal")
    return _utc(due_times_stepped(log, CURVE_START_MS), "due")


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(tweet_rows(raw_statuses(spark, sf_dir)), "createdDate")


def tweet_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_statuses(raw_statuses(spark, sf_dir)).select("ordinal", "reason")


def tweets_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = read_tweets(spark, land_raw_statuses(spark, sf_dir), streaming=True)
    return _utc(_fill_table(stream, "tweets_landed"), "createdDate")


def tweets_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_statuses(spark, sf_dir)
    head = _head(raw)
    return _utc(tweet_rows(replay_range(raw, head // 4, head * 3 // 4)), "createdDate")


def tweets_left_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_statuses(spark, sf_dir)
    left = parse_statuses(backlog(raw, _head(raw) // 2))
    return _utc(left.drop("received_ms"), "createdDate")


def tweets_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_head(raw_statuses(spark, sf_dir))


def tweets_received(spark: SparkSession, sf_dir: str) -> DataFrame:
    return received_count(tweet_rows(raw_statuses(spark, sf_dir)), by=["user", "userLang"])


QUERIES: dict[str, Query] = {
    "edits": edits,
    "edits_channel": edits_channel,
    "edit_events": edit_events_all,
    "edit_flags": edit_flag_codes,
    "edit_rejects": edit_rejects,
    "irc_format": irc_format,
    "edits_count": edits_count,
    "edits_head": head_of_edits,
    "log_head": head_of_log,
    "replay_range": replayed,
    "backlog": left_over,
    "log_ordinals": log_ordinals,
    "log_ordinals_stream": log_ordinals_stream,
    "edits_stream": edits_stream,
    "edits_channel_stream": edits_channel_stream,
    "edit_events_stream": edit_events_stream,
    "edit_events_gaps": edit_events_gaps,
    "edits_live": edits_live,
    "edits_handover": edits_handed_over,
    "log_range": range_of_files,
    "log_head_manifest": head_of_files,
    "received_running": received_running,
    "received_count": channel_counts,
    "received_total": total_count,
    "rate_curve": rate_curve,
    "due_times": due,
    "due_times_stepped": due_stepped,
    "tweets": tweets,
    "tweet_rejects": tweet_rejects,
    "tweets_stream": tweets_stream,
    "tweets_replay": tweets_replayed,
    "tweets_backlog": tweets_left_over,
    "tweets_head": tweets_head,
    "tweets_received": tweets_received,
}


def queries() -> dict[str, Query]:
    """All queries; each runs with UTC as the time zone of the session."""
    return {name: _in_utc(query) for name, query in QUERIES.items()}


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, str(sf_dir).rstrip("/"))

    run.__name__ = query.__name__
    return run
