"""Edit and status feeds as Spark tables and streams."""

from feedloom.operators.counts import received_count, received_total
from feedloom.operators.due import due_times, due_times_stepped
from feedloom.operators.edits import (
    edit_events,
    edit_flags,
    edit_rows,
    edits_head,
    first_edits,
    flag_code,
    for_channel,
    judge_edits,
    parse_edits,
    rejected_edits,
)
from feedloom.operators.log import backlog, log_head, replay_range, with_ordinals
from feedloom.operators.tweets import judge_statuses, rejected_statuses, tweet_rows
from feedloom.session import clear_folders
from feedloom.sources.edits import (
    hand_over,
    read_edit_events,
    read_edits,
    read_edits_stream,
    read_raw_edits,
)
from feedloom.sources.manifest import land_log, log_head_of, write_manifest
from feedloom.sources.tweets import read_raw_statuses, read_tweets
from feedloom.streaming.folders import (
    append_folders,
    close_batches,
    read_folders,
    received_so_far,
)
from feedloom.streaming.progress import RunningCount, wait_for_rows
from feedloom.streaming.sinks import (
    append_numbered,
    append_table,
    for_each_batch,
    latest_snapshot,
    live_table,
    memory_table,
    open_table,
    run_available,
    snapshots,
    stop_all,
    to_console,
)

__all__ = [
    "RunningCount",
    "append_folders",
    "append_numbered",
    "append_table",
    "backlog",
    "clear_folders",
    "close_batches",
    "due_times",
    "due_times_stepped",
    "edit_events",
    "edit_flags",
    "edit_rows",
    "edits_head",
    "first_edits",
    "flag_code",
    "for_channel",
    "for_each_batch",
    "hand_over",
    "judge_edits",
    "judge_statuses",
    "land_log",
    "latest_snapshot",
    "live_table",
    "log_head",
    "log_head_of",
    "memory_table",
    "open_table",
    "parse_edits",
    "read_edit_events",
    "read_edits",
    "read_edits_stream",
    "read_folders",
    "read_raw_edits",
    "read_raw_statuses",
    "read_tweets",
    "received_count",
    "received_so_far",
    "received_total",
    "rejected_edits",
    "rejected_statuses",
    "replay_range",
    "run_available",
    "snapshots",
    "stop_all",
    "to_console",
    "tweet_rows",
    "wait_for_rows",
    "with_ordinals",
    "write_manifest",
]
