"""Reading a log of raw edit lines, as a table or as a stream."""

from pyspark.sql import DataFrame, SparkSession

from feedloom.fixed_values import DEFAULT_CHANNEL
from feedloom.operators.edits import edit_events, edit_rows, for_channel, parse_edits
from feedloom.operators.log import log_head, replay_range
from feedloom.schemas import RAW_EDIT
from feedloom.sources.manifest import log_head_of, within_files
from feedloom.streaming.folders import has_closed, read_folders


def read_raw_edits(
    spark: SparkSession,
    path: str,
    channel: str | None = DEFAULT_CHANNEL,
    fmt: str = "parquet",
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """The raw lines of one channel, or of all when ``channel`` is None.

    The channel is chosen before anything else. In a log that is partitioned by channel the
    other folders are then not read at all. ``max_files_per_trigger`` bounds what one
    micro-batch of a stream takes in. ``start`` and ``end`` bound the ordinals as in
    ``replay_range``; a table then opens only the files that the manifest of the log names, if it
    has one. A log whose batches have been merged is read by its folders.
    """
    if not streaming and max_files_per_trigger is not None:
        raise ValueError("max_files_per_trigger is for streams")
    reader = (spark.readStream if streaming else spark.read).format(fmt).schema(RAW_EDIT)
    if max_files_per_trigger is not None:
        if max_files_per_trigger < 1:
            raise ValueError(f"max_files_per_trigger must be positive: {max_files_per_trigger}")
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if not streaming and has_closed(spark, path):
        loaded = read_folders(spark, path, RAW_EDIT)
    else:
        loaded = reader.load(path)
        loaded = loaded if streaming else within_files(loaded, path, start, end)
    raw = for_channel(loaded.select(*RAW_EDIT.names), channel)
    return replay_range(raw, start, end)


def read_edits(
    spark: SparkSession,
    path: str,
    channel: str | None = DEFAULT_CHANNEL,
    start: int | None = None,
    end: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Edit rows of the log, after ordinal ``start`` up to ``end`` where given."""
    raw = read_raw_edits(spark, path, channel, fmt, start=start, end=end)
    return edit_rows(parse_edits(raw))


def read_edits_stream(
    spark: SparkSession,
    path: str,
    channel: str | None = DEFAULT_CHANNEL,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    start: int | None = None,
) -> DataFrame:
    """Stream of edit rows from the files that are in the log and those yet to come.

    With ``start``, of those after that ordinal.
    """
    raw = read_raw_edits(spark, path, channel, fmt, True, max_files_per_trigger, start)
    return edit_rows(parse_edits(raw))


def hand_over(
    spark: SparkSession,
    path: str,
    channel: str | None = DEFAULT_CHANNEL,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    at: int | None = None,
) -> tuple[DataFrame, DataFrame, int]:
    """The log as a table up to an ordinal, as a stream after it, and that ordinal.

    It is ``at`` or, if not given, the head of the log now. What lands in the log later has larger
    ordinals, so that nothing is missed or read twice. Rows without an ordinal are in neither.
    A table of the first and a stream from the second go on to fill one sink.
    """
    if at is None:
        if has_closed(spark, path):
            at = log_head(read_folders(spark, path, RAW_EDIT)).first()["head"]
        else:
            at = log_head_of(spark, path, fmt=fmt).first()["head"]
    table = read_edits(spark, path, channel, end=at, fmt=fmt)
    stream = read_edits_stream(spark, path, channel, fmt, max_files_per_trigger, start=at)
    return table, stream, at


def read_edit_events(
    spark: SparkSession,
    path: str,
    channel: str | None = DEFAULT_CHANNEL,
    fmt: str = "parquet",
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Edit events, with all fourteen columns, as a table or as a stream."""
    raw = read_raw_edits(spark, path, channel, fmt, streaming, max_files_per_trigger)
    return edit_events(parse_edits(raw))
