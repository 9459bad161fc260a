"""Reading a log of JSON statuses, one per row."""

from pyspark.sql import DataFrame, SparkSession

from feedloom.operators.log import replay_range
from feedloom.operators.tweets import tweet_rows
from feedloom.schemas import RAW_STATUS
from feedloom.sources.manifest import within_files


def read_raw_statuses(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The raw statuses, with ordinals; a log of text lines has the JSON texts only."""
    if not streaming and max_files_per_trigger is not None:
        raise ValueError("max_files_per_trigger is for streams")
    reader = (spark.readStream if streaming else spark.read).format(fmt)
    if fmt != "text":
        reader = reader.schema(RAW_STATUS)
    if max_files_per_trigger is not None:
        if max_files_per_trigger < 1:
            raise ValueError(f"max_files_per_trigger must be positive: {max_files_per_trigger}")
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_tweets(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
    start: int | None = None,
    end: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Tweets of the log, as a table or as a stream, after ordinal ``start`` up to ``end``.

    A log of text lines has no ordinals, so it has no range.
    """
    ranged = start is not None or end is not None
    if ranged and fmt == "text":
        raise ValueError("a log of text lines has no ordinals: start and end cannot be given")
    raw = read_raw_statuses(spark, path, fmt, streaming, max_files_per_trigger)
    if ranged and not streaming:
        raw = within_files(raw, path, start, end)
    return tweet_rows(replay_range(raw, start, end))
