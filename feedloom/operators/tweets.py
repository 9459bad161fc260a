"""From JSON statuses to tweets."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.series import status_time
from feedloom.operators.log import reject_columns
from feedloom.schemas import STATUS, TWEET_ROW

_BROKEN = "_broken"
_MADE = frozenset([*(name.lower() for name in TWEET_ROW.names), "reason", "_raw", _BROKEN])


def judge_statuses(raw: DataFrame) -> DataFrame:
    """Every status with the columns of a tweet, and in ``reason`` why it is none, if it is none.

    ``bad_json``: no JSON text. ``bad_field``: a field that is read has another type.
    ``no_text``: a notice, which is no status. ``bad_time``: no readable creation time.
    As with edits, generators keep the filters from parsing a text a second time. The log may have
    further columns, but none named like one that is added.
    """
    reject_columns(raw, _MADE)
    options = {"columnNameOfCorruptRecord": _BROKEN}
    schema = T.StructType([*STATUS.fields, T.StructField(_BROKEN, T.StringType())])
    status = F.inline(F.array(F.from_json("value", schema, options)))
    fields = F.struct(
        F.col("text"),
        F.col("user.screen_name").alias("user"),
        F.col("user.lang").alias("userLang"),
        status_time(F.col("created_at")).alias("createdDate"),
        F.coalesce("retweeted", F.lit(False)).alias("isRetweeted"),
        F.col(_BROKEN),
    )
    kept = [f"_raw.{c}" for c in raw.columns]
    parsed = raw.select(F.struct(*raw.columns).alias("_raw"), status)
    found = parsed.select(*kept, F.inline(F.array(fields)))
    no_json = F.col("value").isNull() | F.expr("try_parse_json(value)").isNull()
    reason = (
        F.when(F.col(_BROKEN).isNotNull() & ~no_json, "bad_field")
        .when(F.col(_BROKEN).isNotNull() | F.col("value").isNull(), "bad_json")
        .when(F.trim("value") == "", "bad_json")
        .when(F.col("text").isNull(), "no_text")
        .when(F.col("createdDate").isNull(), "bad_time")
    )
    return found.withColumn("reason", reason).drop(_BROKEN)


def parse_statuses(raw: DataFrame) -> DataFrame:
    """The tweets among the statuses, with the columns of the log but ``value``."""
    return judge_statuses(raw).where(F.col("reason").isNull()).drop("value", "reason")


def tweet_rows(raw: DataFrame) -> DataFrame:
    """The five columns of a tweet from a frame with one JSON text ``value`` per row."""
    return parse_statuses(raw).select(*TWEET_ROW.names)


def rejected_statuses(raw: DataFrame) -> DataFrame:
    """The rows of the log that are no tweets, with the reason."""
    rejected = judge_statuses(raw).where(F.col("reason").isNotNull())
    return rejected.select(*raw.columns, "reason")
