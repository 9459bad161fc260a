"""Schemas of the logs that are read and of the rows that come out.

Fixed values: names, types and order must be exactly as they are for results to be right.
"""

from pyspark.sql import types as T

RAW_EDIT = T.StructType(
    [
        T.StructField("ordinal", T.LongType()),
        T.StructField("received_ms", T.LongType()),
        T.StructField("channel", T.StringType()),
        T.StructField("line", T.StringType()),
    ]
)

EDIT_ROW = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("channel", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("diffUrl", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("byteDiff", T.IntegerType()),
        T.StructField("summary", T.StringType()),
    ]
)

EDIT_EVENT = T.StructType(
    [
        T.StructField("timeStamp", T.LongType()),
        T.StructField("channel", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("diffUrl", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("byteDiff", T.IntegerType()),
        T.StructField("summary", T.StringType()),
        T.StructField("isMinor", T.BooleanType()),
        T.StructField("isNew", T.BooleanType()),
        T.StructField("isUnpatrolled", T.BooleanType()),
        T.StructField("isBotEdit", T.BooleanType()),
        T.StructField("isSpecial", T.BooleanType()),
        T.StructField("isTalk", T.BooleanType()),
        T.StructField("flag", T.IntegerType()),
    ]
)

REJECTED_EDIT = T.StructType(
    [
        T.StructField("ordinal", T.LongType()),
        T.StructField("channel", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)

RAW_STATUS = T.StructType(
    [
        T.StructField("ordinal", T.LongType()),
        T.StructField("received_ms", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)

# The part of a JSON status that is read.
STATUS = T.StructType(
    [
        T.StructField("created_at", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField(
            "user",
            T.StructType(
                [
                    T.StructField("screen_name", T.StringType()),
                    T.StructField("lang", T.StringType()),
                ]
            ),
        ),
        T.StructField("retweeted", T.BooleanType()),
    ]
)

TWEET_ROW = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("userLang", T.StringType()),
        T.StructField("createdDate", T.TimestampType()),
        T.StructField("isRetweeted", T.BooleanType()),
    ]
)
