"""Raw logs made from the tables at hand: edit lines from events, statuses from documents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import new_folder

# The SQL is the same for Spark and for the check, which fill in {ms} and {src}.
RAW_EDITS_SQL = """
SELECT event_id AS ordinal, {ms} AS received_ms,
 CASE WHEN event_id % 53 = 0 THEN NULL
  ELSE CASE event_id % 3 WHEN 0 THEN '#en.wikipedia' WHEN 1 THEN '#fr.wikipedia'
  ELSE '#de.wikipedia' END END AS channel,
 CASE WHEN event_id % 59 = 0 THEN NULL ELSE
 concat(CASE WHEN event_id % 11 = 0 THEN 'pre ' ELSE '' END, '[[',
  CASE event_id % 10 WHEN 0 THEN 'Talk:Page ' WHEN 1 THEN 'Special:Log/'
   WHEN 2 THEN 'User talk:' ELSE 'Page ' END,
  CAST(user_id AS STRING), ']] ',
  CASE WHEN event_id % 5 = 0 THEN 'N' ELSE '' END,
  CASE WHEN event_id % 2 = 0 THEN 'M' ELSE '' END,
  CASE WHEN event_id % 3 = 0 THEN 'B' ELSE '' END,
  CASE WHEN event_id % 7 = 0 THEN '!' ELSE '' END,
  ' https://en.example.org/w/index.php?diff=', CAST(event_id AS STRING),
  ' * user', CAST(user_id AS STRING), ' * (',
  CASE WHEN event_id % 101 = 0 THEN '+' WHEN event_id % 103 = 0 THEN ' 5'
   WHEN event_id % 107 = 0 THEN '+99999999999' WHEN event_id % 109 = 0 THEN '++7'
   WHEN value >= 50 THEN concat('+', CAST(CAST(floor(value) AS INT) - 50 AS STRING))
   ELSE CAST(CAST(floor(value) AS INT) - 50 AS STRING) END, ')',
  CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 17 = 0 THEN ' '
   WHEN event_id % 19 = 0 THEN ' see [[B]] * c * (+9) tail'
   WHEN event_id % 23 = 0 THEN concat(' l1', chr(10), 'l2')
   ELSE concat(' ', event_type, ' edit') END) END AS line
FROM {src}
"""
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SPARK_MS = "unix_micros(CAST(ts AS TIMESTAMP)) div 1000"
FIRST_STATUS_S = 1520726400
#: Every how manieth document makes a status that is no tweet, by reason; the first one counts.
ODD_STATUSES = {"bad_json": 37, "bad_field": 41, "no_text": 43, "bad_time": 47}


def raw_edits(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Edit lines from the events, as a table or as a stream."""
    if streaming:
        # a pattern may stand for a file or for a folder of files, a plain path for a folder only
        events = spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/[e]vents.parquet")
    else:
        events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return spark.sql(RAW_EDITS_SQL.format(ms=SPARK_MS, src="{events}"), events=events)


def coloured(raw: DataFrame) -> DataFrame:
    """The same lines with format codes around what divides their fields."""
    marked = F.regexp_replace("line", r"(\[\[|\]\]|\*)", "\x0314$1\x0f")
    return raw.withColumn("line", F.concat(F.lit("\x02"), marked, F.lit("\x03")))


def raw_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON status per document, with the weekday as a constant, which is not read.

    Some are no tweets: JSON that breaks off, notices, fields and times that cannot be read.
    """
    documents = spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")
    created = F.date_format(
        F.timestamp_seconds(F.col("doc_id") + FIRST_STATUS_S), "MMM dd HH:mm:ss Z yyyy"
    )
    odd = {n: F.col("doc_id") % n == 0 for n in ODD_STATUSES.values()}
    never = odd[ODD_STATUSES["bad_time"]]
    other_type = F.array(F.lit("yes"))
    user = F.struct(F.col("source").alias("screen_name"), "lang").alias("user")
    head = [
        F.when(never, "never").otherwise(F.concat(F.lit("Sun "), created)).alias("created_at"),
        "text",
        user,
    ]
    usual = F.to_json(F.struct(*head, (F.col("doc_id") % 5 == 0).alias("retweeted")))
    mistyped = F.to_json(F.struct(*head, other_type.alias("retweeted")))
    value = (
        F.when(odd[ODD_STATUSES["bad_json"]], F.expr("left({0}, length({0}) - 2)".format("usual")))
        .when(odd[ODD_STATUSES["bad_field"]], F.col("mistyped"))
        .when(odd[ODD_STATUSES["no_text"]], '{"delete":{"status":{"id":1}}}')
        .otherwise(F.col("usual"))
    )
    received = (F.col("doc_id") + FIRST_STATUS_S) * 1000
    statuses = documents.select("*", usual.alias("usual"), mistyped.alias("mistyped"))
    return statuses.select(
        F.col("doc_id").alias("ordinal"), received.alias("received_ms"), value.alias("value")
    )


def land_raw_edits(spark: SparkSession, sf_dir: str) -> str:
    """Writes the edit lines as a log with a folder per channel and returns its path."""
    path = new_folder(spark, "raw-edits")
    raw_edits(spark, sf_dir).write.partitionBy("channel").parquet(path)
    return path


def land_raw_statuses(spark: SparkSession, sf_dir: str) -> str:
    """Writes the statuses as a log and returns its path."""
    path = new_folder(spark, "raw-statuses")
    raw_statuses(spark, sf_dir).write.parquet(path)
    return path
