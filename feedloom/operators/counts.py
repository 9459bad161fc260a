"""Counts of received events."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def received_count(events: DataFrame, by: Sequence[str] = ("channel",)) -> DataFrame:
    """Rows received per value of ``by``; with no column in it, of all rows.

    Spark counts within each task before it shuffles, so a channel with most of the rows
    sends no more than any other. A stream keeps one number per value as state.
    """
    return events.groupBy(*by).agg(F.count("*").alias("received"))


def received_total(counts: DataFrame) -> DataFrame:
    """Rows received in all, from ``received_count``."""
    return counts.agg(F.coalesce(F.sum("received"), F.lit(0).cast("bigint")).alias("received"))
