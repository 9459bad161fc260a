"""Reading a log by ordinal, and giving ordinals to a log that has none."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import new_folder


def reject_columns(log: DataFrame, made: Iterable[str]) -> None:
    """An error if the log has a column that an operator is about to add."""
    taken = set(made) & {c.lower() for c in log.columns}
    if taken:
        raise ValueError(f"the log already has {', '.join(sorted(taken))}")


def replay_range(
    log: DataFrame, start: int | None = None, end: int | None = None, ordinal: str = "ordinal"
) -> DataFrame:
    """Rows after ``start`` up to and including ``end``; an end left out is open.

    Without bounds that is the whole log, with rows that have no ordinal too. Both bounds are
    literals, so they reach the scan and row groups outside are skipped.
    """
    if start is not None and end is not None and start > end:
        raise ValueError(f"start {start} is after end {end}")
    if start is not None:
        log = log.where(F.col(ordinal) > start)
    return log if end is None else log.where(F.col(ordinal) <= end)


def backlog(log: DataFrame, committed: int, ordinal: str = "ordinal") -> DataFrame:
    """What is still to be done after ``committed``."""
    return log.where(F.col(ordinal) > committed)


def log_head(log: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """One row ``head``: the largest ordinal, -1 for an empty log."""
    return log.agg(F.coalesce(F.max(ordinal), F.lit(-1).cast("bigint")).alias("head"))


def with_ordinals(
    raw: DataFrame,
    order_cols: Sequence[str] = ("received_ms", "channel", "line"),
    first: int = 0,
    partitions: int | None = None,
    work_path: str | None = None,
) -> DataFrame:
    """``raw`` with a gapless ``ordinal`` in the order of ``order_cols``, starting at ``first``.

    The rows are sorted with one range shuffle and written, each with its partition and its
    place in it, to ``work_path`` in place of what is there, or to a new part of the shared
    folder. How many rows the partitions before it hold is then all that is missing. The table
    of these counts has a row per partition of the shuffle, at most ``partitions`` or, if not
    given, ``spark.sql.shuffle.partitions``. So it is small whatever the size of the log; it is
    what is broadcast and what the un-partitioned window runs over.

    The place of a row in the input is the last range key. Thereby a time with very many rows,
    or a row with very many equal copies, is spread over partitions like any other part. The
    input should be a scan, with filters and projections at most: the place of a row is then
    the same in a task that has to be run again. Spark gathers a sample of the keys on the
    driver, of bounded number; for texts much longer than a chat line, lower
    ``spark.sql.execution.rangeExchange.sampleSizePerPartition``.
    """
    reject_columns(raw, {"ordinal", "_place", "_partition"})
    spark = raw.sparkSession
    path = work_path or new_folder(spark, "ordinals")
    keys = [*order_cols, "_place"]
    sorted_rows = (
        raw.withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(*([partitions] if partitions else []), *keys)
        .sortWithinPartitions(*order_cols)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    sorted_rows.write.mode("overwrite").parquet(path)
    placed = spark.read.schema(sorted_rows.schema).parquet(path)
    # monotonically_increasing_id: the partition above the lower 33 bits, the row in them
    partition = F.shiftright("_place", 33)
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(partition.alias("_partition")).agg(F.count("*").alias("_rows"))
    bases = counts.select(
        "_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base")
    )
    row = F.col("_place").bitwiseAND((1 << 33) - 1)
    ordinal = (F.col("_base") + row + F.lit(first).cast("bigint")).alias("ordinal")
    return (
        placed.withColumn("_partition", partition)
        .join(F.broadcast(bases), "_partition")
        .select(ordinal, *raw.columns)
    )
