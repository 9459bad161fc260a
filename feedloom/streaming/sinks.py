"""Where streams go.

``every`` is the time from batch to batch; ``0 seconds`` starts the next one at once. With None
a query takes what is there, in as many batches as needed, and ends.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from feedloom.fixed_values import BATCH_INTERVAL
from feedloom.operators.log import with_ordinals
from feedloom.session import folder_exists
from feedloom.streaming.folders import close_batches
from feedloom.streaming.triggers import set_trigger as _trigger


def append_table(
    sdf: DataFrame, name: str, checkpoint: str, path: str, every: str | None = None
) -> StreamingQuery:
    """Appends the stream to a parquet table, each row exactly once, also over a restart.

    ``open_table`` makes it known to SQL as ``name``.
    """
    writer = _trigger(sdf.writeStream.outputMode("append").queryName(name), every)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.format("parquet").option("path", path).start()


def memory_table(sdf: DataFrame, name: str, every: str | None = None) -> StreamingQuery:
    """Appends the stream to a table ``name`` in the memory of the driver.

    Every row stays there, so this is for streams of some thousand rows in all.
    """
    writer = _trigger(sdf.writeStream.outputMode("append").queryName(name), every)
    return writer.format("memory").start()


def written(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What a stream has written so far; an empty frame if it has not written anything."""
    if not folder_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def open_table(spark: SparkSession, name: str, path: str, schema: StructType) -> DataFrame:
    """What ``append_table`` has written so far, as a view ``name``, which it replaces."""
    table = written(spark, path, schema)
    table.createOrReplaceTempView(name)
    return table


def live_table(spark: SparkSession, name: str, path: str, schema: StructType) -> None:
    """Makes what ``append_table`` writes to ``path`` known to SQL as ``name``, whatever is there.

    Each statement sees what has been written by then: the view keeps a text, which is read anew,
    with the list of the files, whenever it is used. It may be made before the stream starts; an
    empty file then says what the columns are, until the list that the stream keeps of its own
    files takes its place. It holds for the session, and for readers of any length of time.
    """
    if not folder_exists(spark, path):
        spark.createDataFrame([], schema).coalesce(1).write.parquet(path)
    quoted = path.replace("`", "``")
    columns = ", ".join(
        f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW `{name}` AS SELECT {columns} FROM parquet.`{quoted}`"
    )


def to_console(sdf: DataFrame, every: str | None = None, rows: int = 20) -> StreamingQuery:
    """Prints the first rows of each batch; no others reach the driver."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(rows)

    return _trigger(sdf.writeStream.foreachBatch(show), every).start()


def for_each_batch(
    sdf: DataFrame,
    fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = BATCH_INTERVAL,
) -> StreamingQuery:
    """Calls ``fn`` with each batch that has rows, and its number.

    A batch may come again after a restart, with the same number; ``fn`` should replace what
    it wrote for it. Whether there are rows is seen from the first one; nothing is kept for that,
    and a batch that has some is read again by ``fn``. To write batches, ``append_folders`` does
    with one reading.
    """

    def call(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            fn(batch, batch_id)

    writer = sdf.writeStream.foreachBatch(call).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def snapshots(
    sdf: DataFrame, path: str, checkpoint: str, every: str | None = BATCH_INTERVAL
) -> StreamingQuery:
    """Writes the whole result of a streaming aggregation after each batch.

    The last two results are kept, so that one can be read while the next is written.
    """

    def write(result: DataFrame, batch_id: int) -> None:
        numbered = result.withColumn("batch", F.lit(batch_id).cast("bigint"))
        numbered.write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")

    writer = sdf.writeStream.outputMode("complete").foreachBatch(write)
    return _trigger(writer.option("checkpointLocation", checkpoint), every).start()


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The result written last."""
    written = spark.read.parquet(path)
    last = written.agg(F.max("batch")).first()[0]
    return written.where(F.col("batch") == last).drop("batch", "slot")


def append_numbered(
    sdf: DataFrame,
    path: str,
    checkpoint: str,
    order_cols: Sequence[str] = ("received_ms", "channel", "line"),
    every: str | None = BATCH_INTERVAL,
    close_every: int | None = None,
    keep: int = 0,
) -> StreamingQuery:
    """Appends a stream of raw rows to a log and gives them ordinals without gaps.

    Ordinals follow the order of the batches, and within a batch that of ``order_cols``. The
    ordinal that comes after the last two batches is kept, so the next batch, or the last one
    if it comes again and replaces what it wrote, has to read one number only.

    With ``close_every`` so many batches are merged at a time, in the order of their ordinals, but
    not the last ``keep``; see ``folders``. ``read_raw_edits`` and ``read_folders`` then read the
    log; a stream from it sees the batches that are not merged, ``hand_over`` the rest.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = 0
        if batch_id > 0:
            first = spark.read.parquet(f"{path}/_next/{(batch_id - 1) % 2}").first()["next"]
        rows = with_ordinals(batch, order_cols, first, work_path=f"{path}/_sorted")
        own = f"{path}/batch={batch_id}"
        rows.write.mode("overwrite").parquet(own)
        last = spark.read.schema(rows.schema).parquet(own).agg(F.max("ordinal") + 1)
        following = F.coalesce("next", F.lit(first).cast("bigint"))
        after = last.toDF("next").select(following.alias("next"))
        after.write.mode("overwrite").parquet(f"{path}/_next/{batch_id % 2}")
        if close_every is not None:
            close_batches(spark, path, batch_id - keep, rows.schema, ["ordinal"], close_every)

    writer = sdf.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def run_available(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Waits until a query with ``every=None`` has taken what there is; stops it if it has not.

    An error in the query is raised here.
    """
    try:
        if timeout_s is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout_s):
            raise TimeoutError(f"query {query.name or query.id} ran for over {timeout_s} s")
    finally:
        query.stop()


def stop_all(spark: SparkSession) -> int:
    """Stops every active query of the session and tells how many there were."""
    active = spark.streams.active
    for query in active:
        query.stop()
    return len(active)
