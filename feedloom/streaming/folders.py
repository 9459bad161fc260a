"""A table that grows by a folder for each batch, and is rewritten into fewer, larger folders.

A batch that comes again after a restart replaces its folder, ``batch=<number>``. Batches before
the one that is being written are closed and never come again; they are merged into folders
``_closed/<first>-<last>``, which count once they are marked as done. From then on the folders
merged into them do not count any more; they are removed when the next batch is written, so that
those who had begun to read them are not disturbed at once. Whenever the writer stops, each row is
in one folder that counts.
"""

import json
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from feedloom.fixed_values import BATCH_INTERVAL
from feedloom.session import (
    bytes_in,
    folder_exists,
    folders_in,
    mark_done,
    read_text,
    remove_folder,
    write_text,
)
from feedloom.streaming.triggers import set_trigger

CLOSED = "_closed"
RECEIVED = "_received"
#: Closed batches are merged when there are so many of them.
CLOSE_EVERY = 8
FILE_BYTES = 128 << 20
_BATCH = "batch="
_COUNTS = "batch bigint, rows bigint, received bigint"


def _spans(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """First and last batch of the merged folders that count, in order."""
    names = folders_in(spark, f"{path}/{CLOSED}", done=True)
    spans = [tuple(map(int, name.split("-"))) for name in names]
    return sorted(
        s for s in spans if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in spans)
    )


def _batches(spark: SparkSession, path: str, spans: list[tuple[int, int]]) -> list[int]:
    """The batches whose own folder counts, in order."""
    names = folders_in(spark, path)
    numbers = sorted(int(n.removeprefix(_BATCH)) for n in names if n.startswith(_BATCH))
    return [n for n in numbers if not any(a <= n <= b for a, b in spans)]


def live_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that hold each row of the table once, the oldest first."""
    spans = _spans(spark, path)
    closed = [f"{path}/{CLOSED}/{a}-{b}" for a, b in spans]
    return closed + [f"{path}/{_BATCH}{n}" for n in _batches(spark, path, spans)]


def read_folders(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The table as it is now; an empty frame if nothing has been written."""
    folders = live_folders(spark, path)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def has_closed(spark: SparkSession, path: str) -> bool:
    """Whether batches of the table have been merged, so that it must be read by its folders."""
    return folder_exists(spark, f"{path}/{CLOSED}")


def _remove_left_over(spark: SparkSession, path: str) -> None:
    """Removes what has been merged, and what was being merged when the writer stopped."""
    spans = _spans(spark, path)
    live = set(live_folders(spark, path))
    for name in folders_in(spark, f"{path}/{CLOSED}"):
        if f"{path}/{CLOSED}/{name}" not in live:
            remove_folder(spark, f"{path}/{CLOSED}/{name}")
    for name in folders_in(spark, path):
        if name.startswith(_BATCH) and any(
            a <= int(name.removeprefix(_BATCH)) <= b for a, b in spans
        ):
            remove_folder(spark, f"{path}/{name}")


def close_batches(
    spark: SparkSession,
    path: str,
    before: int,
    schema: StructType | str,
    order_cols: Sequence[str] = (),
    least: int = CLOSE_EVERY,
    file_bytes: int = FILE_BYTES,
) -> bool:
    """Merges the batches below ``before``, if there are ``least`` of them; tells whether it did.

    Merged folders of no more batches than that are merged with them, so their number grows with
    the logarithm of that of the batches, and a row is rewritten as many times. Files get about
    ``file_bytes`` and, if ``order_cols`` are given, a range of these each.
    """
    _remove_left_over(spark, path)
    spans = _spans(spark, path)
    batches = [n for n in _batches(spark, path, spans) if n < before]
    if len(batches) < least:
        return False
    folders = [f"{path}/{_BATCH}{n}" for n in batches]
    first, last = batches[0], batches[-1]
    while spans and spans[-1][1] - spans[-1][0] <= last - first:
        a, b = spans.pop()
        folders.insert(0, f"{path}/{CLOSED}/{a}-{b}")
        first = a
    files = max(1, math.ceil(sum(bytes_in(spark, f) for f in folders) / file_bytes))
    rows = spark.read.schema(schema).parquet(*folders)
    if order_cols:
        rows = rows.repartitionByRange(files, *order_cols).sortWithinPartitions(*order_cols)
    else:
        rows = rows.coalesce(files)
    merged = f"{path}/{CLOSED}/{first}-{last}"
    rows.write.mode("overwrite").parquet(merged)
    mark_done(spark, merged)
    return True


def append_folders(
    sdf: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = BATCH_INTERVAL,
    close_every: int | None = CLOSE_EVERY,
    keep: int = 0,
) -> StreamingQuery:
    """Appends the stream to a table of folders, each row once, also over a restart.

    The rows of a batch are counted as they are written, and the sum of all so far is kept, see
    ``received_so_far``. A batch without rows leaves no folder. Every ``close_every`` batches are
    merged, never with None; the last ``keep`` batches are left as they are for those who stream
    from this table. ``read_folders`` reads it.
    """
    schema = sdf.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"{path}/{_BATCH}{batch_id}"
        seen = Observation()
        counted = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(own)
        rows = seen.get["rows"]
        if not rows:
            remove_folder(spark, own)
        count_batch(spark, path, batch_id, rows)
        if close_every is not None:
            close_batches(spark, path, batch_id - keep, schema, least=close_every)

    writer = sdf.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return set_trigger(writer, every).start()


def count_batch(spark: SparkSession, path: str, batch_id: int, rows: int) -> None:
    """Adds a batch to the rows received. If it comes again it replaces what it added.

    The sums after the last two batches are kept in a small file each, so the next one reads one.
    """
    last = read_text(spark, f"{path}/{RECEIVED}/{(batch_id - 1) % 2}.json") if batch_id else None
    before = json.loads(last)["received"] if last else 0
    counted = {"batch": batch_id, "rows": rows, "received": before + rows}
    write_text(spark, f"{path}/{RECEIVED}/{batch_id % 2}.json", json.dumps(counted))


def received_so_far(spark: SparkSession, path: str) -> DataFrame:
    """One row: the last ``batch``, the ``rows`` it had, and all ``received`` up to it.

    Nothing is counted again. No row before the first batch.
    """
    if not folder_exists(spark, f"{path}/{RECEIVED}"):
        return spark.createDataFrame([], _COUNTS)
    # one of the two may just be written anew
    slots = spark.read.schema(_COUNTS).option("mode", "DROPMALFORMED")
    slots = slots.json(f"{path}/{RECEIVED}").where("received is not null")
    return slots.orderBy(F.desc("batch")).limit(1)
