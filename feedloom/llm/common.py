"""Small helpers that several operators share."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import new_folder

#: Fixed value: a word is a run of anything but these.
WORD = r"[^\x20\x09-\x0D]+"
#: What may be before a word.
SPACE = r"[\x20\x09-\x0D]*"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of 64 marks that are broadcast at most; a word takes about 50 bytes in memory.
MARKS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read from there, so that nothing recomputes it.

    Lost executors cost no more than the tasks that ran on them.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def among(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of ``rows`` whose ``node``, a long, is one of ``nodes``, without a shuffle of the rows.

    For rows with texts. Nodes become marks, 64 in a word, which are broadcast: numbers close to
    each other, as of ``monotonically_increasing_id``, take less than a byte each. More than
    ``MARKS`` words are left to Spark, which then may shuffle the rows to them. Null is no node.
    """
    word = F.shiftright("node", 6)
    place = F.col("node").bitwiseAND(63).cast("int")
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    marks = nodes.groupBy(word.alias("_word")).agg(F.bit_or(mark).alias("_marks"))
    marks = stored(marks, "marks")
    if marks.count() <= MARKS:
        marks = F.broadcast(marks)
    marked = (word == F.col("_word")) & (mark.bitwiseAND(F.col("_marks")) != 0)
    return rows.join(marks, marked, "left_semi")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(text, _UPPER, _UPPER.lower())


def id_bucket(id_col: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; -1 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % buckets, F.lit(-1))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow text column one after the other, and where each text starts.

    Nulls count as empty texts. There is one more start than texts, the end of the last.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def texts_of(column: pa.Array) -> list[bytes]:
    """Each text of an Arrow column as UTF-8; nulls count as empty texts."""
    data, starts = utf8(column)
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]


def portions(batch: pa.RecordBatch, text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, one row at least.

    Thereby the arrays made from the text stay small, however many rows Spark sends at once.
    """
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
    part = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)
