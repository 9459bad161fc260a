"""Exact dedup: frequent digests are found first and settled without a shuffle.

A Misra-Gries summary of each partition finds the digests that may be frequent. Exact counts
verify them, and the verified winners, ``counters`` rows at most, are broadcast to the rows they
settle. All other digests have few rows each and go through an ordinary shuffle.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import ascii_lower, portions, stored, texts_of

#: A digest with more than 2 in so many of all rows is sure to be found frequent.
COUNTERS = 1023


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``row`` (a number of its own for each row) and ``digest`` of every text.

    The digest is SHA-256 of the UTF-8 text after lower-casing A-Z only; null counts as empty.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col(text_col).alias("text"),
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text"):
                # bytes.lower() is for A-Z alone
                found = [hashlib.sha256(t.lower()).digest() for t in texts_of(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row"), pa.array(found, pa.binary())],
                    ["doc_id", "row", "digest"],
                )

    schema = T.StructType(
        [rows.schema["doc_id"], rows.schema["row"], T.StructField("digest", T.BinaryType())]
    )
    return rows.mapInArrow(digest, schema)


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests that may be frequent: all with over 2 in ``counters`` + 1 rows, ``counters`` at most.

    Each partition keeps ``counters`` counts. If more digests turn up, the largest count that
    does not fit is taken off all of them. In sum over the partitions a count is thus too low by
    one in ``counters`` + 1 rows at most, and the counts do not exceed the rows.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for x in pc.value_counts(batch.column("digest")).to_pylist():
                counts[x["values"]] = counts.get(x["values"], 0) + x["counts"]
            if len(counts) > counters:
                off = sorted(counts.values(), reverse=True)[counters]
                counts = {k: v - off for k, v in counts.items() if v > off}
        yield pa.RecordBatch.from_pydict(
            {"digest": list(counts), "count": list(counts.values())},
            schema=pa.schema([("digest", pa.binary()), ("count", pa.int64())]),
        )

    total = digests.count()
    summaries = digests.select("digest").mapInArrow(summary, "digest binary, count bigint")
    return (
        summaries.groupBy("digest")
        .agg(F.sum("count").alias("count"))
        .where(F.col("count") * (counters + 1) > total)
        .select("digest")
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """One row for each row of ``docs``, with the group of equal texts it belongs to.

    Columns: ``doc_id``, ``keep_id`` (the id of the row that stays, the largest of the group),
    ``group_size``, ``kept``, ``text_sha256``. A null text is an empty one. A null id is smaller
    than any other. If the largest id of a group is on several rows, one of them stays. An empty
    table gives an empty one. Other columns of ``docs`` are not read.
    """
    digests = stored(text_digests(docs, id_col, text_col), "digests")
    # (id, row) orders the rows of a group; the row number settles repeated ids
    winner = F.max(F.struct("doc_id", "row")).alias("winner")
    size = F.count(F.lit(1)).alias("group_size")
    likely = F.broadcast(frequent(digests, counters))
    winners = stored(digests.join(likely, "digest").groupBy("digest").agg(winner, size), "winners")
    settled = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners), "digest", "left_anti")
    group = Window.partitionBy("digest")
    rest = rest.withColumns(
        {
            "winner": F.max(F.struct("doc_id", "row")).over(group),
            "group_size": F.count(F.lit(1)).over(group),
        }
    )
    return settled.unionByName(rest).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def distinct_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with the columns they came with.

    Rows are found again by id and digest. Of rows that have both in common, one stays; these are
    reduced to one within the tasks before the shuffle, as they may be very many.
    """
    stay = exact_dedup(docs, id_col, text_col, counters).where("kept")
    # a null within a struct equals another one
    stay = stay.select(F.struct("doc_id").alias("id"), F.col("text_sha256").alias("digest"))
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.struct(F.col(id_col).alias("doc_id")).alias("id"),
        F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256).alias("digest"),
    )
    # rows of one id and digest are equal but for other columns
    rows = rows.groupBy("id", "digest").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return rows.join(stay, ["id", "digest"], "left_semi").select("row.*")
