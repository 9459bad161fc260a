"""Exact top-k search by inner products of whole numbers, in tiles of queries and shards.

Vectors are numbered and dealt to shards, queries to blocks; neither depends on what they hold.
Each block meets each shard in one task, which multiplies them as matrices tile by tile. Of a
tile, only what is above the k-th best so far is looked at, and the k best are kept. A query's
lists from the shards are then merged like the levels of a tree, ``FAN`` of them at a time.

As every query is compared with every vector, the products grow with the square of the table.
What is shuffled does so more slowly: a vector is sent once for each block of ``BLOCK`` queries,
a query once for each shard.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import stored
from feedloom.llm.vectors import packed_vectors, unpack

K = 5
EVERY = 50
SCALE = 256
#: Queries of a block and vectors of a shard, at most, and numbers of either, about.
BLOCK = 1 << 18
SHARD = 1 << 20
NUMBERS = 1 << 25
#: Shards are smaller than that if there are fewer than tasks, but not below this.
LEAST_SHARD = 2048
#: Queries and vectors of a tile.
TILE = (256, 8192)
#: Lists merged at a time, and hits of a query in a tile that are looked at one by one.
FAN = 32
_FEW = 64
_LISTS = "query bigint, query_id bigint, vec bigint, vec_id bigint, score bigint, shard int"


def _matrix(column: pa.Array, lengths: pa.Array, length: int) -> np.ndarray:
    rows = np.zeros((len(column), length), np.int64)
    for part, found in unpack(column, lengths):
        rows[part] = found
    return rows


def _largest_square(rows: np.ndarray) -> float:
    values = rows.astype(np.float64)
    return float((values * values).sum(axis=1).max(initial=0.0))


def top_of_shard(
    queries: np.ndarray, query_rows: np.ndarray, shard: np.ndarray, shard_rows: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Queries, places in the shard and scores of the ``k`` best of each query.

    Of equal scores that at the smaller place comes first. A query is not compared with the
    vector of its own row. Products are taken in the narrowest type in which all are exact.
    """
    reach = math.sqrt(_largest_square(queries) * _largest_square(shard))
    exact = np.float32 if reach < 1 << 23 else np.float64 if reach < 1 << 52 else np.int64
    lowest = np.iinfo(np.int64).min if exact is np.int64 else -np.inf
    right = np.ascontiguousarray(shard.T.astype(exact))
    own_order = np.argsort(shard_rows)
    for at in range(0, len(queries), TILE[0]):
        left = queries[at : at + TILE[0]].astype(exact)
        many = len(left)
        spot = np.searchsorted(shard_rows, query_rows[at : at + many], sorter=own_order)
        own = own_order[np.minimum(spot, len(shard_rows) - 1)]
        has_own = np.flatnonzero(shard_rows[own] == query_rows[at : at + many])
        best = np.full((many, k), lowest, exact)
        place = np.full((many, k), -1)
        for begin in range(0, len(shard), TILE[1]):
            scores = left @ right[:, begin : begin + TILE[1]]
            wide = scores.shape[1]
            inside = has_own[(own[has_own] >= begin) & (own[has_own] < begin + wide)]
            scores[inside, own[inside] - begin] = lowest
            hit = scores > best[:, -1:]
            crowded = np.flatnonzero(hit.sum(axis=1) > max(_FEW, k))
            if len(crowded) and wide > k:
                worst = np.partition(scores[crowded], wide - k, axis=1)[:, wide - k]
                hit[crowded] &= scores[crowded] >= worst[:, None]
            row, column = np.nonzero(hit)
            if not len(row):
                continue
            old = np.nonzero(place >= 0)
            rows = np.concatenate([old[0], row])
            values = np.concatenate([best[old], scores[row, column]])
            places = np.concatenate([place[old], column + begin])
            order = np.lexsort((places, -values, rows))
            rows, values, places = rows[order], values[order], places[order]
            starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
            kept = rank < k
            best[rows[kept], rank[kept]] = values[kept]
            place[rows[kept], rank[kept]] = places[kept]
        row, rank = np.nonzero(place >= 0)
        yield row + at, place[row, rank], best[row, rank].astype(np.int64)


def _dealt(row: Column, parts: Column) -> Column:
    return F.pmod(F.xxhash64(row), parts).cast("int")


def _of_length(numbers: dict[int, int]) -> Column:
    """The number for the length of a vector; there are as many cases as lengths above one."""
    several = sorted(item for item in numbers.items() if item[1] > 1)
    if not several:
        return F.lit(1)
    of = F.create_map(*(F.lit(x) for item in several for x in item))
    return F.coalesce(F.element_at(of, F.col("length")), F.lit(1))


def _merged(lists: DataFrame, shards: int, k: int) -> DataFrame:
    """The ``k`` best of each query from its lists, with their ``rank``."""
    best = [F.desc("score"), F.asc_nulls_last("vec_id"), "vec"]
    while shards > FAN:
        lists = lists.withColumn("shard", F.floor(F.col("shard") / FAN).cast("int"))
        within = Window.partitionBy("query", "shard").orderBy(*best)
        lists = lists.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= k)
        lists = lists.drop("rank")
        shards = math.ceil(shards / FAN)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*best))
    return lists.withColumn("rank", rank).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    every: int = EVERY,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = K,
    scale: int = SCALE,
) -> DataFrame:
    """The ``k`` best of each vector whose id is divisible by ``every``, among all other rows.

    Components x become whole numbers ``floor(scale * x)``, the score is the inner product of
    these. Columns: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; of equal scores the
    smaller id comes first. A query gets all others if there are no more than ``k``.

    Null vectors and those with components that are null or not finite are left out. Vectors are
    compared with those of their own length only; empty ones have the score 0 with each other.
    Repeated rows are candidates and queries of their own: a query is kept apart from its own
    row, not from others of its id. Rows with a null id are candidates, after all others of equal
    score, and no queries. Whole numbers so large that a score would not fit a long count as the
    largest that do. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    packed = packed_vectors(vectors, scale, id_col, vec_col)
    packed = packed.withColumn("vec_id", F.col("vec_id").cast("bigint"))
    rows = stored(packed.withColumn("row", F.monotonically_increasing_id()), "search-vectors")
    asks = F.col("vec_id") % every == 0
    sizes = rows.groupBy("length").agg(F.count(F.lit(1)), F.count_if(asks)).collect()
    tasks = 2 * spark.sparkContext.defaultParallelism
    shards, blocks = {}, {}
    for length, count, asked in sizes:  # a row for each length of vectors there is
        most = max(1, min(SHARD, NUMBERS // max(length, 1)))
        least = max(1, min(most, LEAST_SHARD))
        shards[length] = max(math.ceil(count / most), min(tasks, math.ceil(count / least)))
        blocks[length] = math.ceil(asked / max(1, min(BLOCK, NUMBERS // max(length, 1))))

    def copied(numbers: dict[int, int]) -> Column:
        return F.explode(F.sequence(F.lit(0), _of_length(numbers) - 1))

    keys = ["length", "block", "shard"]
    asking = {length for length, block in blocks.items() if block}
    # columns of their own: the two sides of a cogroup must not share any
    queries = rows.where(asks).select(*(F.col(c).alias(c) for c in rows.columns))
    queries = queries.withColumn("block", _dealt(F.col("row"), _of_length(blocks)))
    queries = queries.withColumn("shard", copied(shards))
    others = rows.where(F.col("length").isin(*asking)) if len(asking) < len(blocks) else rows
    others = others.withColumn("shard", _dealt(F.col("row"), _of_length(shards)))
    others = others.withColumn("block", copied(blocks))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        left = left.combine_chunks()
        right = right.sort_by([("vec_id", "ascending"), ("row", "ascending")]).combine_chunks()
        length, shard = left["length"][0].as_py(), left["shard"][0].as_py()
        asked, held = (
            _matrix(*(x[c].combine_chunks() for c in ("packed", "length")), length)
            for x in (left, right)
        )
        query_rows, held_rows = (x["row"].to_numpy() for x in (left, right))
        left, right = left.select(["row", "vec_id"]), right.select(["row", "vec_id"])
        found = [empty]
        for row, place, score in top_of_shard(asked, query_rows, held, held_rows, k):
            query, vec = left.take(pa.array(row)), right.take(pa.array(place))
            of_shard = pa.array(np.full(len(row), shard, np.int32))
            found.append(
                pa.table([*query.columns, *vec.columns, pa.array(score), of_shard], names)
            )
        return pa.concat_tables(found)

    schema = T.StructType.fromDDL(_LISTS)
    names = schema.names
    empty = pa.table([pa.array([], pa.int64())] * 5 + [pa.array([], pa.int32())], names)
    pairs = queries.groupBy(*keys).cogroup(others.groupBy(*keys))
    lists = pairs.applyInArrow(search, schema)
    merged = _merged(lists, max(shards.values(), default=1), k)
    return merged.select("query_id", "rank", "vec_id", "score")
