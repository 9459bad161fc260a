"""Approximate nearest neighbours by an adaptive scan of dimensions within probed lists.

Vectors are brought to length 1 and put into lists by their nearest centre. How many lists a query
looks into is measured: of a sample of vectors the true neighbours are found, and as many of the
nearest lists are taken as hold the wanted share of them. Vectors in clusters need few lists,
vectors without any need many.

Lists are dealt to parts, and a query is sent once to each part that holds any of its lists. There
queries and lists are compared block of columns by block of columns of the rotated vectors: by the
rotation, a partial distance tells about the whole one, and a test abandons candidates whose
partial distance is too large for the best found so far. The first blocks are products of
matrices; when few pairs are left, these go on one by one.
"""

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import stored

K = 5
#: Share of the true neighbours of the sample that the probed lists are to hold.
WANTED = 0.96
SAMPLE = 256
#: Lists: the root of the number of vectors.
MOST_LISTS = 4096
#: Centres are fitted to so many vectors for each list, and to so many numbers in all, at most.
SAMPLED_PER_LIST = 64
SAMPLED_NUMBERS = 1 << 23
ROUNDS = 6
SEED = 11
#: Vectors of one cell of a list; cells are dealt to parts of so many vectors and numbers.
PART = 4096
PART_ROWS = 1 << 16
PART_NUMBERS = 1 << 23
#: Columns of a block, candidates that are compared in full after the first, and how sure the
#: test is.
COLUMNS = 16
FIRST = 16
EPSILON = 2.1
#: Queries compared at a time, and pairs.
QUERIES = 256
PAIRS = 1 << 17
#: Pairs are compared one by one when no more than this share of them is left.
SPARSE = 0.2
_SLACK = 1e-9


def usable_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """``vec_id``, ``vector``, ``length`` and ``tag`` of the vectors that take part.

    Null, empty and zero vectors and those with a component that is null or not finite are left
    out. Rows of one id and one vector have one ``tag``, and count as one row.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vector"))
    bad = F.exists(
        "vector",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")),
    )
    some = F.exists("vector", lambda x: x != 0)
    return rows.where("vector is not null").where(~bad & some).select(
        "vec_id",
        "vector",
        F.size("vector").alias("length"),
        F.xxhash64("vec_id", "vector").alias("tag"),
    )


def _matrix(column) -> np.ndarray:
    """The vectors of an Arrow column, all of one length, as rows, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = batch.column("length").to_numpy()
    for length in np.unique(lengths).tolist():
        yield length, batch.take(pa.array(np.flatnonzero(lengths == length)))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares must not overflow
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


@cache
def _rotation(dims: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    return np.linalg.qr(rng.standard_normal((dims, dims)))[0]


def _fit(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centres by spherical k-means."""
    rng = np.random.default_rng(SEED)
    sample = _unit(sample)
    centres = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(ROUNDS):
        nearest = _nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        length = np.sqrt((sums * sums).sum(axis=1))
        moved = length > 1e-12
        centres[moved] = sums[moved] / length[moved, None]
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    parts = [(rows[a : a + 4096] @ centres.T).argmax(axis=1) for a in range(0, len(rows), 4096)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _case(numbers: dict[int, float], other: float):
    """The number for the length of a vector; there are as many cases as lengths."""
    pairs = [F.lit(x) for item in sorted(numbers.items()) for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("length")), F.lit(other))


def fit_lists(rows: DataFrame, counts: dict[int, int]) -> dict[int, np.ndarray]:
    """The centres for each length of vectors, fitted in a task each to a bounded sample.

    The driver gets ``MOST_LISTS`` vectors of each length at most.
    """
    lists = {n: max(1, min(MOST_LISTS, round(math.sqrt(count)))) for n, count in counts.items()}
    share = {
        n: min(1.0, min(SAMPLED_PER_LIST * lists[n], SAMPLED_NUMBERS // n + 1) / count)
        for n, count in counts.items()
    }
    drawn = F.pmod(F.xxhash64(F.lit(SEED), "tag"), F.lit(1 << 30)) / (1 << 30)
    # one of each tag, so that a vector on very many rows of one id does not fill the sample
    sample = rows.where(drawn < _case(share, 0.0)).dropDuplicates(["tag"])

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("tag")
        length = table["length"][0].as_py()
        most = SAMPLED_PER_LIST * lists[length] * 2  # by chance there are a few more than asked
        centres = _fit(_matrix(table["vector"])[:most], lists[length])
        return pa.table(
            [
                pa.array([length] * len(centres), pa.int32()),
                pa.array(range(len(centres)), pa.int32()),
                pa.array(list(centres), pa.list_(pa.float64())),
            ],
            ["length", "number", "centre"],
        )

    fitted = sample.groupBy("length").applyInArrow(
        fit, "length int, number int, centre array<double>"
    )
    found: dict[int, list] = {n: [] for n in counts}
    for length, _, centre in sorted(map(tuple, fitted.collect())):
        found[length].append(centre)
    return {n: np.array(c) if c else np.zeros((1, n)) for n, c in found.items()}


def measured_probes(
    index: DataFrame, centres: dict[int, np.ndarray], counts: dict[int, int], k: int, wanted: float
) -> dict[int, int]:
    """How many of its nearest lists a query of each length has to look into.

    The true neighbours of ``SAMPLE`` vectors of a length are found among all, which takes time
    in proportion to their number. So many lists are needed as hold the share ``wanted`` of them;
    with 1 or more that is all.
    """
    several = {n: min(1.0, 1.5 * SAMPLE / counts[n]) for n, c in centres.items() if len(c) > 1}
    if not several or wanted >= 1:
        return {n: len(c) for n, c in centres.items()}
    drawn = F.pmod(F.xxhash64(F.lit(SEED + 1), "tag"), F.lit(1 << 30)) / (1 << 30)
    asked = index.where(drawn < _case(several, 0.0)).select("length", "tag", "vector")
    own = Window.partitionBy("length").orderBy("tag")
    asked = asked.dropDuplicates(["tag"]).withColumn("number", F.row_number().over(own))
    asked = asked.where(F.col("number") <= SAMPLE).orderBy("length", "number").collect()
    tags = {n: np.array([r["tag"] for r in asked if r["length"] == n]) for n in several}
    units = {
        n: _unit(np.array([r["vector"] for r in asked if r["length"] == n], float).reshape(-1, n))
        for n in several
    }
    shared = index.sparkSession.sparkContext.broadcast((tags, units))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags, units = shared.value
        for batch in batches:
            for length, part in _by_length(batch):
                if length not in units or not len(units[length]):
                    continue
                scores = units[length] @ _unit(_matrix(part.column("vector"))).T
                scores[tags[length][:, None] == part.column("tag").to_numpy()] = -2
                most = min(k, scores.shape[1])
                top = np.argpartition(-scores, most - 1, axis=1)[:, :most]
                number = np.repeat(np.arange(len(scores)), most)
                lists = part.column("list").to_numpy()[top.reshape(-1)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "length": pa.array(np.full(len(number), length, np.int32)),
                        "number": pa.array(number.astype(np.int32)),
                        "list": pa.array(lists),
                        "score": pa.array(scores[number, top.reshape(-1)]),
                    }
                )

    found = index.mapInArrow(best, "length int, number int, list int, score double")
    ranked = Window.partitionBy("length", "number").orderBy(F.desc("score"), "list")
    found = found.where("score > -2").withColumn("rank", F.row_number().over(ranked))
    places: dict[int, list[int]] = {n: [] for n in several}
    orders = {n: np.argsort(np.argsort(-(u @ centres[n].T), axis=1)) for n, u in units.items()}
    for r in found.where(F.col("rank") <= k).select("length", "number", "list").collect():
        places[r["length"]].append(int(orders[r["length"]][r["number"], r["list"]]))
    probes = {n: 1 for n in centres}
    for n, held in places.items():
        if held:
            probes[n] = sorted(held)[max(0, math.ceil(wanted * len(held)) - 1)] + 1
    return probes


def _exact(
    queries: np.ndarray, query: np.ndarray, vectors: np.ndarray, vector: np.ndarray
) -> np.ndarray:
    """Cosines of pairs, summed pair by pair, so that equal vectors have equal ones."""
    found = np.empty(len(query))
    for a in range(0, len(query), PAIRS):
        x, y = queries[query[a : a + PAIRS]], vectors[vector[a : a + PAIRS]]
        x = x / np.abs(x).max(axis=1, keepdims=True)
        y = y / np.abs(y).max(axis=1, keepdims=True)
        lengths = np.sqrt((y * y).sum(axis=1))
        found[a : a + PAIRS] = (y * x).sum(axis=1) / (lengths * np.sqrt((x * x).sum(axis=1)))
    return found


def _first_of_each(keys: np.ndarray, k: int) -> np.ndarray:
    """Which of sorted rows are among the first ``k`` with their key."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[: len(keys)]
    return np.arange(len(keys)) - np.repeat(starts, np.diff(np.r_[starts, len(keys)])) < k


class PartScan:
    """The vectors of a part, in lists, and the best of them for the queries that look there."""

    def __init__(
        self,
        vectors: np.ndarray,
        ids: np.ndarray,
        tags: np.ndarray,
        lists: np.ndarray,
        k: int,
    ):
        # of equal vectors those with the smallest ids can be among the best, and one of them
        # may be the query's own
        _, first, equal = np.unique(
            vectors + 0.0, axis=0, return_index=True, return_inverse=True
        )
        equal = equal.reshape(-1)
        order = np.lexsort((tags, ids, equal))
        again = np.r_[False, (np.diff(tags[order]) == 0) & (np.diff(ids[order]) == 0)]
        order = order[~again]
        order = order[_first_of_each(equal[order], k + 1)]
        order = order[np.argsort(lists[order], kind="stable")]
        self.vectors, self.ids, self.tags, self.lists = (
            x[order] for x in (vectors, ids, tags, lists)
        )
        self.k, self.dims = k, vectors.shape[1]
        turned = _unit(self.vectors) @ _rotation(self.dims)
        self.blocks = [slice(a, min(a + COLUMNS, self.dims)) for a in range(0, self.dims, COLUMNS)]
        self.turned = [np.ascontiguousarray(turned[:, b]) for b in self.blocks]
        self.squares = [(t * t).sum(axis=1) for t in self.turned]
        self.compared = 0

    def search(
        self, queries: np.ndarray, ids: np.ndarray, tags: np.ndarray, looks: list[np.ndarray]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, vectors and exact cosines of the best of each query in the lists it looks into."""
        turned = _unit(queries) @ _rotation(self.dims)
        of = np.repeat(np.arange(len(queries)), [len(x) for x in looks])
        wanted = np.concatenate(looks) if looks else np.zeros(0, np.int64)
        worst = np.full(len(queries), np.inf)
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for number in np.unique(self.lists).tolist():
            a, b = np.searchsorted(self.lists, [number, number + 1])
            asking = of[wanted == number]
            found = []
            for at in range(0, len(asking), QUERIES):
                some = asking[at : at + QUERIES]
                for begin in range(a, b, PART):
                    rows, columns, near = self._survivors(
                        turned[some], ids[some], tags[some], worst[some], begin, min(begin + PART, b)
                    )
                    found.append((some[rows], columns, near))
            if not found:
                continue
            rows, columns, near = (np.concatenate(x) for x in zip(*found, strict=True))
            # those that k others of the list beat for sure need no exact cosine
            order = np.lexsort((near, rows))
            rows, columns, near = rows[order], columns[order], near[order]
            starts = np.searchsorted(rows, np.arange(len(queries) + 1))
            limit = np.full(len(queries), np.inf)
            enough = np.flatnonzero(np.diff(starts) >= self.k)
            limit[enough] = near[starts[enough] + self.k - 1]
            kept = near <= limit[rows] + _SLACK
            rows, columns = rows[kept], columns[kept]
            scores = _exact(queries, rows, self.vectors, columns)
            rows, columns, scores = (
                np.concatenate(x) for x in zip(best, (rows, columns, scores), strict=True)
            )
            order = np.lexsort((self.tags[columns], self.ids[columns], -scores, rows))
            order = order[_first_of_each(rows[order], self.k)]
            best = rows[order], columns[order], scores[order]
            counts = np.bincount(best[0], minlength=len(queries))
            lowest = np.full(len(queries), np.inf)
            np.minimum.at(lowest, best[0], best[2])
            worst = np.where(counts == self.k, 2 - 2 * lowest, np.inf)
        return best

    def _bound(self, queries: np.ndarray, seen: np.ndarray, begin: int) -> np.ndarray:
        """For each query the k-th best of those whole distances that look best so far."""
        most = min(FIRST, seen.shape[1])
        if most < self.k:
            return np.full(len(queries), np.inf)
        first = np.argpartition(seen, most - 1, axis=1)[:, :most]
        near = np.zeros(first.shape)
        for b, turned in zip(self.blocks, self.turned, strict=True):
            apart = turned[first + begin] - queries[:, None, b]
            near += (apart * apart).sum(axis=2)
        near[np.isinf(np.take_along_axis(seen, first, axis=1))] = np.inf
        return np.partition(near, self.k - 1, axis=1)[:, self.k - 1] + _SLACK

    def _survivors(
        self,
        queries: np.ndarray,
        ids: np.ndarray,
        tags: np.ndarray,
        worst: np.ndarray,
        begin: int,
        end: int,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs that no test abandons, with their squared distances."""
        own = (tags[:, None] == self.tags[begin:end]) & (ids[:, None] == self.ids[begin:end])
        seen = np.zeros((len(queries), end - begin))
        alive, pairs = ~own, None
        for b, turned, squares in zip(self.blocks, self.turned, self.squares, strict=True):
            mine = queries[:, b]
            if pairs is None:
                self.compared += seen.size
                more = squares[begin:end] - 2 * mine @ turned[begin:end].T
                seen += np.maximum(more + (mine * mine).sum(axis=1)[:, None], 0)
                if b.start == 0:
                    worst = np.minimum(worst, self._bound(queries, np.where(own, np.inf, seen), begin))
            else:
                rows, columns, near = pairs
                self.compared += len(rows)
                for a in range(0, len(rows), PAIRS):
                    apart = turned[columns[a : a + PAIRS] + begin] - mine[rows[a : a + PAIRS]]
                    near[a : a + PAIRS] += (apart * apart).sum(axis=1)
            share = b.stop / self.dims
            slack = 1.0 if b.stop == self.dims else (1 + EPSILON / math.sqrt(b.stop)) ** 2
            allowed = slack * worst * share + _SLACK
            if pairs is None:
                alive &= seen <= allowed[:, None]
                if b.stop == self.dims or alive.sum() <= SPARSE * alive.size:
                    rows, columns = np.nonzero(alive)
                    pairs = rows, columns, seen[rows, columns]
            else:
                kept = near <= allowed[rows]
                pairs = rows[kept], columns[kept], near[kept]
        rows, columns, near = pairs
        return rows, columns + begin, near


def nearest_neighbours(
    vectors: DataFrame,
    every: int = 50,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = K,
    wanted: float = WANTED,
) -> DataFrame:
    """The ``k`` nearest of each vector whose id is divisible by ``every``, among all others.

    Columns: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the cosine of the original
    vectors in double precision; equal scores are ranked by the smaller id. A query gets all
    others if there are no more than ``k``. Null, empty and zero vectors and those with components
    that are null or not finite take no part. Vectors of each length are searched by themselves.
    Rows of one id and one vector are one row; rows of one id with several vectors are queries and
    candidates each. Rows without an id are candidates, after all others of equal score, and no
    queries. Without any vector the result is empty. All vectors are indexed, the centres are
    fitted to a sample.
    """
    spark = vectors.sparkSession
    rows = usable_vectors(vectors, id_col, vec_col)
    rows = rows.withColumn("vec_id", F.col("vec_id").cast("bigint"))
    counts = dict(map(tuple, rows.groupBy("length").count().collect()))  # a row for each length
    if not counts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    centres = fit_lists(rows, counts)
    model = spark.sparkContext.broadcast(centres)
    names = [*rows.columns, "list"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, part in _by_length(batch):
                nearest = _nearest(_unit(_matrix(part.column("vector"))), model.value[length])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(nearest, pa.int32())], names
                )

    schema = T.StructType([*rows.schema.fields, T.StructField("list", T.IntegerType())])
    index = stored(rows.mapInArrow(assign, schema), "ann-index")
    probes = measured_probes(index, centres, counts, k, wanted)

    # lists are cut into cells, and cells are dealt to parts
    sizes = {tuple(r)[:2]: r[2] for r in index.groupBy("length", "list").count().collect()}
    cells = {key: math.ceil(size / PART) for key, size in sizes.items()}
    tasks = 2 * spark.sparkContext.defaultParallelism
    parts = {}
    for length, count in counts.items():
        most = max(1, min(PART_ROWS, PART_NUMBERS // length))
        of_length = sum(n for (of, _), n in cells.items() if of == length)
        parts[length] = min(of_length, max(math.ceil(count / most), tasks))
    dealt: dict[int, int] = {}
    first = {}  # the number of each list's first cell; a cell's part is its number, modulo
    for length, number in sorted(cells):
        first[length, number] = dealt.get(length, 0)
        dealt[length] = first[length, number] + cells[length, number]
    shared = spark.sparkContext.broadcast((sizes, cells, first, parts))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, cells, first, parts = shared.value
        for batch in batches:
            keys = list(
                zip(batch.column("length").to_pylist(), batch.column("list").to_pylist(), strict=True)
            )
            cut = batch.column("tag").to_numpy() % np.array([cells[x] for x in keys])
            part = (np.array([first[x] for x in keys]) + cut) % [parts[x[0]] for x in keys]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(part.astype(np.int32))], [*names, "part"]
            )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, cells, first, parts = shared.value
        for batch in batches:
            for length, some in _by_length(batch):
                near = _unit(_matrix(some.column("vector"))) @ model.value[length].T
                order = np.argsort(-near, axis=1, kind="stable")
                held = np.array([sizes.get((length, i), 0) for i in range(near.shape[1])])
                # more lists, until they hold k vectors besides the query
                enough = (np.cumsum(held[order], axis=1) <= k).sum(axis=1) + 1
                looks = np.minimum(np.maximum(enough, probes[length]), near.shape[1])
                at, to, lists = [], [], []
                for row, (own, n) in enumerate(zip(order, looks, strict=True)):
                    of_part: dict[int, list[int]] = {}
                    for number in own[:n].tolist():
                        start = first.get((length, number), 0)
                        for cell in range(min(cells.get((length, number), 0), parts[length])):
                            of_part.setdefault((start + cell) % parts[length], []).append(number)
                    at += [row] * len(of_part)
                    to += of_part
                    lists += of_part.values()
                for a in range(0, len(at), 10_000):
                    chosen = some.take(pa.array(at[a : a + 10_000], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *chosen.columns,
                            pa.array(to[a : a + 10_000], pa.int32()),
                            pa.array(lists[a : a + 10_000], pa.list_(pa.int32())),
                        ],
                        [*chosen.schema.names, "part", "lists"],
                    )

    schema = T.StructType([*schema.fields, T.StructField("part", T.IntegerType())])
    candidates = index.mapInArrow(deal, schema)
    chosen = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "tag", "vector"])
    chosen = stored(chosen.withColumn("query", F.monotonically_increasing_id()), "ann-queries")
    schema = T.StructType([*chosen.schema.fields, T.StructField("part", T.IntegerType())])
    schema = schema.add("lists", T.ArrayType(T.IntegerType()))
    looked = stored(chosen.mapInArrow(probe, schema), "ann-probes")
    # a part with very many queries takes them in turns
    asked = {tuple(r)[:2]: r[2] for r in looked.groupBy("length", "part").count().collect()}
    turns = {key: math.ceil(n / PART_ROWS) for key, n in asked.items() if n > PART_ROWS}

    def turns_of():
        pairs = [F.lit(x) for (n, part), turn in sorted(turns.items()) for x in (f"{n}-{part}", turn)]
        of = F.concat_ws("-", "length", "part")
        return F.coalesce(F.element_at(F.create_map(*pairs), of), F.lit(1)) if pairs else F.lit(1)

    left = looked.withColumn("turn", F.pmod(F.col("query"), turns_of()).cast("int"))
    right = candidates.withColumn("turn", F.explode(F.sequence(F.lit(0), turns_of() - 1)))
    right = right.withColumn("turn", F.col("turn").cast("int"))
    lists = T.StructType.fromDDL("query long, query_id long, vec_id long, tag long, score double")
    nothing = pa.table(
        [pa.array([], pa.int64())] * 4 + [pa.array([], pa.float64())], lists.names
    )

    def scan(queries: pa.Table, others: pa.Table) -> pa.Table:
        if not queries.num_rows or not others.num_rows:
            return nothing
        ids = others["vec_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
        part = PartScan(
            _matrix(others["vector"]), ids, others["tag"].to_numpy(), others["list"].to_numpy(), k
        )
        offsets = [np.array(x) for x in queries["lists"].to_pylist()]
        query, vector, score = part.search(
            _matrix(queries["vector"]),
            queries["vec_id"].to_numpy(),
            queries["tag"].to_numpy(),
            offsets,
        )
        named = part.ids[vector]
        return pa.table(
            [
                pa.array(queries["query"].to_numpy()[query]),
                pa.array(queries["vec_id"].to_numpy()[query]),
                pa.array(named, mask=named == np.iinfo(np.int64).max),
                pa.array(part.tags[vector]),
                pa.array(score),
            ],
            lists.names,
        )

    keys = ["length", "part", "turn"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(scan, lists)
    best = Window.partitionBy("query").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "tag"
    )
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
