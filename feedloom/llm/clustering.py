"""Clusters around centroids of whole numbers, with a filter on rotated vectors.

Vectors and centroids are rotated to their principal axes. Of each, the leading coordinates are
kept, and the norm of what is left of it. The distance of the leading coordinates and that of
the two norms, both squared, add up to a lower bound of the squared distance. A vector is
compared with the centroid of the least bound in whole numbers, and then with those others only
whose bound is not above what this gave.

The vectors are rotated once and written. Each round reads them, with the centroids broadcast,
and sends for each task and cluster a count and a sum; the driver gets a row for each cluster
and dimension.
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import stored
from feedloom.llm.vectors import packed_vectors, unpack, vector_covariances, vector_sums

CLUSTERS = 8
ROUNDS = 10
DIMS = 64
SCALE = 1024
SEED = 3
#: Leading coordinates that are kept.
LEADING = 16
#: What the bound may be off by, as a share of the squares that it is made from.
_SLACK = 1e-9


class Rotation:
    """The principal axes of all vectors, about their mean."""

    def __init__(self, mean: np.ndarray, covariance: np.ndarray, leading: int):
        self.mean = mean
        self.axes = np.linalg.eigh(covariance)[1][:, ::-1][:, :leading]

    def reduced(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The leading coordinates of each row, the norm of the rest, and the square of all."""
        centred = rows - self.mean
        leading = centred @ self.axes
        rest = centred - leading @ self.axes.T
        return leading, np.sqrt((rest * rest).sum(axis=1)), (centred * centred).sum(axis=1)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = a - b
    return (apart * apart).sum(axis=1)


class Centroids:
    """Centroids with what the bounds need of them."""

    def __init__(self, rows: np.ndarray, rotation: Rotation):
        self.rows = rows
        self.leading, self.rest, self.square = rotation.reduced(rows)

    def nearest(
        self, rows: np.ndarray, leading: np.ndarray, rest: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest centroid of each row, the smallest number of several, and how far it is.

        The third is the number of distances that were taken in whole numbers.
        """
        bounds = (rest[:, None] - self.rest) ** 2
        for number in range(len(self.rows)):
            bounds[:, number] += _squared(leading, self.leading[number])
        every = np.arange(len(rows))
        first = bounds.argmin(axis=1)
        found = np.full(bounds.shape, np.iinfo(np.int64).max)
        found[every, first] = best = _squared(rows, self.rows[first])
        size = (leading * leading).sum(axis=1) + rest * rest
        slack = _SLACK * (size[:, None] + self.square + 1)
        alive = bounds <= best[:, None] + slack
        alive[every, first] = False
        which, numbers = np.nonzero(alive)
        found[which, numbers] = _squared(rows[which], self.rows[numbers])
        cluster = found.argmin(axis=1)
        return cluster, found[every, cluster], len(rows) + len(which)


def _rotated(vectors: DataFrame, leading: int) -> tuple[DataFrame, Rotation] | None:
    """The vectors with ``leading`` and ``rest``, written once; None where there are none."""
    vectors = stored(vectors, "cluster-vectors")
    sums = vector_sums(vectors, F.lit(1))
    if not sums:
        return None
    ((length, (count, total)),) = sums.items()
    mean = np.array([s / count for s in total])
    rotation = Rotation(mean, vector_covariances(vectors, F.lit(1), sums)[length], leading)
    shared = vectors.sparkSession.sparkContext.broadcast(rotation)

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in unpack(batch.column("packed"), batch.column("length")):
                kept, rest, _ = shared.value.reduced(found)
                ends = np.arange(len(part) + 1, dtype=np.int32) * np.int32(kept.shape[1])
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(kept.reshape(-1)))
                chosen = batch.take(pa.array(part))
                yield pa.RecordBatch.from_arrays(
                    [*chosen.columns, lists, pa.array(rest)],
                    [*chosen.schema.names, "leading", "rest"],
                )

    schema = T.StructType([*vectors.schema.fields])
    schema = schema.add("leading", T.ArrayType(T.DoubleType())).add("rest", "double")
    return stored(vectors.mapInArrow(rotate, schema), "cluster-rotated"), rotation


def _nearest_of(batch: pa.RecordBatch, centroids: Centroids):
    """Parts of a batch with their vectors and the nearest centroids of these."""
    flat = batch.column("leading").flatten().to_numpy(zero_copy_only=False)
    leading = flat.reshape(batch.num_rows, -1)
    rest = batch.column("rest").to_numpy(zero_copy_only=False)
    for part, found in unpack(batch.column("packed"), batch.column("length")):
        yield part, found, centroids.nearest(found, leading[part], rest[part])


def _means(rotated: DataFrame, centroids: Centroids) -> dict[int, list[int]]:
    """The floors of the exact means of the clusters that have vectors."""
    shared = rotated.sparkSession.sparkContext.broadcast(centroids)
    dims = centroids.rows.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # one sum for each batch, which cannot overflow: see ``most`` in ``clusters``
            sums = np.zeros((len(shared.value.rows), dims + 1), np.int64)
            for _, found, (cluster, _, _) in _nearest_of(batch, shared.value):
                np.add.at(sums[:, 1:], cluster, found)
                sums[:, 0] += np.bincount(cluster, minlength=len(sums))
            some = np.flatnonzero(sums[:, 0])
            if len(some):
                yield pa.RecordBatch.from_pydict(
                    {
                        "cluster": pa.array(some, pa.int32()),
                        "sums": pa.array(list(sums[some]), pa.list_(pa.int64())),
                    }
                )

    parts = rotated.select("length", "packed", "leading", "rest").mapInArrow(
        partial, "cluster int, sums array<bigint>"
    )
    each = parts.select("cluster", F.posexplode("sums").alias("place", "total"))
    total = F.sum(F.col("total").cast("decimal(20,0)")).alias("total")
    found: dict[int, dict[int, int]] = {}
    for r in each.groupBy("cluster", "place").agg(total).collect():
        found.setdefault(r["cluster"], {})[r["place"]] = int(r["total"])
    return {c: [by[i + 1] // by[0] for i in range(dims)] for c, by in found.items()}


def _first(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest digests of their ids, in that order."""
    text = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    ordered = vectors.where("vec_id is not null").withColumn("digest", F.sha2(text, 256))
    chosen = ordered.orderBy("digest", "packed").limit(clusters).select("length", "packed")
    found = [tuple(r) for r in chosen.collect()]
    batch = pa.table(
        [pa.array([r[0] for r in found], pa.int32()), pa.array([bytes(r[1]) for r in found])],
        ["length", "packed"],
    ).combine_chunks()
    rows = np.zeros((len(found), found[0][0] if found else 0), np.int64)
    if found:
        columns = (batch.column(c).combine_chunks() for c in ("packed", "length"))
        for part, values in unpack(*columns):
            rows[part] = values
    return rows


def clusters(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    count: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: int = SEED,
    leading: int = LEADING,
) -> DataFrame:
    """The cluster of each vector with exactly ``dims`` components, all of them finite.

    Components x become whole numbers ``floor(scale * x)``. The first centroids are the vectors
    with the smallest sha256 of ``<seed>:<vec_id>``; in each round every vector goes to the
    nearest one (of equally near ones, that of the smaller number), and every centroid becomes
    the floor of the mean of its vectors; one without vectors stays. Columns: ``vec_id``,
    ``cluster``, ``distance`` (squared), ``cluster_inertia`` and ``inertia``, the sum of the
    distances in the cluster and in all, and ``centroid_sha256`` of the final centroid.

    Null vectors, those of another length, and those with components that are null or not finite
    are left out. Repeated rows are vectors of their own; of rows of one id the smallest bytes
    come first. Rows with a null id take part but start no centroid; if all ids are null there
    are no centroids and no rows. With fewer vectors than ``count`` there are as many centroids
    as vectors with an id. Whole numbers so large that a distance would not fit a long count as
    the largest that do. A sum that no long can hold is null. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    most = math.isqrt((1 << 62) // max(dims, 1)) // 2
    usable = packed_vectors(vectors, scale, id_col, vec_col, most).where(F.col("length") == dims)
    schema = T.StructType([usable.schema["vec_id"]]).add("cluster", "integer")
    for name in ("distance", "cluster_inertia", "inertia"):
        schema = schema.add(name, "long")
    schema = schema.add("centroid_sha256", "string")
    found = _rotated(usable, leading)
    if found is None:
        return spark.createDataFrame([], schema)
    rotated, rotation = found
    rows = _first(rotated, count, seed)
    if not len(rows):
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        before = rows.copy()
        for cluster, mean in _means(rotated, Centroids(rows, rotation)).items():
            rows[cluster] = mean
        if (rows == before).all():  # all later rounds would give the same
            break
    final = spark.sparkContext.broadcast(Centroids(rows, rotation))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, (cluster, distance, _) in _nearest_of(batch, final.value):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(part)),
                        pa.array(cluster.astype(np.int32)),
                        pa.array(distance),
                    ],
                    ["vec_id", "cluster", "distance"],
                )

    assigned = stored(rotated.mapInArrow(assign, T.StructType(schema.fields[:3])), "clusters")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")))
    inertia = {r[0]: int(r[1]) for r in sums.collect()}  # a row for each cluster

    def long_or_null(number: int):
        return F.lit(number if number < 1 << 63 else None).cast("bigint")

    numbers = sorted(inertia)
    digests = {c: hashlib.sha256(",".join(map(str, rows[c])).encode()).hexdigest() for c in numbers}

    def of_cluster(value):
        return F.element_at(F.array(*(value(c) for c in range(len(rows)))), F.col("cluster") + 1)

    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster(lambda c: long_or_null(inertia.get(c, 0))).alias("cluster_inertia"),
        long_or_null(sum(inertia.values())).alias("inertia"),
        of_cluster(lambda c: F.lit(digests.get(c))).alias("centroid_sha256"),
    )
