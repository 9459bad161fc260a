"""Vectors of whole numbers: how they are packed, and sums over all of them.

A packed vector has two, four or eight bytes for each component, the fewest that hold them all,
so that equal vectors of one length have equal bytes.
"""

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers of a matrix made from one batch, about.
PORTION = 1 << 20
_WIDTHS = (np.dtype("<i2"), np.dtype("<i4"), np.dtype("<i8"))


def finite_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Which rows of a column have finite components only, and these rows as a matrix.

    Each length comes by itself, in matrices of bounded size. Null vectors and those with a
    component that is null or not finite are left out.
    """
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.maximum(lengths, 0))
    for length in np.unique(lengths[lengths >= 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        step = max(1, PORTION // max(length, 1))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            found = flat[ends[part, None] - length + np.arange(length)]
            good = np.isfinite(found).all(axis=1)
            yield part[good], found[good]


def whole_numbers(rows: np.ndarray, scale: int, most: int) -> np.ndarray:
    """``floor(scale * x)`` of each component; what is beyond ``most`` counts as ``most``."""
    return np.clip(np.floor(rows * scale), -float(most), float(most)).astype(np.int64)


def pack(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix of whole numbers as bytes."""
    top = np.abs(rows).max(axis=1) if rows.shape[1] else np.zeros(len(rows), np.int64)
    width = (top >= 1 << 15).astype(int) + (top >= 1 << 31)
    order = np.argsort(width, kind="stable")
    parts = []
    for number, kind in enumerate(_WIDTHS):
        data = rows[order[width[order] == number]].astype(kind).tobytes()
        size = rows.shape[1] * kind.itemsize
        count = int((width == number).sum())
        starts = pa.py_buffer(np.arange(count + 1, dtype=np.int32) * np.int32(size))
        parts.append(
            pa.Array.from_buffers(pa.binary(), count, [None, starts, pa.py_buffer(data)])
        )
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return pa.concat_arrays(parts).take(pa.array(back))


def unpack(column: pa.Array, lengths: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of packed vectors and these as a matrix, each length by itself."""
    column = column.cast(pa.large_binary())
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    lengths = lengths.to_numpy(zero_copy_only=False)
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length)
        step = max(1, PORTION // max(length, 1))
        for at in range(0, len(own), step):
            part = own[at : at + step]
            found = np.zeros((len(part), length), np.int64)
            for kind in _WIDTHS if length else ():
                chosen = sizes[part] == length * kind.itemsize
                if chosen.any():
                    bytes_of = column.take(pa.array(part[chosen]))
                    starts = np.frombuffer(bytes_of.buffers()[1], np.int64)
                    data = np.frombuffer(bytes_of.buffers()[2], np.uint8)
                    data = data[starts[bytes_of.offset] :][: chosen.sum() * length * kind.itemsize]
                    found[chosen] = data.view(kind).reshape(-1, length)
            yield part, found


def packed_vectors(
    vectors: DataFrame,
    scale: int,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    most: int | None = None,
) -> DataFrame:
    """``vec_id``, ``length`` and ``packed``: ``floor(scale * x)`` of the components x as doubles.

    Rows without a vector, or with a component that is null or not finite, are left out. Where
    ``most`` is None it is so large that the inner product of two vectors fits a long.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vector"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in finite_vectors(batch.column("vector")):
                length = found.shape[1]
                limit = most or math.isqrt((1 << 62) // max(length, 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(part)),
                        pa.array(np.full(len(part), length, np.int32)),
                        pack(whole_numbers(found, scale, limit)),
                    ],
                    ["vec_id", "length", "packed"],
                )

    schema = T.StructType([rows.schema["vec_id"]]).add("length", "integer").add("packed", "binary")
    return rows.mapInArrow(packed, schema)


def _long_or_exact(rows: np.ndarray, weights: np.ndarray) -> list[int]:
    """The weighted sum of the rows, without overflow."""
    top = int(np.abs(rows).max(initial=0))
    if top * int(weights.sum()) < 1 << 62:
        return (rows * weights[:, None]).sum(axis=0).tolist()
    return (rows.astype(object) * weights.astype(object)[:, None]).sum(axis=0).tolist()


def vector_sums(vectors: DataFrame, weight: Column) -> dict[int, tuple[int, list[int]]]:
    """For each length the sum of the weights and the weighted sum of the vectors, both exact.

    The driver gets a row for each length and dimension.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            weights = batch.column("weight").to_numpy(zero_copy_only=False)
            for part, found in unpack(batch.column("packed"), batch.column("length")):
                count, total = sums.get(found.shape[1], (0, [0] * found.shape[1]))
                more = _long_or_exact(found, weights[part])
                count += int(weights[part].sum())
                sums[found.shape[1]] = count, [a + b for a, b in zip(total, more, strict=True)]
        for length, (count, total) in sums.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "length": pa.array([length] * (length + 1), pa.int32()),
                    "place": pa.array(range(-1, length), pa.int32()),
                    "total": pa.array([Decimal(x) for x in (count, *total)], pa.decimal128(38, 0)),
                }
            )

    parts = vectors.select("length", "packed", weight.cast("bigint").alias("weight")).mapInArrow(
        partial, "length int, place int, total decimal(38,0)"
    )
    found: dict[int, dict[int, int]] = {}
    for r in parts.groupBy("length", "place").agg(F.sum("total").alias("total")).collect():
        found.setdefault(r["length"], {})[r["place"]] = int(r["total"])
    return {n: (by[-1], [by[i] for i in range(n)]) for n, by in found.items()}


def vector_covariances(
    vectors: DataFrame, weight: Column, sums: dict[int, tuple[int, list[int]]]
) -> dict[int, np.ndarray]:
    """For each length the weighted covariance about the mean that ``sums`` gives.

    Vectors are centred, then multiplied, matrix by matrix in the tasks. These send the upper
    triangles of their sums, and the driver gets one of each length.
    """
    means = vectors.sparkSession.sparkContext.broadcast(
        {n: np.array([s / count for s in total]) for n, (count, total) in sums.items()}
    )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column("weight").to_numpy(zero_copy_only=False).astype(np.float64)
            for part, found in unpack(batch.column("packed"), batch.column("length")):
                centred = found - means.value[found.shape[1]]
                product = (centred * weights[part, None]).T @ centred
                products[found.shape[1]] = products.get(found.shape[1], 0) + product
        for length, product in products.items():
            for row in range(length):
                yield pa.RecordBatch.from_pydict(
                    {
                        "length": pa.array([length], pa.int32()),
                        "row": pa.array([row], pa.int32()),
                        "products": pa.array([product[row, row:]], pa.list_(pa.float64())),
                    }
                )

    parts = vectors.select("length", "packed", weight.cast("bigint").alias("weight")).mapInArrow(
        partial, "length int, row int, products array<double>"
    )
    each = parts.select("length", "row", F.posexplode("products").alias("place", "product"))
    found = {n: np.zeros((n, n)) for n in sums}
    totals = each.groupBy("length", "row", "place").agg(F.sum("product").alias("product"))
    for length, row, place, product in totals.collect():
        matrix = found[length]
        matrix[row, row + place] = matrix[row + place, row] = product / sums[length][0]
    return found
