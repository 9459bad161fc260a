"""Whitening of embeddings with a covariance weighted by multiplicity.

Components become whole numbers, and equal vectors are grouped. The covariance is taken over the
distinct vectors, each with the number of its rows as weight (or with one): they are centred and
multiplied as matrices in the tasks. Each distinct vector is projected on the leading components
once, and the rows are joined to the results.

A vector may be that of a third of all rows. Grouping counts it within the tasks. For the join
its rows are dealt to ``SALTS`` keys, and its result is sent to those keys that have rows.
"""

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import stored
from feedloom.llm.vectors import packed_vectors, unpack, vector_covariances, vector_sums

SCALE = 1024
COMPONENTS = 8
#: Keys that the rows of one vector are dealt to; a mask of them is a long.
SALTS = 64
#: Whole numbers beyond this count as this.
MOST = 1 << 61
_LONG = (1 << 63) - 1
RESULT = (
    "component int, n bigint, deviation bigint, whitened double, explained double, "
    "identity_error double, deviation_wide decimal(38,0)"
)


class _Model:
    """What the vectors of one length are whitened with."""

    def __init__(self, count: int, total: list[int], covariance: np.ndarray, components: int):
        self.count, self.total = count, total
        self.mean = np.array([s / count for s in total])
        values, vectors = np.linalg.eigh(covariance)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        top = np.abs(vectors).argmax(axis=0)
        vectors = vectors * np.sign(vectors[top, np.arange(vectors.shape[1])])
        trace = float(np.trace(covariance))
        values = np.maximum(values, 0.0)
        self.explained = (values / trace if trace > 0 else values * 0.0).tolist()
        some = values > len(covariance) * np.finfo(float).eps * max(trace, 0.0)
        root = np.sqrt(np.where(some, values, 1.0))
        self.projection = np.where(some, vectors / root, 0.0)

    def deviations(self, rows: np.ndarray) -> list[int]:
        """The exact sum of ``(n * x - S) ** 2`` over the dimensions of each row."""
        reach = max(int(np.abs(rows).max(initial=0)) * self.count, *map(abs, self.total))
        if reach < 1 << 62:
            apart = rows * self.count - np.array(self.total, np.int64)
            if int(np.abs(apart).max(initial=0)) ** 2 * rows.shape[1] <= _LONG:
                return (apart * apart).sum(axis=1).tolist()
            apart = apart.astype(object)
        else:
            apart = rows.astype(object) * self.count - np.array(self.total, object)
        return (apart * apart).sum(axis=1).tolist()


def _digest():
    return F.unhex(F.sha2("packed", 256))


def _whitened(distinct: DataFrame, models) -> DataFrame:
    """Each distinct vector's key with its whitened components ``z`` and its deviation."""

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in unpack(batch.column("packed"), batch.column("length")):
                model = models.value[found.shape[1]]
                z = (found - model.mean) @ model.projection
                deviation = model.deviations(found)
                flat = pa.array(z.reshape(-1))
                ends = pa.array(np.arange(len(part) + 1, dtype=np.int32) * z.shape[1], pa.int32())
                wide = [None if x <= _LONG else Decimal(x) for x in deviation]
                chosen = batch.take(pa.array(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(chosen.column(c) for c in ("length", "digest", "salts", "weight")),
                        pa.ListArray.from_arrays(ends, flat),
                        pa.array([x if x <= _LONG else None for x in deviation], pa.int64()),
                        pa.array(wide, pa.decimal128(38, 0)),
                    ],
                    ["length", "digest", "salts", "weight", "z", "deviation", "deviation_wide"],
                )

    keyed = distinct.select("length", _digest().alias("digest"), "salts", "weight", "packed")
    return keyed.mapInArrow(
        whiten,
        "length int, digest binary, salts bigint, weight bigint, z array<double>, "
        "deviation bigint, deviation_wide decimal(38,0)",
    )


def _identity_error(whitened: DataFrame, counts: dict[int, int]) -> float:
    """The largest entry of the covariance of ``z`` less the identity, over all lengths."""
    weight = F.col("weight").cast("double")
    sums = whitened.select("length", "weight", F.posexplode("z").alias("i", "x"))
    means = sums.groupBy("length", "i").agg(F.sum(weight * F.col("x")).alias("total"))
    mean = {(r["length"], r["i"]): r["total"] / counts[r["length"]] for r in means.collect()}
    worst = 0.0
    for length, count in counts.items():
        k = sum(n == length for n, _ in mean)
        z = [F.col("z")[i] - F.lit(mean[length, i]) for i in range(k)]
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        totals = [F.sum(weight * z[i] * z[j]).alias(f"p{i}_{j}") for i, j in pairs]
        found = whitened.where(F.col("length") == length).agg(*totals).first()
        apart = [abs(t / count - (i == j)) for t, (i, j) in zip(found, pairs, strict=True)]
        worst = max(worst, *apart)
    return worst


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    by_count: bool = True,
) -> DataFrame:
    """A row for each row of ``vectors`` that takes part and each of the leading components.

    A component c of a vector is the whole number ``x = floor(scale * c)``; a number added to
    every x, such as 100,000, would change no column, so none is. Columns:
    ``vec_id``; ``component`` from 1, by falling eigenvalue of the covariance of x; ``n``, the
    number of vectors in the fit; ``deviation``, the sum over the dimensions of ``(n * x - S)``
    squared with the sums ``S``, exact; ``whitened``; ``explained``, the eigenvalue's share of the
    trace; ``identity_error``, how far the covariance of what is whitened is from the identity
    in its worst entry. With ``by_count`` every row counts in the fit, without it every distinct
    vector once.

    Rows whose vector is null, or has a component that is null or not finite, are left out.
    Repeated rows and rows with a null id have rows of their own. Vectors of each length are
    whitened by themselves; ``identity_error`` is the worst of all. Empty vectors have no
    components and hence no rows. A component of the fit without variance has ``whitened`` 0.
    A deviation that no long can hold is null and stands in ``deviation_wide``, null otherwise.
    Whole numbers beyond 2 ** 61 count as that. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = packed_vectors(vectors, scale, id_col, vec_col, MOST).where("length > 0")
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), salt)
    weight = F.count(F.lit(1)) if by_count else F.lit(1).cast("bigint")
    grouped = rows.groupBy("length", "packed").agg(
        weight.alias("weight"), F.bit_or(mask).alias("salts")
    )
    distinct = stored(grouped, "whiten-distinct")
    sums = vector_sums(distinct, F.col("weight"))
    schema = T.StructType([rows.schema["vec_id"], *T.StructType.fromDDL(RESULT).fields])
    if not sums:
        return spark.createDataFrame([], schema)
    covariances = vector_covariances(distinct, F.col("weight"), sums)
    models = {
        length: _Model(count, total, covariances[length], components)
        for length, (count, total) in sums.items()
    }
    whitened = stored(_whitened(distinct, spark.sparkContext.broadcast(models)), "whitened")
    error = _identity_error(whitened, {length: m.count for length, m in models.items()})

    present = F.filter(
        F.sequence(F.lit(0), F.lit(SALTS - 1)),
        lambda s: F.getbit(F.col("salts"), s) == 1,
    )
    copies = whitened.select(
        "length", "digest", F.explode(present).alias("salt"), "z", "deviation", "deviation_wide"
    )
    keyed = rows.select("vec_id", "length", _digest().alias("digest"), salt.alias("salt"))
    joined = keyed.join(copies, ["length", "digest", "salt"])
    each = joined.select(
        "vec_id", "length", "deviation", "deviation_wide", F.posexplode("z").alias("i", "whitened")
    )

    def of_length(value):
        cases = F
        for length, model in sorted(models.items()):
            cases = cases.when(F.col("length") == length, value(model))
        return cases

    explained = of_length(lambda m: F.array(*(F.lit(x) for x in m.explained)))
    return each.select(
        "vec_id",
        (F.col("i") + 1).cast("int").alias("component"),
        of_length(lambda m: F.lit(m.count).cast("bigint")).alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("i")).alias("explained"),
        F.lit(error).alias("identity_error"),
        "deviation_wide",
    )
