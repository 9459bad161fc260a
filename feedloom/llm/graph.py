"""Connected components of a graph given as a table of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of all nodes with an edge.

    ``edges`` has two columns of one type, in any order and repetition; loops and nulls say
    nothing. Large and small stars alternate until nothing changes, which takes a number of
    rounds in the logarithm of the longest path. A round shuffles the edges, minima are taken
    before the shuffle, and its result is written to the shared folder. The driver gets a count
    and a check sum only.
    """
    a, b = edges.columns
    proper = edges.where(F.col(a) != F.col(b))
    edges = proper.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).distinct()
    edges = stored(edges, "edges")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _state(edges: DataFrame) -> tuple:
    digest = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(digest)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are joined to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where(F.col("v") > F.col("u"))
    return larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are joined to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m"))
    moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
