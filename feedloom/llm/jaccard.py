"""Links between texts whose sets of word shingles have at least a given Jaccard similarity.

Sets are brought down to smallest hashes (MinHash), which are joined to bands. Two texts that
agree in a band are candidates; what a candidate pair has in common is then counted in the sets
themselves. A pair at 0.8 misses all bands with a chance of 1 in 2,800.

A band value with more than ``LIST`` texts would give too many pairs. Its texts are first compared
with the least of them. Those that are similar to it are linked already and need not be compared
with each other. The others are compared with all: the list is dealt into blocks, and each two
blocks meet in one task, which counts what the sets have in common and gives no more links than
connect its texts. So no similar pair of a list is left unconnected, and no list gives all its
pairs. The work grows with the length of the list times the number of those others.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import among, portions, stored, texts_of
from feedloom.llm.simhash_dedup import _shingle_hashes

SHINGLE = 5
LEAST = 0.8
BANDS = 20
ROWS = 5
#: Texts of one band value up to this number are compared pair by pair.
LIST = 8
#: Texts of a block, and shingles of all of them, about.
BLOCK = 256
BLOCK_SHINGLES = 1 << 18
_SEED = 5
_PORTION = 1 << 20


def _band_values(hashes: list[list[int]]) -> np.ndarray:
    """A row of ``BANDS`` values for each list."""
    rng = np.random.default_rng(_SEED)
    flips = rng.integers(0, 1 << 64, (BANDS, ROWS), np.uint64)
    factors = rng.integers(0, 1 << 64, (BANDS, ROWS), np.uint64) | np.uint64(1)
    counts = np.array([len(h) for h in hashes])
    values = np.zeros((len(hashes), BANDS), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        every = np.array([x for h in hashes for x in h], np.uint64)
        starts = np.cumsum(counts[some]) - counts[some]
        for band in range(BANDS):
            value = np.full(len(some), band + 1, np.uint64)
            for flip, factor in zip(flips[band], factors[band], strict=True):
                least = np.minimum.reduceat((every ^ flip) * factor, starts)
                value = (value ^ least) * np.uint64(0x9E3779B97F4A7C15)
                value ^= value >> np.uint64(29)
            values[some, band] = value
    return values.view(np.int64)


def _of_texts(docs: DataFrame, name: str, shingle: int, use) -> DataFrame:
    """``node`` and the array of numbers that ``use`` makes of the shingle hashes of its text."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text", _PORTION):
                found = use([_shingle_hashes(t, shingle) for t in texts_of(part.column("text"))])
                column = pa.array(found, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("node"), column], ["node", name])

    schema = T.StructType([docs.schema["node"]]).add(name, T.ArrayType(T.LongType()))
    return docs.select("node", "text").mapInArrow(made, schema)


def _sets(hashes: list[list[int]]) -> list[np.ndarray]:
    return [np.unique(np.array(h, np.uint64)).view(np.int64) for h in hashes]


def shared_bands(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``key``, ``node``, ``n``, ``least``: the band values that several nodes have.

    ``n`` is their number and ``least`` the smallest of them.
    """
    bands = _of_texts(docs, "bands", shingle, lambda h: list(_band_values(h)))
    posted = stored(bands.select("node", F.explode("bands").alias("key")), "bands")
    lists = posted.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("least")
    )
    return stored(posted.join(lists.where("n > 1"), "key"), "shared-bands")


def candidates(shared: DataFrame) -> DataFrame:
    """Pairs ``a`` > ``b``: all of short lists, and each node of a long list with its least."""
    short = shared.where(F.col("n") <= LIST)
    left = short.select("key", F.col("node").alias("a"))
    right = short.select("key", F.col("node").alias("b"))
    every = left.join(right, "key").where(F.col("a") > F.col("b")).select("a", "b")
    long = shared.where(F.col("n") > LIST).select(
        F.col("node").alias("a"), F.col("least").alias("b")
    )
    return every.unionByName(long.where("a != b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    total = F.size("x") + F.size("y") - common
    return both.where(common >= least * total).select("a", "b")


def block_links(
    nodes: np.ndarray,
    linked: np.ndarray,
    sizes: np.ndarray,
    shingles: np.ndarray,
    split: int,
    least: float,
) -> Iterator[tuple[int, int]]:
    """Links that connect what is similar between the first ``split`` texts and the others.

    With 0 all are compared with all. ``linked`` are known to be connected, and nothing is
    compared that is connected already. ``shingles`` has the sets one after the other.
    """
    every, shingle = np.unique(shingles, return_inverse=True)
    begins = np.cumsum(sizes) - sizes
    some = sizes > 0
    place = np.arange(len(nodes))
    group = np.where(linked, -1, place)
    marked = np.zeros(len(every), bool)
    for at in range(split or len(nodes)):
        apart = (group != group[at]) & some & (place >= (split or at))
        if not some[at] or not apart.any():
            continue
        own = shingle[begins[at] : begins[at] + sizes[at]]
        marked[own] = True
        common = np.zeros(len(nodes), np.int64)
        common[some] = np.add.reduceat(marked[shingle], begins[some], dtype=np.int64)
        marked[own] = False
        total = sizes[at] + sizes - common
        for other in np.flatnonzero(apart & (common >= least * total)).tolist():
            if group[other] != group[at]:
                group[group == group[other]] = group[at]
                yield nodes[at], nodes[other]


def crowded_links(
    shared: DataFrame, linked: DataFrame, sets: DataFrame, least: float
) -> DataFrame:
    """Links of texts in long lists beyond those to the least of the list, ``linked``."""
    long = shared.where(F.col("n") > LIST)
    to_least = linked.select(F.col("a").alias("node"), F.col("b").alias("least"))
    to_least = to_least.distinct().withColumn("_linked", F.lit(True))
    known = long.join(to_least, ["node", "least"], "left").select(
        "key",
        "node",
        (F.col("_linked").isNotNull() | (F.col("node") == F.col("least"))).alias("linked"),
    )
    known = stored(known, "crowded")
    sized = known.join(sets.select("node", F.size("set").alias("size")), "node")

    def blocks(rows: Column) -> Column:
        texts = F.count_if(rows)
        shingles = F.sum(F.when(rows, F.col("size")).otherwise(0))
        number = F.ceil(F.greatest(texts / BLOCK, shingles / BLOCK_SHINGLES))
        return F.least(number, texts).cast("int")

    mixed = sized.groupBy("key").agg(
        blocks(F.col("linked")).alias("of_linked"), blocks(~F.col("linked")).alias("of_others")
    )
    mixed = stored(mixed.where("of_others > 0"), "crowded-lists")
    # the blocks of others come first, then those of what is linked; two blocks of these last
    # need not meet
    count = F.when(F.col("linked"), F.col("of_linked")).otherwise(F.col("of_others"))
    own = F.pmod(F.xxhash64("node"), count).cast("int")
    own = F.when(F.col("linked"), own + F.col("of_others")).otherwise(own)
    last = F.when(F.col("linked"), F.col("of_others")).otherwise(
        F.col("of_others") + F.col("of_linked")
    )
    dealt = known.join(mixed, "key").select(
        "key",
        "node",
        "linked",
        own.alias("own"),
        F.explode(F.sequence(F.lit(0), last - 1)).alias("other"),
    )
    met = dealt.select(
        "key", "node", "linked", (F.col("own") <= F.col("other")).alias("first"),
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
    )
    posted = met.join(sets, "node")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("first", "descending"), ("node", "ascending")]).combine_chunks()
        within = table["low"][0].as_py() == table["high"][0].as_py()
        lists = table["set"].combine_chunks()
        found = list(
            block_links(
                table["node"].to_numpy(),
                table["linked"].to_numpy(),
                pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64),
                lists.flatten().to_numpy(zero_copy_only=False),
                0 if within else pc.sum(table["first"]).as_py(),
                least,
            )
        )
        return pa.table([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return posted.groupBy("key", "low", "high").applyInArrow(compare, "a bigint, b bigint")


def similar_links(docs: DataFrame, least: float = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """Links ``a``, ``b`` between nodes whose sets of shingles have the similarity ``least`` or more.

    They connect all such pairs that agree in a band. ``docs`` has ``node``, a long and
    another one for each row, and ``text``, of which words are taken as in ``simhash_dedup``; a text with fewer words
    than a shingle has one, one without words none and no links. Null nodes are left out.
    """
    docs = docs.where(F.col("node").isNotNull())
    shared = shared_bands(docs, shingle)
    sets = stored(_of_texts(among(docs, shared), "set", shingle, _sets), "sets")
    links = stored(_verified(candidates(shared), sets, least), "similar")
    if shared.where(F.col("n") > LIST).isEmpty():
        return links
    return links.unionByName(crowded_links(shared, links, sets, least))
