"""SimHash near-dedup with an inverted index of bytes at their positions.

Fingerprints of 8 bytes with at most 2 differing bits share at least 6 bytes in place. Of four
pairs of neighbouring bytes, two at least are then whole; so a fingerprint is posted under each
choice of two pairs, and two fingerprints that are near meet under one of them. For pairs that
meet, the shared bytes are tallied, those with 6 are kept, and the bits are compared.

A posting list with more than ``LIST`` fingerprints would give too many pairs. Its members are
posted instead under every value within one bit of theirs: near fingerprints meet there, those
that meet are near, and at most 65 meet in one place.
"""

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import among, portions, stored, texts_of
from feedloom.llm.graph import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
SHARED_BYTES = 8 - MAX_BITS
#: Posting lists up to this length are compared pair by pair.
LIST = 32
_PORTION = 1 << 20


def _shingle_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    words = text.lower().split()  # both know ASCII only
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    last = max(len(words) - shingle + 1, 1)
    first_ends = ends[-last:]
    digest = xxhash.xxh64_intdigest
    return [
        digest(joined[a:b], SEED)
        for a, b in zip(starts[:last].tolist(), first_ends.tolist(), strict=True)
    ]


def _simhash(hashes: list[list[int]]) -> np.ndarray:
    """A fingerprint for each list: a bit is set if it is set in over half of its hashes."""
    counts = np.array([len(h) for h in hashes])
    found = np.zeros((len(hashes), 8), np.uint8)
    some = np.flatnonzero(counts)
    if len(some):
        every = np.array([x for h in hashes for x in h], ">u8")
        bits = np.unpackbits(every.view(np.uint8).reshape(-1, 8), axis=1)
        starts = np.cumsum(counts[some]) - counts[some]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        found[some] = np.packbits(ones * 2 > counts[some, None], axis=1)
    return found.reshape(-1).view(">i8").astype(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fp``, the SimHash of the 3-word shingles of every text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text", _PORTION):
                found = _simhash([_shingle_hashes(t) for t in texts_of(part.column("text"))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"]
                )

    return rows.mapInArrow(fingerprint, T.StructType([rows.schema["doc_id"]]).add("fp", "long"))


def _byte_pair(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 48 - 16 * i).bitwiseAND(0xFFFF)


def postings(classes: DataFrame) -> DataFrame:
    """Each fingerprint under its six choices of two byte pairs: ``place``, ``bytes``, ``fp``."""
    fp = F.col("fp")
    keys = [
        F.struct(
            F.lit(k).alias("place"),
            F.shiftleft(_byte_pair(fp, i), 16).bitwiseOR(_byte_pair(fp, j)).alias("bytes"),
        )
        for k, (i, j) in enumerate(combinations(range(4), 2))
    ]
    return classes.select(F.explode(F.array(*keys)).alias("key"), "fp", "node").select(
        "key.place", "key.bytes", "fp", "node"
    )


def near_links(classes: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between nodes whose fingerprints are near, enough to connect all such.

    ``classes`` has a row per distinct fingerprint, ``fp`` and ``node``.
    """
    posted = postings(classes)
    lists = posted.groupBy("place", "bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    posted = stored(posted.join(lists, ["place", "bytes"]), "postings")

    short = posted.where(F.col("n") <= LIST)
    left = short.select("place", "bytes", F.col("fp").alias("x"), F.col("node").alias("a"))
    right = short.select("place", "bytes", F.col("fp").alias("y"), F.col("node").alias("b"))
    differ = F.col("x").bitwiseXOR(F.col("y"))
    shared = sum(
        (F.shiftrightunsigned(differ, 8 * i).bitwiseAND(0xFF) == 0).cast("int") for i in range(8)
    )
    pairs = left.join(right, ["place", "bytes"]).where(F.col("x") < F.col("y"))
    pairs = pairs.where(shared >= SHARED_BYTES).where(F.bit_count(differ) <= MAX_BITS)

    crowded = posted.where(F.col("n") > LIST).select("fp", "node").distinct()
    flips = [F.lit(0).cast("bigint"), *(F.lit(1 << i) for i in range(63)), F.lit(-(1 << 63))]
    around = crowded.select(
        F.explode(F.transform(F.array(*flips), lambda bit: F.col("fp").bitwiseXOR(bit))).alias("z"),
        "node",
    )
    least = F.min("node").over(Window.partitionBy("z"))
    stars = around.select(F.col("node").alias("a"), least.alias("b")).where("a != b").distinct()
    return pairs.select("a", "b").unionByName(stars)


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every row, see ``simhash_dedup``."""
    rows = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    named = rows.where(F.col("doc_id").isNotNull())
    classes = stored(named.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    # an id on rows with several fingerprints connects these
    several = named.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y"))
    several = several.where("x != y").select("doc_id")
    same = named.join(several, "doc_id").join(classes, "fp").select(
        F.col("doc_id").alias("a"), F.col("node").alias("b")
    )
    found = components(near_links(classes).unionByName(same))
    of_class = classes.join(found, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component_id")
    )
    unnamed = rows.where(F.col("doc_id").isNull()).withColumn(
        "component_id", F.lit(None).cast(rows.schema["doc_id"].dataType)
    )
    return named.join(of_class, "fp").select("doc_id", "fp", "component_id").unionByName(unnamed)


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``fingerprint``, ``component_id``.

    Texts are lower-cased in A-Z and cut into words at ASCII white space. A text with fewer than
    three words has one shingle, one without words (or null) the fingerprint zero, which is
    linked like any other. The rows of one id count as one document, also if their texts differ.
    Rows with a null id are not linked and have a null component. Empty table: no rows.
    """
    return linked(docs, id_col, text_col).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    more: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The document with the smallest id of each component, with the columns it came with.

    ``more`` gives further links ``a``, ``b`` between rows ``node``, ``text``, which join the
    components of ``linked``. Rows with a null id stay, as nothing is linked to them. Rows of one
    id are linked by their texts only; of rows with one id and near texts one stays.
    """
    row = F.struct(*docs.columns).alias("row")
    numbered = stored(docs.select(row, F.monotonically_increasing_id().alias("node")), "numbered")
    row_id = F.col("row").getField(id_col)
    named = numbered.where(row_id.isNotNull())
    rows = named.select("node", F.col("row").getField(text_col).alias("text"))
    found = linked(rows, "node", "text").select("doc_id", "component_id")
    if more is not None:
        found = _joined(stored(found, "linked"), more(rows))
    ids = named.select(F.col("node").alias("doc_id"), row_id.alias("id"))
    first = F.min(F.struct("id", F.col("doc_id").alias("node"))).alias("first")
    stay = found.join(ids, "doc_id").groupBy("component_id").agg(first).select("first.node")
    stayed = among(numbered, stay).select("row.*")
    return stayed.unionByName(numbered.where(row_id.isNull()).select("row.*"))


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` with components joined where a link runs between two of them."""
    of_a = found.select(F.col("doc_id").alias("a"), F.col("component_id").alias("u"))
    of_b = found.select(F.col("doc_id").alias("b"), F.col("component_id").alias("v"))
    between = components(links.join(of_a, "a").join(of_b, "b").select("u", "v"))
    between = between.select(F.col("node").alias("component_id"), "component")
    return found.join(between, "component_id", "left").select(
        "doc_id", F.coalesce("component", "component_id").alias("component_id")
    )
