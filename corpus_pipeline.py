"""A corpus pipeline: language, exact copies, near copies, mix, packed sequences.

Each stage takes the documents its predecessor kept; the last returns the pieces of sequences.

Spark sends rows to Python in batches of 10,000, which are held several times over outside the
heap. Texts have no common size, so the stages bound these batches by bytes; see ``bound_batches``.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm.common import table
from feedloom.llm.exact_dedup import distinct_documents
from feedloom.llm.jaccard import similar_links
from feedloom.llm.language_id import determined
from feedloom.llm.mixing import mixed_documents
from feedloom.llm.packing import pack
from feedloom.llm.queries import TOKENIZER
from feedloom.llm.simhash_dedup import one_of_each
from feedloom.session import clear_folders, given_folders, new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that Spark sends to Python at once, about; one row at least.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Sets the session's bound on batches, where it has none of its own.

    It stays set, as what a stage returns runs later. No result depends on it.
    """
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, BATCH_BYTES)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language; those that are null or without a letter go."""
    bound_batches(spark)
    return determined(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id."""
    bound_batches(spark)
    return distinct_documents(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near texts, the one with the smallest id.

    Near are fingerprints of operator 7, and sets of 5-word shingles with a similarity of 0.8.
    """
    bound_batches(spark)
    return one_of_each(docs, more=similar_links)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    bound_batches(spark)
    return pack(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("language", language_stage),
    ("exact", exact_stage),
    ("near", near_stage),
    ("mix", mix_stage),
    ("pack", pack_stage),
]

#: SQL has neither the classifier nor the seeded hashes; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written to the shared folder and reread.

    What a stage has written for its own use is removed when its result is there, and that result
    when the next one is.
    """
    docs = table(spark, sf_dir, "documents")
    *inner, (_, last) = STAGES
    since = given_folders()
    for name, stage in inner:
        path = new_folder(spark, f"stage-{name}")
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        clear_folders(spark, since, keep={path})
    return last(spark, docs, sf_dir)
