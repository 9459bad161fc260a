"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts are gathered by Spark from a bounded sample of labelled rows. What is broadcast is the
matrix of log-probabilities, ``BUCKETS`` rows with a column for each language learned.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import id_bucket, portions

#: About so many labelled rows are learned from, chosen by the hash of their ids.
TRAIN_ROWS = 10_000
#: Lengths of the n-grams, rows of the matrix (a power of two), and what is added to each count.
LENGTHS = (2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.1
UNDETERMINED = "und"
#: The only language where nothing was learned.
UNNAMED = "any"
#: Bytes of text whose n-grams a task has in arrays at a time, about.
_PORTION = 1 << 18


@dataclass(frozen=True)
class LanguageModel:
    """``log_likelihood[bucket, i]`` and ``log_prior[i]`` are those of ``languages[i]``."""

    languages: tuple[str, ...]
    log_likelihood: np.ndarray
    log_prior: np.ndarray


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x10000)), np.bool_, 0x10000)


def _grams(
    texts: list[str], letters: np.ndarray
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts, where those of each text start, and whether it has a letter.

    Case is dropped and all but letters counts as a blank. A text has two blanks before and one
    after; those before the next text, or at the end of all, end its last n-grams, so that these
    do not depend on what comes next.
    """
    before = " " * (max(LENGTHS) - 1)
    padded = [f"{before}{t.lower()} " for t in texts]
    starts = np.cumsum([0, *map(len, padded[:-1])])
    codes = np.frombuffer("".join([*padded, before]).encode("utf-32-le"), np.uint32)
    is_letter = letters[np.minimum(codes, 0xFFFF)]
    for at in np.flatnonzero(codes > 0xFFFF):  # letters beyond the table are rare
        is_letter[at] = chr(codes[at]).isalpha()
    has_letter = np.logical_or.reduceat(is_letter, starts)
    size = len(codes) - len(before)
    codes = np.where(is_letter, codes, np.uint32(32))
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    hashed = []
    mixed = codes * np.uint32(0x9E3779B1)
    gram = mixed.copy()
    for n in range(1, max(LENGTHS) + 1):
        if n > 1:
            gram = gram * np.uint32(0x85EBCA6B)
            gram[: -n + 1] += mixed[n - 1 :]
        if n in LENGTHS:
            whole = ((gram ^ (gram >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> shift
            hashed.append(whole[:size])
    return hashed, starts, has_letter


def train(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    rows: int = TRAIN_ROWS,
) -> LanguageModel:
    """Learns from about ``rows`` of the labelled rows; those with null text or label are left out.

    Which rows are chosen depends on their ids alone, so that it repeats. The n-grams are counted
    in the tasks and added up by Spark; the driver gets a number per language and bucket.
    """
    labelled = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    labelled = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    total = labelled.count()
    if total > rows:
        chance = F.pmod(F.xxhash64(F.col("id")), F.lit(1 << 20)) / (1 << 20)
        labelled = labelled.where(chance < rows / total)
    letters = _letters()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            for part in portions(batch, "text", _PORTION):
                langs = np.array(part.column("lang").to_pylist(), object)
                hashed, starts, _ = _grams(part.column("text").to_pylist(), letters)
                sizes = np.diff(starts, append=len(hashed[0]))
                for lang in set(langs):
                    mine = np.repeat(langs == lang, sizes)
                    counts = sum(np.bincount(h[mine], minlength=BUCKETS) for h in hashed)
                    found[lang] = found.get(lang, 0) + counts
                    texts[lang] = texts.get(lang, 0) + int((langs == lang).sum())
        for lang, counts in found.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * (len(seen) + 1), pa.string()),
                    "bucket": pa.array([*seen.tolist(), -1], pa.int32()),  # -1: number of texts
                    "n": pa.array([*counts[seen].tolist(), texts[lang]], pa.int64()),
                }
            )

    counts = (
        labelled.select("text", "lang")
        .mapInArrow(count, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    return _model(counts)


def _model(counts: pd.DataFrame) -> LanguageModel:
    languages = sorted(counts["lang"].unique())
    table = np.zeros((BUCKETS, len(languages)))
    texts = np.ones(len(languages))
    for i, lang in enumerate(languages):
        mine = counts[counts["lang"] == lang]
        grams = mine[mine["bucket"] >= 0]
        table[grams["bucket"].to_numpy(), i] = grams["n"]
        texts[i] = mine.loc[mine["bucket"] < 0, "n"].iloc[0]
    smoothed = table + SMOOTHING
    return LanguageModel(
        tuple(languages), np.log(smoothed / smoothed.sum(axis=0)), np.log(texts / texts.sum())
    )


def identify(
    docs: DataFrame,
    model: LanguageModel,
    keep: Sequence[str],
    text_col: str = "text",
    within: str | None = None,
) -> DataFrame:
    """The columns ``keep`` of every row, with ``lang_pred`` and ``score``.

    The score is the probability of the language in the model. A text that is null or has no
    letter is ``und`` with score 0; so is every text if nothing was learned. Equally probable
    languages: the first by code point. ``keep`` must not name the two new columns. ``within``
    names a struct of ``keep`` that has the text as its field ``text_col``; the texts are then
    sent to the tasks once and not twice.
    """
    rows = docs.select(*keep)
    if within is None:
        rows = docs.select(*keep, F.col(text_col).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.log_likelihood, model.log_prior)
    )
    letters = _letters()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, log_likelihood, log_prior = shared.value
        names = np.array([*languages, UNDETERMINED], object)
        for batch in batches:
            if within is not None:
                text = batch.column(within).field(text_col)
                batch = pa.RecordBatch.from_arrays([*batch.columns, text], [*keep, "_text"])
            for part in portions(batch, "_text", _PORTION):
                n = part.num_rows
                best, chance = np.full(n, -1), np.zeros(n)
                if languages:
                    texts = [t or "" for t in part.column("_text").to_pylist()]
                    hashed, starts, has_letter = _grams(texts, letters)
                    total = log_prior + sum(
                        np.add.reduceat(log_likelihood[h], starts, axis=0) for h in hashed
                    )
                    odds = np.exp(total - total.max(axis=1, keepdims=True))
                    top = odds.argmax(axis=1)
                    best = np.where(has_letter, top, -1)
                    chance = np.where(has_letter, 1 / odds.sum(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in keep),
                        pa.array(names[best].tolist(), pa.string()),
                        pa.array(chance, pa.float64()),
                    ],
                    [*keep, "lang_pred", "score"],
                )

    schema = T.StructType([rows.schema[c] for c in keep])
    return rows.mapInArrow(score, schema.add("lang_pred", "string").add("score", "double"))


def language_id(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int = TRAIN_ROWS,
) -> DataFrame:
    """The language of every text, learned from two thirds of the rows.

    Columns: ``doc_id``, ``held_out`` (crc32 of the id as text, modulo 3, is 1; these rows are
    not learned from), ``lang_pred``, ``score``; see ``identify``. Rows with a null id are judged
    but not learned from. Repeated rows are judged each. An empty table gives an empty one.
    """
    fold = id_bucket(F.col(id_col), 3)
    model = train(docs.where(fold.isin(0, 2)), text_col, lang_col, id_col, rows)
    judged = docs.select(
        F.col(id_col).alias("doc_id"), (fold == 1).alias("held_out"), F.col(text_col).alias("text")
    )
    return identify(judged, model, ["doc_id", "held_out"])


def determined(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int = TRAIN_ROWS,
) -> DataFrame:
    """The rows of ``docs`` whose text is in some language, with the columns they came with.

    Where nothing was learned, as no row has a label, these are the texts with a letter.
    """
    fold = id_bucket(F.col(id_col), 3)
    model = train(docs.where(fold.isin(0, 2)), text_col, lang_col, id_col, rows)
    if not model.languages:
        model = _model(pd.DataFrame({"lang": [UNNAMED], "bucket": [-1], "n": [1]}))
    row = F.struct(*docs.columns).alias("row")
    if text_col in docs.columns:
        judged = identify(docs.select(row), model, ["row"], text_col, within="row")
    else:  # such as a field of a struct, or a name in another case
        judged = identify(docs.select(row, F.col(text_col).alias("text")), model, ["row"])
    return judged.where(F.col("lang_pred") != UNDETERMINED).select("row.*")
