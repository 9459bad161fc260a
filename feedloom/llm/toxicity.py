"""Toxicity by a subsequence string-kernel SVM with Nyström landmarks.

The kernel of two words counts the triples of letters that both have in the same order, also
with other letters in between; each occurrence weighs less the longer it is. So a word with
letters put in between stays close to the word it hides. Marks within a word and blanks between
single letters are dropped before.

Landmarks are words that tell toxic texts from others, no two of them alike. A text is described
by its words' largest kernel with each landmark; the Nyström map turns these numbers into
features of a linear SVM, whose margin becomes a probability.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import id_bucket, portions, stored, texts_of

#: About so many labelled texts are learned from, chosen by the hash of their ids.
TRAIN_ROWS = 8_000
LANDMARKS = 40
#: Words from which the landmarks are chosen, and how alike two landmarks may be.
CANDIDATES = 500
ALIKE = 0.5
#: A triple spans so many letters at most; each letter it spans multiplies its weight.
SPAN = 6
DECAY = 0.9
#: Kernels are raised to this power, which keeps them kernels.
POWER = 3
#: Score from which a text is predicted to be toxic.
THRESHOLD = 0.3
_LETTERS = 32
_TRIPLES = _LETTERS**3
_CACHED_WORDS = 400_000
#: Fixed value: ASCII marks, neither letters nor digits.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SPACED = re.compile(rb"(?<!\S)\S(?: \S){2,}(?!\S)")


def _words(text: bytes) -> list[bytes]:
    """Words in lower case (ASCII); three or more single characters in a row are one word."""
    text = text.lower()
    if _SPACED.search(text):
        text = _SPACED.sub(lambda m: m.group().replace(b" ", b""), text)
    return text.split()


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all words as small numbers, and the word each belongs to.

    a to z are 0 to 25; other letters share the numbers above. What is no letter is left out.
    """
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    word = np.repeat(np.arange(len(words)), [len(w) for w in words])
    ascii_letter = (points >= 97) & (points <= 122)
    # from U+00C0 on most characters are letters; the few others do no harm
    letter = ascii_letter | ((points >= 0xC0) & (points != 0xD7) & (points != 0xF7))
    codes = np.where(ascii_letter, points - 97, 26 + points % (_LETTERS - 26))
    return codes[letter], word[letter]


def _triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, triple and weight, normalized to length 1 for each word, without repetition."""
    codes, word = _codes(words)
    keys = []
    for last in range(2, SPAN):
        n = len(codes) - last
        if n <= 0:
            break
        within = word[:n] == word[last:]
        ends = codes[:n] * _LETTERS**2 + codes[last:]
        for middle in range(1, last):
            triple = ends + codes[middle : n + middle] * _LETTERS
            keys.append(((word[:n] * _TRIPLES + triple) * 8 + last)[within])
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    keys = np.sort(np.concatenate(keys))
    if not len(keys):
        return keys, keys, np.zeros(0)
    weights = DECAY ** np.arange(8.0)
    named = keys >> 3
    starts = np.flatnonzero(np.diff(named, prepend=-1))
    total = np.add.reduceat(weights[keys & 7], starts)
    of, triple = np.divmod(named[starts], _TRIPLES)
    squares = np.bincount(of, total * total, len(words))
    return of, triple, total / np.sqrt(squares[of])


def _landmark_table(landmarks: list[str]) -> np.ndarray:
    table = np.zeros((_TRIPLES, len(landmarks)), np.float32)
    of, triple, weight = _triples(landmarks)
    table[triple, of] = weight
    return table


def kernels(words: list[str], table: np.ndarray) -> np.ndarray:
    """The kernel of each word with each landmark, from 0 to 1."""
    found = np.zeros((len(words), table.shape[1]), np.float32)
    shared = table.any(axis=1)
    for a in range(0, len(words), 20_000):
        of, triple, weight = _triples(words[a : a + 20_000])
        some = shared[triple]  # few triples are in any landmark
        of, triple, weight = of[some], triple[some], weight[some]
        if len(of):
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            values = table[triple] * weight[:, None].astype(np.float32)
            found[a + of[starts]] = np.add.reduceat(values, starts, axis=0)
    return found**POWER


class _Describer:
    """Turns texts into their largest kernels; remembers the words it has seen."""

    def __init__(self, landmarks: list[str]):
        self.table = _landmark_table(landmarks)
        self.forget()

    def forget(self) -> None:
        # words that differ in marks or case only share a row of values
        self.number: dict[bytes, int] = {}
        self.stems: dict[str, int] = {}
        self.values = np.zeros((0, self.table.shape[1]), np.float32)

    def describe(self, texts: list[bytes]) -> np.ndarray:
        split = [_words(t) for t in texts]
        seen = set().union(*split)
        new = [w for w in seen if w not in self.number]
        if len(self.number) + len(new) > _CACHED_WORDS:
            self.forget()
            new = list(seen)
        stems = [w.decode().lower().strip(_MARKS) for w in new]
        fresh = list(set(stems).difference(self.stems))
        self.stems |= zip(fresh, range(len(self.stems), len(self.stems) + len(fresh)), strict=True)
        self.values = np.concatenate([self.values, kernels(fresh, self.table)])
        self.number |= zip(new, map(self.stems.__getitem__, stems), strict=True)
        sizes = np.array([len(w) for w in split])
        numbers = np.fromiter(
            (n for words in split for n in map(self.number.__getitem__, words)),
            np.int64,
            int(sizes.sum()),
        )
        found = np.zeros((len(texts), self.table.shape[1]), np.float32)
        some = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[some]
        for a in range(0, len(some), 256):  # bounds what is gathered at once
            b = min(a + 256, len(some))
            end = starts[b] if b < len(some) else len(numbers)
            gathered = self.values[numbers[starts[a] : end]]
            found[some[a:b]] = np.maximum.reduceat(gathered, starts[a:b] - starts[a], axis=0)
        return found


def _newton_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0) -> np.ndarray:
    """Weights, the bias last, of a linear SVM with squared hinge loss; y is -1 or 1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(50):
        inside = y * (x @ w) < 1
        part, wanted = x[inside], y[inside]
        updated = np.linalg.solve(
            ridge + 2 * cost * part.T @ part, 2 * cost * part.T @ wanted
        )
        done = np.abs(updated - w).max() < 1e-8
        w = w + (updated - w) * 0.7 if not done else updated
        if done:
            break
    return w


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that turn margins into log-odds; y is 0 or 1."""
    slope, intercept = 1.0, 0.0
    ones = y.sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + intercept, -30, 30)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        h = np.maximum(p * (1 - p), 1e-6)
        a, b, c = (h * margin * margin).sum() + 1e-6, (h * margin).sum(), h.sum() + 1e-6
        det = a * c - b * b
        step = np.array([c * g[0] - b * g[1], a * g[1] - b * g[0]]) / det
        slope, intercept = slope - step[0], intercept - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(intercept)


def _fit(x: np.ndarray, y: np.ndarray, landmarks: list[str]) -> np.ndarray:
    """Weights of the kernels and an intercept that give the log-odds of a text."""
    x = x.astype(np.float64)
    gram = kernels(landmarks, _landmark_table(landmarks)).astype(np.float64)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    nystrom = vectors / np.sqrt(np.maximum(values, 1e-3))
    mapped, signs = x @ nystrom, 2.0 * y - 1
    fold = np.arange(len(y)) % 5
    margin = np.zeros(len(y))
    for k in range(5):  # margins for the probabilities come from texts not learned from
        w = _newton_svm(mapped[fold != k], signs[fold != k])
        margin[fold == k] = mapped[fold == k] @ w[:-1] + w[-1]
    slope, intercept = _platt(margin, y)
    w = _newton_svm(mapped, signs)
    return np.append(slope * (nystrom @ w[:-1]), slope * w[-1] + intercept)


def _choose_landmarks(candidates: list[str]) -> list[str]:
    """The first candidates that are not too much like one chosen before."""
    table = _landmark_table(candidates)
    like = kernels(candidates, table) ** (1 / POWER)
    chosen: list[int] = []
    for i in range(len(candidates)):
        if like[i, i] > 0 and all(like[i, j] <= ALIKE for j in chosen):
            chosen.append(i)
            if len(chosen) == LANDMARKS:
                break
    return [candidates[i] for i in chosen]


def train(sample: DataFrame) -> tuple[list[str], np.ndarray]:
    """Landmarks and weights, the intercept last, from ``id``, ``text``, ``toxic`` of a sample.

    Spark counts in how many texts of each kind a word is. The words whose share in toxic texts
    is furthest above that in others are candidates; a few hundred reach the driver, and so do
    the weights, which one task fits to the descriptions of the sample.
    """

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text"):
                own = [
                    list({w.decode().lower().strip(_MARKS) for w in _words(t)})
                    for t in texts_of(part.column("text"))
                ]
                toxic = np.repeat(part.column("toxic").to_numpy(), [len(w) for w in own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for x in own for w in x], pa.string()), pa.array(toxic)],
                    ["word", "toxic"],
                )

    ones, every = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    base = (ones + 1) / (every + 2)
    if not ones or ones == every:
        return [], np.array([np.log(base / (1 - base))])
    counts = sample.select("text", "toxic").mapInArrow(words, "word string, toxic int")
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("ones"), F.count(F.lit(1)).alias("n"))
    zeros = F.col("n") - F.col("ones")
    odds = F.log((F.col("ones") + 0.5) / (ones + 1)) - F.log((zeros + 0.5) / (every - ones + 1))
    best = (
        counts.where((F.col("ones") >= 3) & (F.length("word") <= 64))
        .withColumn("weight", odds * F.sqrt("ones"))
        .where("weight > 0")
        .orderBy(F.desc("weight"), "word")
        .limit(CANDIDATES)
    )
    landmarks = _choose_landmarks([r["word"] for r in best.select("word").collect()])
    if not landmarks:
        return [], np.array([np.log(base / (1 - base))])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        describer = _Describer(landmarks)
        for batch in batches:
            for part in portions(batch, "text"):
                found = describer.describe(texts_of(part.column("text"))).tolist()
                x = pa.array(found, pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("toxic"), x], ["id", "toxic", "x"]
                )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        if rows:
            rows.sort(key=lambda r: (r["id"], r["toxic"], r["x"]))
            x, y = np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows])
            yield pa.RecordBatch.from_pydict({"w": pa.array(_fit(x, y, landmarks))})

    schema = T.StructType([sample.schema["id"]]).add("toxic", "integer")
    schema = schema.add("x", T.ArrayType(T.FloatType()))
    described = stored(sample.mapInArrow(describe, schema), "toxicity-sample")
    weights = described.coalesce(1).mapInArrow(fit, "w double").collect()
    return landmarks, np.array([r["w"] for r in weights])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str
) -> DataFrame:
    """``id``, ``text`` and ``toxic`` of about ``rows`` texts with a label.

    The labels are sampled first, so that what is broadcast is bounded by ``rows``. If an id has
    several labels the larger counts, and of several texts the smallest, so that no more than the
    sample reaches the one task that fits; null labels and ids are left out.
    """
    labels = labels.where(f"toxic in (0, 1) and {id_col} is not null")
    larger = F.max("toxic").cast("int").alias("toxic")
    labels = labels.groupBy(F.col(id_col).alias("id")).agg(larger)
    labels = labels.where(F.col("id").isNotNull())
    total = labels.count()
    if total > rows:
        chance = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
        labels = labels.where(chance < rows / total)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(labels), "id").groupBy("id", "toxic")
    return stored(joined.agg(F.min("text").alias("text")), "toxicity-texts")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = TRAIN_ROWS,
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    ``labels`` has the ids and ``toxic``, 0 or 1. Rows whose crc32 of the id as text, modulo 4,
    is 2 are held out; the others are learned from if they have a label. The score is the
    probability that a text is toxic; null and empty texts have that of a text without any word
    like a landmark. If all labels are equal, or there are none, every score is their smoothed
    share. Repeated rows are scored each; an empty table gives no rows.
    """
    learnable = labels.where(id_bucket(F.col(id_col), 4).isin(0, 1, 3))
    landmarks, weights = train(labelled_sample(docs, learnable, rows, id_col, text_col))
    judged = docs.select(
        F.col(id_col).alias("doc_id"),
        (id_bucket(F.col(id_col), 4) == 2).alias("held_out"),
        F.col(text_col).alias("text"),
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        describer = _Describer(landmarks)
        for batch in batches:
            for part in portions(batch, "text"):
                odds = np.full(part.num_rows, weights[-1])
                if landmarks:
                    odds = odds + describer.describe(texts_of(part.column("text"))) @ weights[:-1]
                chance = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(chance)],
                    ["doc_id", "held_out", "score"],
                )

    schema = T.StructType([judged.schema["doc_id"]]).add("held_out", "boolean")
    scored = judged.mapInArrow(score, schema.add("score", "double"))
    return scored.select("*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
