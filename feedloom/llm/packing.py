"""Packing token sequences by cutting-stock column generation.

Documents are cut into full sequences and a remainder. A linear program over the histogram of
the lengths finds which patterns of lengths fill sequences, and how often each is used: columns
are priced by dynamic programming over a knapsack of one sequence. The program has a row for
each length class, ``SEQUENCE / WIDTH`` at most, whatever the number of documents; it is what
the driver solves. The pieces are ranked within their length class by Spark, and from its rank
alone a piece knows its sequence.
"""

import math
import os
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import portions, stored

SEQUENCE = 2048
#: Lengths are rounded up to classes of this width for the linear program.
WIDTH = 8
#: How far from the least number of sequences the program may stop.
GAP = 0.002
#: Closes each document.
END_ID = 1
#: Pieces of one length class that are ranked by one task, about.
RANKED = 2_000
_CACHED_WORDS = 500_000
#: Bytes of text whose words and ids a task has in arrays at a time, about.
_PORTION = 1 << 20
#: Fixed value: ASCII marks, neither letters nor digits.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Characters below U+0250 without U+0130, which has two in lower case.
_PLAIN = r"^[\x{0}-\x{12F}\x{131}-\x{24F}]+$"


def token_pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The pieces of every document: full sequences and a remainder.

    ``tokenizer`` is the path of the file on every machine. No token of it crosses ASCII white
    space, so that words are looked up and each new one is tokenized once in a task; a task
    forgets its words when they are too many. A null text is empty and has the closing id only.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col(text_col).alias("text"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        words = _Words(Tokenizer.from_file(tokenizer))
        for batch in batches:
            for part in portions(batch, "text", _PORTION):
                ids, ends = words.ids_of(part.column("text"))
                total = np.diff(ends, prepend=0)
                pieces = -(-total // SEQUENCE)
                of_row = np.repeat(np.arange(len(total)), pieces)
                nth = np.arange(len(of_row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth * SEQUENCE
                length = np.minimum(total[of_row] - start, SEQUENCE)
                begin = (ends - total)[of_row] + start
                crc = [
                    zlib.crc32(ids[x:y])
                    for x, y in zip(begin.tolist(), (begin + length).tolist(), strict=True)
                ]
                rows_of = pa.array(of_row)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(rows_of),
                        part.column("row").take(rows_of),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc, total[of_row])),
                    ],
                    ["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens"],
                )

    schema = T.StructType([rows.schema["doc_id"], rows.schema["row"]])
    for name in ("start", "length", "ids_crc32", "doc_tokens"):
        schema = schema.add(name, "long")
    return rows.mapInArrow(cut, schema)


def _gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` one after the other."""
    shift = starts - (np.cumsum(lengths) - lengths)
    return pool[np.arange(int(lengths.sum())) + np.repeat(shift, lengths)]


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


class _Words:
    """The ids of whole texts, by way of the ids of their words.

    Most words are a run of letters with some marks after it, which the tokenizer takes apart
    too. Such a stem, in lower case as the tokenizer has it, and its marks are looked up each, and
    new stems are tokenized many in one text. Words with letters from U+0250 on, or with anything
    else in them, are given to the tokenizer as they are. What has been tokenized is a stretch of
    ``pool``, found by its number.
    """

    def __init__(self, encoder):
        self.encoder = encoder
        # which ids end a run of letters
        self.closing = np.zeros(encoder.get_vocab_size(), np.bool_)
        self.closing[[i for t, i in encoder.get_vocab().items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        # number 0 is the empty word, number 1 the end of a document
        self.number = {"": 0}
        self.pool = np.array([END_ID], "<u4")
        self.starts, self.lengths = np.array([0, 0]), np.array([0, 1])

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the closing one, and where each text ends in them."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.ascii_split_whitespace(texts)
        found = split.flatten().dictionary_encode()
        first, second = self._numbers(found.dictionary)
        # the ids of each different word, and those of the end as a word after them
        halves = np.append(np.column_stack([first, second]).ravel(), [1, 0])
        pool = _gathered(self.pool, self.starts[halves], self.lengths[halves])
        lengths = self.lengths[halves].reshape(-1, 2).sum(axis=1)
        starts = np.cumsum(lengths) - lengths
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        last = np.cumsum(counts)
        words = np.insert(found.indices.to_numpy().astype(np.int64), last, len(lengths) - 1)
        each = lengths[words]
        ids = _gathered(pool, starts[words], each)
        return ids, np.cumsum(each)[last + np.arange(len(last))]

    def _numbers(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the stem, or of the whole word, and of the marks after a stem."""
        stems = pc.utf8_rtrim(words, characters=_MARKS)
        plain = pc.and_(pc.utf8_is_alpha(stems), pc.match_substring_regex(stems, _PLAIN))
        heads = pc.if_else(plain, pc.utf8_lower(stems), words).dictionary_encode()
        marked = pc.and_(plain, pc.not_equal(pc.binary_length(words), pc.binary_length(stems)))
        marked = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        tails = [
            word[stem:]
            for word, stem in zip(
                _strings(words.take(marked)),
                pc.utf8_length(stems.take(marked)).to_numpy().tolist(),
                strict=True,
            )
        ]
        keys = heads.dictionary
        if len(self.number) + len(keys) > _CACHED_WORDS:
            self.forget()
        first = self._known(_strings(keys))
        new = first < 0
        if new.any():
            # a plain head is never another word as it is
            lower = np.zeros(len(keys), np.bool_)
            lower[heads.indices.filter(plain).to_numpy()] = True
            self._learn_stems(_strings(keys.filter(pa.array(new & lower))))
            self._learn(_strings(keys.filter(pa.array(new & ~lower))))
            first[new] = self._known(_strings(keys.filter(pa.array(new))))
        self._learn([t for t in dict.fromkeys(tails) if t not in self.number])
        second = np.zeros(len(words), np.int64)
        second[marked] = self._known(tails)
        return first[heads.indices.to_numpy()], second

    def _known(self, words: list[str]) -> np.ndarray:
        """The number of each word, -1 for what has not been tokenized."""
        return np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))

    def _learn_stems(self, new: list[str]) -> None:
        lines = [" ".join(new[at : at + 256]) for at in range(0, len(new), 256)]
        encoded = self.encoder.encode_batch_fast(lines, add_special_tokens=False)
        if encoded:
            ids = np.concatenate([np.array(e.ids, "<u4") for e in encoded])
            self._add(new, ids, np.diff(np.flatnonzero(self.closing[ids]), prepend=-1))

    def _learn(self, new: list[str]) -> None:
        found = [e.ids for e in self.encoder.encode_batch_fast(new, add_special_tokens=False)]
        ids = np.array([i for x in found for i in x], "<u4")
        self._add(new, ids, np.array([len(x) for x in found], np.int64))

    def _add(self, keys: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        at = len(self.lengths)
        self.number |= zip(keys, range(at, at + len(lengths)), strict=True)
        starts = len(self.pool) + np.cumsum(lengths) - lengths
        self.pool = np.concatenate([self.pool, ids])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of items that fits into ``capacity``: its value and counts."""
    # sizes ascend: those that fit are a prefix
    best = np.zeros(capacity + 1)
    item = np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right").tolist()
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        n = fitting[c]
        if n:
            options = best[c - sizes[:n]] + values[:n]
            top = int(options.argmax())
            if options[top] > best[c] + 1e-12:
                best[c], item[c] = options[top], top
    counts = np.zeros(len(sizes), np.int64)
    c = capacity
    while c > 0:
        if item[c] < 0:
            c -= 1
        else:
            counts[item[c]] += 1
            c -= int(sizes[item[c]])
    return float(best[capacity]), counts


def column_generation(
    sizes: np.ndarray, demand: np.ndarray, capacity: int
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one a column) and how often to use each, fractional, for the least sequences.

    Revised simplex from the patterns of one size each. A column enters while the knapsack finds
    one worth more than a sequence by over ``GAP``: then the least number of sequences is below
    the one reached by that share at most. Rounds are limited in proportion to the sizes; what
    has been reached then fills the demand too, with somewhat more sequences.
    """
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(np.float64)
    inverse = np.diag(1.0 / (capacity // sizes))
    for _ in range(12 * m):
        use = inverse @ demand
        value, pattern = best_pattern(inverse.sum(axis=0), sizes, capacity)
        if value <= 1 + GAP:
            break
        along = inverse @ pattern
        used = along > 1e-9
        ratios = np.where(used, np.maximum(use, 0) / np.where(used, along, 1), np.inf)
        out = int(ratios.argmin())
        if not np.isfinite(ratios[out]):
            break
        basis[:, out] = pattern
        row = inverse[out] / along[out]
        inverse -= np.outer(along, row)
        inverse[out] = row
    return basis.astype(np.int64), np.maximum(inverse @ demand, 0)


def packing_plan(
    sizes: np.ndarray, demand: np.ndarray, capacity: int
) -> list[tuple[int, np.ndarray]]:
    """Patterns as ``(times, counts)`` that hold exactly ``demand[i]`` items of ``sizes[i]``.

    The program's patterns are used as often as their whole part says. What is left, less than
    one use of each, is packed largest first.
    """
    if not len(sizes):
        return []
    patterns, use = column_generation(sizes, demand.astype(np.float64), capacity)
    left = demand.copy()
    plan = []
    for j in np.argsort(-use, kind="stable"):
        counts = patterns[:, j]
        filled = counts > 0
        # rounding errors of the program must not use more than there is
        times = min(int(math.floor(use[j] + 1e-6)), int((left[filled] // counts[filled]).min()))
        if times > 0:
            plan.append((times, counts))
            left = left - times * counts
    order = np.argsort(-sizes)
    while left.any():
        room, counts = capacity, np.zeros(len(sizes), np.int64)
        for i in order:
            n = min(int(left[i]), room // int(sizes[i]))
            counts[i] = n
            room -= n * int(sizes[i])
        filled = counts > 0
        times = int((left[filled] // counts[filled]).min())
        plan.append((times, counts))
        left = left - times * counts
    return plan


def _slots(sizes: np.ndarray, plan: list[tuple[int, np.ndarray]]) -> dict[str, np.ndarray]:
    """Runs of ranks in each class that one pattern takes, ordered by class and first rank."""
    runs, base = [], 0
    taken = np.zeros(len(sizes), np.int64)
    for times, counts in plan:
        slot = 0
        for i in np.flatnonzero(counts):
            runs.append((int(sizes[i]), int(taken[i]), int(counts[i]), base, slot))
            taken[i] += times * counts[i]
            slot += int(counts[i])
        base += times
    columns = np.array(sorted(runs), np.int64).reshape(-1, 5).T
    return dict(zip(("class", "first", "each", "sequence", "slot"), columns, strict=True))


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each piece of a document, with its sequence and its place there.

    Columns: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset``. Every row of ``docs`` is a document of its own, with a null id or a repeated one
    too; null texts are empty. Sequences are numbered from 0. An empty table gives no rows.
    """
    pieces = token_pieces(docs, tokenizer, id_col, text_col)
    pieces = pieces.withColumn("class", F.ceil(F.col("length") / WIDTH).cast("int"))
    pieces = stored(pieces, "pieces")
    histogram = sorted(map(tuple, pieces.groupBy("class").count().collect()))
    sizes, demand = np.array(histogram, np.int64).reshape(-1, 2).T
    runs = _slots(sizes, packing_plan(sizes, demand, SEQUENCE // WIDTH))

    # a class of many pieces has parts in proportion to them
    parts = np.ones(SEQUENCE // WIDTH + 1, np.int64)
    parts[sizes] = -(-demand // RANKED)
    parts_of = F.element_at(F.lit(parts.tolist()), F.col("class") + 1)
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("row", "start"), parts_of))
    group = Window.partitionBy("class", "part").orderBy("row", "start")
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = pieces.groupBy("class", "part").agg(F.count(F.lit(1)).alias("n"))
    bases = bases.select(
        "class", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    ranked = pieces.withColumn("rank", F.row_number().over(group) - 1).join(
        bases, ["class", "part"]
    )
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("base"))
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    placed = ranked.select(*kept, "class", "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = runs["class"] * (1 << 48) + runs["first"]
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            klass = batch.column("class").to_numpy().astype(np.int64)
            run = np.searchsorted(firsts, klass * (1 << 48) + rank, side="right") - 1
            nth = rank - runs["first"][run]
            sequence = runs["sequence"][run] + nth // runs["each"][run]
            slot = runs["slot"][run] + nth % runs["each"][run]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(slot)],
                [*kept, "sequence_id", "slot"],
            )

    schema = T.StructType([placed.schema[c] for c in kept])
    placed = placed.mapInArrow(place, schema.add("sequence_id", "long").add("slot", "long"))
    earlier = Window.partitionBy("sequence_id").orderBy("slot")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset")
    return placed.select(*kept, "sequence_id", offset)
