"""Suffix-array dedup: maximal repeat groups from the interval tree of common prefixes.

A full suffix array of a large corpus would be many times its size. Sampled suffixes are enough:
of the ``LENGTH`` bytes from any place on, the ``GRAM`` bytes with the smallest hash are their
anchor, the first of them if there are several. Equal strings have their anchor in the same
place, so strings that repeat meet among the suffixes that begin at anchors with equal bytes.
Each anchor stands for the run of places whose strings have it as theirs; the bytes of these
strings, before and after the anchor, are its context.

1. Anchors with equal contexts are one leaf of the tree with a count; this is a grouped sum.
2. Anchors that occur once are done. The leaves of the others are sorted by what follows the
   anchor: the enhanced suffix array. A scan with a stack gives the intervals of common prefixes,
   and within each, a scan of what stands before the anchors tells how far the repeat extends to
   the left and whether these extensions differ. The results are the maximal repeat groups with
   all occurrences; a leaf with a count above one is a group by itself.
3. From a group, each of its leaves learns which of its strings repeat, each anchor from its
   leaf, and each text from its anchors which of its bytes are covered.

An anchor with more than ``GROUP`` leaves, which one task should not hold, is taken string by
string instead: these are hashed and counted, so that the result is the same.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import portions, stored, texts_of, utf8

LENGTH = 400
GRAM = 40
#: Leaves of one anchor that are compared by suffix array.
GROUP = 4096
_PORTION = 2 << 20
#: Places within a portion are kept in the lower bits, below the hash.
_PLACE_BITS = 30


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on; ``gram`` is a multiple of 8."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    raw = data.tobytes()
    words = np.ndarray((len(data) - 7,), "<u8", raw, strides=(1,))
    found = np.zeros(n, np.uint64)
    for at in range(0, gram, 8):
        found ^= words[at : at + n]
        found *= np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(32)
    return found


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, in time linear in their number."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def find_anchors(
    data: np.ndarray, starts: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the texts that lie in ``data`` from ``starts`` on: text, hash, place, first, last.

    ``first`` to ``last`` are the places of the strings with this anchor. Places count from the
    start of ``data``; strings within a text only.
    """
    hashes = _gram_hashes(data, gram)
    place = np.arange(len(hashes), dtype=np.uint64)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    least = _window_minima((hashes & ~mask) | place, length - gram + 1)
    anchor = (least & mask).astype(np.int64)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(anchor)]
    whole = np.arange(len(anchor)) + length <= starts[text + 1]
    at = np.flatnonzero(whole)
    anchor, text = anchor[at], text[at]
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    first = at[new]
    last = at[np.append(new[1:], len(at))[: len(new)] - 1] if len(new) else first
    place = anchor[new]
    return text[new], hashes[place].view(np.int64), place, first, last


def anchors_of(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Anchors of all texts, from ``key`` and ``text``.

    ``key`` names the text; ``anchor`` is the hash of the anchor's bytes and ``leaf`` that of its
    context with the anchor's place in it, ``back``. ``span`` is the number of its strings less
    one. ``places`` are those of the anchor in this text; a text may repeat itself many times.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text", _PORTION):
                data, starts = utf8(part.column("text"))
                text, anchor, place, first, last = find_anchors(data, starts, length, gram)
                raw = data.tobytes()
                runs = zip(place.tolist(), first.tolist(), last.tolist(), strict=True)
                digest = xxhash.xxh3_64_intdigest
                leaf = [digest(raw[a : b + length], p - a) for p, a, b in runs]
                leaf = np.array(leaf, np.uint64).view(np.int64)
                order = np.lexsort((place, leaf, anchor, text))
                text, anchor, leaf, place, first, last = (
                    x[order] for x in (text, anchor, leaf, place, first, last)
                )
                same = (np.diff(text) == 0) & (np.diff(anchor) == 0) & (np.diff(leaf) == 0)
                heads = np.flatnonzero(np.append(True, ~same))[: len(text)]
                offsets = np.append(heads, len(text)).astype(np.int32)
                places = (place - starts[text]).astype(np.int32) if len(text) else place
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key").take(pa.array(text[heads], pa.int64())),
                        pa.array(anchor[heads]),
                        pa.array(leaf[heads]),
                        pa.array((place - first)[heads], pa.int32()),
                        pa.array((last - first)[heads], pa.int32()),
                        pa.ListArray.from_arrays(offsets, pa.array(places, pa.int32())),
                    ],
                    ["key", "anchor", "leaf", "back", "span", "places"],
                )

    schema = "key binary, anchor bigint, leaf bigint, back int, span int, places array<int>"
    return texts.select("key", "text").mapInArrow(find, schema)


def common_lengths(rows: list[bytes]) -> list[int]:
    """How many bytes each row has in common with the one before it; 0 for the first."""
    found = [0]
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        n = min(len(a), len(b))
        if a[:n] == b[:n]:
            found.append(n)
            continue
        x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
        found.append(int((x != y).argmax()))
    return found


def prefix_intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """The intervals of common prefixes: depth, first row, row after the last; inner ones first.

    ``common`` is that of ``common_lengths`` for sorted rows. One scan with a stack.
    """
    stack: list[tuple[int, int]] = []
    for at, depth in enumerate([*common[1:], 0], start=1):
        first = at - 1
        while stack and stack[-1][0] > depth:
            own, first = stack.pop()
            yield own, first, at
        if depth and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def repeat_groups(
    before: list[bytes], after: list[bytes], length: int
) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeat groups around one anchor: bytes before it, bytes from it on, all members.

    ``before`` is read backwards from the anchor. Rows of a group agree in so many bytes and in
    no more on either side; groups of fewer than ``length`` bytes are left out.
    """
    order = sorted(range(len(after)), key=after.__getitem__)
    common = common_lengths([after[i] for i in order])
    for right, a, b in prefix_intervals(common):
        rows = sorted(range(a, b), key=lambda r: before[order[r]])
        left_common = common_lengths([before[order[r]] for r in rows])
        found = [*prefix_intervals(left_common), (0, 0, len(rows))]
        for left, x, y in found:
            if left + right < length:
                continue
            inside = sorted(rows[x:y])
            # all in one inner interval: they agree in more bytes and are a group there
            if min(common[inside[0] + 1 : inside[-1] + 1]) > right:
                continue
            yield left, right, [order[r] for r in inside]


def _repeats(group: list[dict], length: int) -> Iterator[tuple[int, int, int, int]]:
    """Anchor, leaf and the places, back from the anchor, of strings that repeat: least and most.

    A leaf is in groups within groups; what they say of it is put together into as few runs of
    places as there are. A leaf that occurs ``twice`` repeats as a whole, which is known.
    """
    runs: list[list[tuple[int, int]]] = [[] for _ in group]
    before = [g["context"][: g["back"]][::-1] for g in group]
    after = [g["context"][g["back"] :] for g in group]
    for left, right, members in repeat_groups(before, after, length):
        for i in members:
            g = group[i]
            least, most = max(length - right, g["back"] - g["span"]), min(left, g["back"])
            if least <= most and not g["twice"]:
                runs[i].append((least, most))
    for g, found in zip(group, runs, strict=True):
        end = -1
        for a, b in sorted(set(found)):
            if end >= 0 and a <= end + 1:
                end = max(end, b)
                continue
            if end >= 0:
                yield g["anchor"], g["leaf"], begin, end
            begin, end = a, b
        if end >= 0:
            yield g["anchor"], g["leaf"], begin, end


def repeats_of(contexts: DataFrame, length: int) -> DataFrame:
    """Which strings of each leaf repeat, from the leaves of anchors that have several.

    ``contexts``: ``anchor``, ``leaf``, ``context``, ``back`` (the anchor's place in the context),
    ``span`` (strings in it less one) and ``twice`` (the leaf occurs again). All leaves of an anchor lie in one partition; a batch
    holds whole anchors only, of ``GROUP`` leaves at most.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(rows: list[tuple]) -> pa.RecordBatch:
            names = ("anchor", "leaf", "least", "most")
            columns = zip(*rows, strict=True) if rows else ([], [], [], [])
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, list(names))

        group: dict[int, dict] = {}
        anchor = None
        for batch in batches:
            found: list[tuple] = []
            for row in batch.to_pylist():
                if row["anchor"] != anchor:
                    found += _repeats(list(group.values()), length)
                    group, anchor = {}, row["anchor"]
                group[row["leaf"]] = row  # copies of a text give their leaves again
            yield results(found)
        yield results(list(_repeats(list(group.values()), length)))

    sorted_rows = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return sorted_rows.mapInArrow(search, "anchor bigint, leaf bigint, least int, most int")


def covered_texts(
    texts: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP
) -> DataFrame:
    """``key`` and ``runs``, the places (first and last) from which on a string repeats.

    ``texts`` has a ``key`` that equal texts share, and ``text``; texts without repeats are not
    in the result.
    """
    anchors = stored(anchors_of(texts, length, gram), "anchors")
    leaves = anchors.groupBy("anchor", "leaf").agg(
        F.sum(F.size("places")).alias("n"),
        F.first("back").alias("back"),
        F.first("span").alias("span"),
        F.min(F.struct("key", F.col("places")[0].alias("place"))).alias("of"),
    )
    counts = leaves.groupBy("anchor").agg(
        F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("leaves")
    )
    repeated = leaves.join(counts.where("occurrences > 1"), "anchor")
    repeated = stored(repeated, "repeated-anchors")
    wholly = repeated.where("n > 1").select(
        "anchor",
        "leaf",
        (F.col("back") - F.col("span")).alias("least"),
        F.col("back").alias("most"),
    )

    wanted = repeated.where("leaves > 1").groupBy(F.col("of.key").alias("key"))
    wanted = wanted.agg(
        F.collect_list(
            F.struct(
                "anchor",
                "leaf",
                "of.place",
                "back",
                "span",
                (F.col("n") > 1).alias("twice"),
                (F.col("leaves") > group).alias("many"),
            )
        ).alias("wanted")
    )

    names = ("anchor", "leaf", "back", "span", "twice")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = None
        for batch in batches:
            for part in portions(batch, "text", _PORTION):
                out: list[dict] = []
                rows = zip(
                    part.column("key").to_pylist(),
                    texts_of(part.column("text")),
                    part.column("wanted"),
                    strict=True,
                )
                for key, text, items in rows:
                    if key == done:  # a copy of the text before
                        continue
                    done = key
                    for x in items.as_py():
                        first = x["place"] - x["back"]
                        last = first + x["span"]
                        own = {name: x[name] for name in names}
                        if not x["many"]:
                            out.append(own | {"context": text[first : last + length]})
                            continue
                        for at in range(first, last + 1):
                            digest = xxhash.xxh3_128_digest(text[at : at + length])
                            out.append(own | {"string": digest, "most": x["place"] - at})
                        if len(out) > 50_000:
                            yield pa.RecordBatch.from_pylist(out, arrow)
                            out = []
                yield pa.RecordBatch.from_pylist(out, arrow)

    arrow = pa.schema(
        [
            ("anchor", pa.int64()),
            ("leaf", pa.int64()),
            ("context", pa.binary()),
            ("back", pa.int32()),
            ("span", pa.int32()),
            ("twice", pa.bool_()),
            ("string", pa.binary()),
            ("most", pa.int32()),
        ]
    )
    schema = (
        "anchor bigint, leaf bigint, context binary, back int, span int, twice boolean, "
        "string binary, most int"
    )
    # written once, as up to three consumers read it
    contexts = stored(texts.join(wanted, "key").mapInArrow(extract, schema), "contexts")
    found = wholly.unionByName(repeats_of(contexts.where("context is not null"), length))
    if not repeated.where(F.col("leaves") > group).isEmpty():
        strings = contexts.where("string is not null")
        strings = strings.select("anchor", "leaf", "string", "most").distinct()
        twice = strings.groupBy("string", "most").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        counted = strings.join(twice, ["string", "most"])
        found = found.unionByName(
            counted.select("anchor", "leaf", F.col("most").alias("least"), "most")
        )
    places = anchors.select("key", "anchor", "leaf", "places")
    runs = places.join(found, ["anchor", "leaf"]).select(
        "key", F.explode("places").alias("place"), "least", "most"
    )
    runs = runs.select(
        "key",
        F.struct(
            (F.col("place") - F.col("most")).alias("first"),
            (F.col("place") - F.col("least")).alias("last"),
        ).alias("run"),
    )
    return runs.groupBy("key").agg(F.collect_set("run").alias("runs"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``text`` and ``key``, a digest of the text, so that equal texts are one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("key")
    )


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    group: int = GROUP,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes left, of each row.

    Removed is each byte of a text that is covered by ``length`` bytes which also start anywhere
    else, in any text or the same one; overlaps count. A null text is empty. Each row is a text
    of its own, so that the whole of a repeated row goes if it is long enough. An empty table
    gives no rows.
    """
    rows = keyed(docs, id_col, text_col)
    joined = rows.join(covered_texts(rows, length, gram, group), "key", "left")
    joined = joined.select("doc_id", "text", "runs")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text", _PORTION):
                size, removed, spans, kept = [], [], [], []
                rows = zip(texts_of(part.column("text")), part.column("runs"), strict=True)
                for text, runs in rows:
                    at = end = 0
                    left, count = [], 0
                    for run in sorted((r["first"], r["last"]) for r in runs.as_py() or ()):
                        if run[0] > end or not count:
                            left.append(text[end : run[0]])
                            count += 1
                            end = run[0]
                        at = run[1] + length
                        end = max(end, at)
                    left.append(text[end:])
                    whole = b"".join(left)
                    size.append(len(text))
                    removed.append(len(text) - len(whole))
                    spans.append(count)
                    kept.append(whole)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *(pa.array(x, pa.int64()) for x in (size, removed, spans)),
                        pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    schema = T.StructType([joined.schema["doc_id"]])
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")
    return joined.mapInArrow(remove, schema.add("kept", "binary"))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``without_repeats`` with ``kept_sha256``, the digest of the bytes left, in place of these.

    Two more columns tell how a document fares: ``score``, the share of its bytes that is removed
    (0 for an empty text), and ``predicted``, 1 where anything is removed and 0 elsewhere.
    """
    found = without_repeats(docs, id_col, text_col)
    share = F.when(F.col("n_bytes") > 0, F.col("n_removed") / F.col("n_bytes")).otherwise(0.0)
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        share.alias("score"),
        (F.col("n_removed") > 0).cast("int").alias("predicted"),
    )
