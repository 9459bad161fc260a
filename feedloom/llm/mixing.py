"""Mixing sources to target weights by capped water-filling.

Each source is to take its share of all words by its weight, but no more than a number of
epochs over what it has; what is over is shared out among the others by weight, until none is
above. Of a source's target, whole epochs take every document. For the part that is left, each
document draws a seeded number, and documents are taken whole in the order of these numbers until
the target is met; the one in which that happens is taken in part, its first words.

To find that place, the words of each source are added up in ``BUCKETS`` ranges of the numbers,
then in as many parts of the one range in which the target is met, and only the documents of one
such part, a millionth of a source, are put in order. So a hot source is counted in as many
parts as it has buckets, and nothing sorts or gathers its documents.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import SPACE, WORD, stored
from feedloom.operators.log import with_ordinals

#: The production mix: weights of the sources in turn, share of all words, most epochs of one.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
EPOCHS = 2
SEED = 7
BUCKET_BITS = 10
BUCKETS = 1 << BUCKET_BITS


def _draw(doc_id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, text)


def _bucket(level: int) -> Column:
    """The bucket of a row by its ``draw``, on the first or the second level."""
    return F.shiftrightunsigned(F.col("draw"), level * BUCKET_BITS).bitwiseAND(BUCKETS - 1)


def word_count(text: Column) -> Column:
    """The number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def word_counts(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int = SEED
) -> DataFrame:
    """``doc_id``, ``source``, ``draw`` and ``size``, the number of words."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        _draw(F.col(id_col), F.col(text_col), seed).alias("draw"),
        word_count(F.col(text_col)).alias("size"),
    )


def source_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Adds ``weight``: the weights in turn, by the order of the sources, null last."""
    ordered = with_ordinals(
        sources.withColumn("unnamed", F.col("source").isNull()), ["unnamed", "source"]
    )
    turn = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)),
        (F.col("ordinal") % len(weights) + 1).cast("int"),
    )
    return ordered.withColumn("weight", turn).drop("ordinal", "unnamed")


def water_level(sources: DataFrame, total: float, epochs: float) -> float:
    """The words per unit of weight at which the targets, clamped, add up to ``total``.

    Each round clamps the sources above their limit and shares the rest out anew; the level only
    rises. If every source is clamped the targets are all at their limits.
    """
    limit = F.col("source_size") * epochs
    level = 0.0
    while True:
        clamped = limit < F.col("weight") * level
        given, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(clamped, limit)), F.lit(0.0)).cast("double"),
            F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0.0)),
        ).first()
        if not open_weight:
            return level
        higher = (total - given) / open_weight
        if higher <= level:
            return level
        level = higher


def _where_met(shares: DataFrame, left: DataFrame) -> DataFrame:
    """The bucket of each source in which ``left`` is met, ``last``, and what is ``inside`` of it.

    ``shares`` has ``source``, ``bucket`` and ``words``; ``left`` has ``source`` and ``left``.
    """
    filled = Window.partitionBy("source").orderBy("bucket")
    before = shares.withColumn("before", F.sum("words").over(filled) - F.col("words"))
    left = left.withColumnRenamed("source", "of_source")
    met = before.join(left, F.col("source").eqNullSafe(F.col("of_source")))
    met = met.where((F.col("before") + F.col("words") > F.col("left")) & (F.col("words") > 0))
    first = F.min(F.struct("bucket", (F.col("left") - F.col("before")).alias("inside")))
    return met.groupBy("source").agg(first.alias("at")).select(
        "source", F.col("at.bucket").alias("last"), "at.inside"
    )


def mix_plan(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: float = EPOCHS,
) -> DataFrame:
    """One row for each source: ``source_size``, ``target``, and what to take of its documents.

    ``whole`` epochs of all; one more of those in buckets below ``last``, of those in it, in parts
    below ``last_part``, and of those in that part ``inside`` words. ``sizes`` is that of
    ``word_counts``.
    """
    shares = stored(
        sizes.groupBy("source", _bucket(0).alias("bucket")).agg(F.sum("size").alias("words")),
        "mix-shares",
    )
    sources = source_weights(
        stored(shares.groupBy("source").agg(F.sum("words").alias("source_size")), "mix-sources"),
        weights,
    )
    sources = stored(sources, "mix-weights")
    words = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = water_level(sources, share * words, epochs)
    size = F.col("source_size")
    target = F.least(F.col("weight") * level, size * epochs).cast("double")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("int")
    sources = sources.withColumn("target", target).withColumn("whole", whole)
    sources = sources.withColumn("left", F.col("target") - F.col("whole") * size).drop("weight")

    met = stored(_where_met(shares, sources.select("source", "left")), "mix-met")
    of = met.select(F.col("source").alias("of_source"), "last")
    same = F.col("source").eqNullSafe(F.col("of_source")) & (_bucket(0) == F.col("last"))
    parts = sizes.join(of, same).groupBy("source", _bucket(1).alias("bucket"))
    parts = parts.agg(F.sum("size").alias("words"))
    inner = _where_met(parts, met.select("source", F.col("inside").alias("left")))
    inner = inner.select(
        F.col("source").alias("inner_source"), F.col("last").alias("last_part"), "inside"
    )
    plan = sources.join(of, F.col("source").eqNullSafe(F.col("of_source")), "left").join(
        inner, F.col("source").eqNullSafe(F.col("inner_source")), "left"
    )
    plan = plan.select(
        "source",
        "source_size",
        "target",
        "whole",
        F.coalesce("last", F.lit(0)).alias("last"),
        F.coalesce("last_part", F.lit(0)).alias("last_part"),
        F.coalesce("inside", F.lit(0.0)).alias("inside"),
    )
    return stored(plan, "mix-plan")


def planned(rows: DataFrame, plan: DataFrame, size: Column) -> DataFrame:
    """Joins each row, with ``doc_id``, ``source`` and ``draw``, to its source's plan.

    Adds ``size`` and ``more``, the words to take beyond the ``whole`` epochs.
    """
    plan = plan.withColumnRenamed("source", "of_source")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    in_last = _bucket(0) == F.col("last")
    ordered = in_last & (_bucket(1) == F.col("last_part"))
    taken = (_bucket(0) < F.col("last")) | (in_last & (_bucket(1) < F.col("last_part")))
    apart = joined.where(~ordered).withColumn("size", size)
    apart = apart.withColumn("more", F.when(taken, F.col("size")).otherwise(0).cast("bigint"))
    within = Window.partitionBy("source").orderBy("draw", "doc_id", "size")
    upto = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    left = F.floor("inside") - (upto - F.col("size"))
    together = joined.where(ordered).withColumn("size", size)
    together = together.withColumn(
        "more", F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("bigint")
    )
    return apart.unionByName(together)


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: float = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row for each row of ``docs``, with what the mix takes of it.

    Columns: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``. The last counts the
    words the mix takes of the row, repeats included. It depends on the seed and the rows only.
    The sources' sums are below their targets by less than a word. One document of each source
    at most is taken in part. A null text has no words, a null source is a source of its own and
    the last one, and repeated rows, which draw the same number, are taken each for itself. A source without words has the target 0. An empty table gives no rows.
    """
    sizes = stored(word_counts(docs, id_col, text_col, source_col, seed), "mix-sizes")
    plan = mix_plan(sizes, weights, share, epochs)
    taken = F.col("whole") * F.col("size") + F.col("more")
    return planned(sizes, plan, F.col("size")).select(
        "doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken")
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    chars_col: str = "n_chars",
) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the columns it came with.

    A whole repetition is the row as it is. Of the one row of a source that is taken in part, the
    last repetition is its text up to the end of its last word taken, with all white space before,
    and has its number of characters in ``chars_col`` if there is such a column. Rows of which
    nothing is taken are not in the mix.
    """
    sizes = stored(word_counts(docs, id_col, text_col, source_col), "mix-sizes")
    plan = mix_plan(sizes)
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        _draw(F.col(id_col), F.col(text_col), SEED).alias("draw"),
    )
    text = F.col("row").getField(text_col)
    rows = planned(rows, plan, word_count(text))
    # a document without words is in the mix as often as its source is taken whole
    full = F.array_repeat(F.lit(None).cast("bigint"), F.col("whole"))
    extra = F.when(F.col("more") > 0, F.array(F.col("more"))).otherwise(
        F.array().cast("array<bigint>")
    )
    rows = rows.select("row", "size", F.explode(F.concat(full, extra)).alias("words"))
    cut = F.col("words") < F.col("size")
    every = F.regexp_extract_all(text, F.lit(f"{SPACE}{WORD}"), 0)
    first = F.slice(every, F.lit(1), F.col("words").cast("int"))
    rows = rows.withColumn("cut", F.when(cut, F.array_join(first, "")))
    columns = []
    for c in docs.columns:
        column = F.col("row").getField(c)
        if c == text_col:
            column = F.coalesce("cut", column)
        elif c == chars_col:
            counted = F.char_length("cut").cast(docs.schema[c].dataType)
            column = F.when(F.col("cut").isNotNull(), counted).otherwise(column)
        columns.append(column.alias(c))
    return rows.select(*columns)
