"""URL filters: host and path rules, and boosted trees on lexical features for all other URLs.

Everything is a DataFrame expression or an aggregate; no Python runs on the executors. The trees
are fitted by histogram boosting: a level of a tree is one grouped sum of gradients over nodes,
features and bins, and a fitted tree is a CASE expression.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import ascii_lower, stored

#: The production rules as host, path and verdict.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: About so many labelled URLs are learned from, chosen by their hashes.
TRAIN_ROWS = 20_000
TREES = 8
DEPTH = 3
LEARNING_RATE = 0.5
#: Added to the number of rows in a leaf, and the least gain for which a node is split.
REGULARIZATION = 1.0
LEAST_GAIN = 1e-3
#: Hashed host suffixes that share a statistic.
SUFFIXES = 256
#: Upper bounds of the bins of each feature; the last bin is open.
BINS = {
    "length": (20, 25, 30, 35, 40, 45, 50, 60, 80, 120),
    "host_length": (10, 14, 18, 22, 26, 30, 40),
    "labels": (2, 3, 4, 5),
    "depth": (0, 1, 2, 3, 4, 6),
    "digits": (0.0, 0.02, 0.05, 0.08, 0.12, 0.2, 0.4),
    "entropy": (2.0, 3.0, 3.4, 3.7, 3.9, 4.1, 4.3, 4.6),
    "params": (0, 1, 2, 3, 5),
    "hyphens": (0, 1, 2, 4),
    "suffix_rate": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95),
}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path; both empty for a null or one without ``://``.

    The host lies between the first ``://`` and the next ``/``, ``?`` or ``#``, the path between
    the host and the next ``?`` or ``#``.
    """
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The rule that fits, as a struct of ``rule`` and ``verdict``, or null.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest rule
    wins, of equally long ones a blocking one, then the first by code point. The rules are part
    of the expression, so there should be no more than some hundreds.
    """
    found = F.lit(None).cast("struct<rule string, verdict string>")
    for at, under, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "block", r)):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(under)
        hit = F.struct(F.lit(at + under).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.coalesce(found, F.when(fits, hit))
    return found


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text).cast("double")
    parts = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size,
    )
    bits = F.aggregate(
        parts, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0)
    )
    return F.when(size > 0, bits).otherwise(0.0)


def lexical_features(urls: DataFrame) -> DataFrame:
    """Adds the features of ``url``, ``host`` and ``path``; ``suffix`` is the last label, hashed."""
    url = F.coalesce(F.col("url"), F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    last = F.substring_index("host", ".", -1)
    return urls.withColumns(
        {
            "length": F.length(url).cast("double"),
            "host_length": F.length("host").cast("double"),
            "labels": F.size(F.split("host", r"\.")).cast("double"),
            "depth": F.regexp_count("path", F.lit("/[^/]")).cast("double"),
            "digits": F.regexp_count(url, F.lit("[0-9]")) / size,
            "entropy": _entropy(url),
            "params": F.regexp_count(url, F.lit("[?&][^?&#]")).cast("double"),
            "hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
            "suffix": F.pmod(F.xxhash64(last), F.lit(SUFFIXES)).cast("int"),
        }
    )


@dataclass(frozen=True)
class UrlModel:
    """``prior`` is log-odds, ``suffix_rates`` by hashed suffix, ``trees`` nested splits.

    A tree is a leaf, a number, or ``(feature, bin, low, high)``: ``low`` for bins up to ``bin``.
    """

    prior: float
    base_rate: float
    suffix_rates: dict[int, float]
    trees: tuple


def _bin(feature: str) -> Column:
    """The bin of a feature, from the list of bounds."""
    return reduce(
        lambda total, bound: total + (F.col(feature) > bound).cast("int"), BINS[feature], F.lit(0)
    )


def _tree_value(tree) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    feature, split, low, high = tree
    return F.when(F.col(f"{feature}_bin") <= split, _tree_value(low)).otherwise(_tree_value(high))


def _log_odds(prior: float, trees: Sequence) -> Column:
    return reduce(lambda total, tree: total + _tree_value(tree), trees, F.lit(prior))


def _binned(urls: DataFrame, base_rate: float, rates: dict[int, float]) -> DataFrame:
    """Adds the bin of every feature."""
    pairs = [x for k, v in sorted(rates.items()) for x in (F.lit(k), F.lit(v))]
    rate = F.lit(None).cast("double")
    if pairs:
        rate = F.create_map(*pairs)[F.col("suffix")]
    urls = urls.withColumn("suffix_rate", F.coalesce(rate, F.lit(base_rate)))
    return urls.withColumns({f"{f}_bin": _bin(f) for f in BINS})


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> UrlModel:
    """Learns from ``url``, ``host``, ``path`` and ``label`` (1: block, 0: allow).

    About ``rows`` of them are used. Rows whose features fall into the same bins are one row
    with a weight. The driver gets sums by node, feature and bin, some hundreds.
    """
    total = labelled.count()
    if total > rows:
        chance = F.pmod(F.xxhash64("url"), F.lit(1 << 20)) / (1 << 20)
        labelled = labelled.where(chance < rows / total)
    featured = stored(lexical_features(labelled), "url-features")
    of_suffix = featured.groupBy("suffix").agg(F.sum("label"), F.count(F.lit(1))).collect()
    blocked, seen = sum(r[1] for r in of_suffix), sum(r[2] for r in of_suffix)
    base_rate = (blocked + 0.5) / (seen + 1)
    rates = {r[0]: (r[1] + 5 * base_rate) / (r[2] + 5) for r in of_suffix}
    prior = math.log(base_rate / (1 - base_rate))
    if blocked in (0, seen):
        return UrlModel(prior, base_rate, rates, ())
    bins = [f"{f}_bin" for f in BINS]
    binned = _binned(featured, base_rate, rates).groupBy(*bins)
    binned = stored(
        binned.agg(F.sum("label").cast("double").alias("ones"), F.count(F.lit(1)).alias("n")),
        "url-bins",
    )
    trees: list = []
    for _ in range(TREES):
        trees.append(_fit_tree(binned, prior, trees))
    return UrlModel(prior, base_rate, rates, tuple(trees))


def _fit_tree(binned: DataFrame, prior: float, trees: Sequence):
    """One tree on the gradients of the log-loss, grown level by level."""
    chance = 1 / (1 + F.exp(-_log_odds(prior, trees)))
    graded = binned.select(
        "*",
        (F.col("ones") - F.col("n") * chance).alias("gradient"),
        (F.col("n") * chance * (1 - chance)).alias("hessian"),
    )
    tree: list = [None]  # a leaf to be is None; a split is a list like that of UrlModel
    frontier = {0: (tree, 0)}
    nodes = {0: F.lit(True)}
    for level in range(DEPTH + 1):
        node = reduce(
            lambda found, item: F.when(item[1], item[0]).otherwise(found), nodes.items(), F.lit(-1)
        )
        pairs = F.array(
            *(F.struct(F.lit(f).alias("f"), F.col(f"{f}_bin").alias("b")) for f in BINS)
        )
        sums = (
            graded.select(node.alias("node"), F.explode(pairs).alias("x"), "gradient", "hessian")
            .where("node >= 0")
            .groupBy("node", "x.f", "x.b")
            .agg(F.sum("gradient"), F.sum("hessian"))
            .collect()
        )
        grown, conditions = {}, {}
        for number, (parent, place) in frontier.items():
            mine = [r for r in sums if r[0] == number]
            split = _best_split(mine) if level < DEPTH else None
            if split is None:
                parent[place] = _leaf(mine)
                continue
            feature, at = split
            parent[place] = [feature, at, None, None]
            for side, low in ((2, True), (3, False)):
                column = F.col(f"{feature}_bin")
                grown[2 * number + side - 1] = (parent[place], side)
                test = column <= at if low else column > at
                conditions[2 * number + side - 1] = nodes[number] & test
        if not grown:
            break
        frontier, nodes = grown, conditions
    return _frozen(tree[0])


def _frozen(tree):
    return tuple(map(_frozen, tree)) if isinstance(tree, list) else tree


def _leaf(sums: list) -> float:
    one = [r for r in sums if r[1] == "length"]
    gradient, hessian = sum(r[3] for r in one), sum(r[4] for r in one)
    return LEARNING_RATE * gradient / (hessian + REGULARIZATION)


def _best_split(sums: list) -> tuple[str, int] | None:
    """The feature and bin with the largest gain; ties: the first feature, the lowest bin."""
    gain = lambda g, h: g * g / (h + REGULARIZATION)
    best, found = LEAST_GAIN, None
    for feature in BINS:
        mine = sorted((r[2], r[3], r[4]) for r in sums if r[1] == feature)
        all_g, all_h = sum(r[1] for r in mine), sum(r[2] for r in mine)
        g = h = 0.0
        for at, more_g, more_h in mine[:-1]:
            g, h = g + more_g, h + more_h
            won = gain(g, h) + gain(all_g - g, all_h - h) - gain(all_g, all_h)
            if won > best + 1e-9:
                best, found = won, (feature, at)
    return found


def judge_urls(urls: DataFrame, model: UrlModel) -> DataFrame:
    """Adds ``score``, the model's probability that a row's ``url`` is to be blocked."""
    binned = _binned(lexical_features(urls), model.base_rate, model.suffix_rates)
    return binned.select(
        *urls.columns, (1 / (1 + F.exp(-_log_odds(model.prior, model.trees)))).alias("score")
    )


def url_filter(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    rows: int = TRAIN_ROWS,
) -> DataFrame:
    """One row for each page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score``.

    The verdict is that of the longest rule that fits. For other URLs it is that of the trees,
    which learn from the URLs under rules: block for a score of 0.5 or more. Null URLs and those
    without ``://`` have an empty host and path and are judged by the trees as well. If no URL is
    under a rule, or all have one verdict, the score is the (smoothed) share of blocked ones.
    Repeated rows are judged each; an empty table gives no rows; other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    urls = urls.withColumns({"host": host, "path": path})
    urls = urls.withColumn("hit", matching_rule(F.col("host"), F.col("path"), rules))
    labelled = urls.where(F.col("hit").isNotNull()).select(
        "url", "host", "path", (F.col("hit.verdict") == "block").cast("int").alias("label")
    )
    judged = judge_urls(urls, train(labelled, rows))
    learned = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", learned).alias("verdict"),
        "score",
    )
