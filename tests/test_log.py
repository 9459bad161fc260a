"""Ordinals and replay."""

import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from feedloom import (
    backlog,
    edits_head,
    first_edits,
    log_head,
    parse_edits,
    replay_range,
    with_ordinals,
)
from feedloom.session import shared_folder

LINES = "received_ms bigint, channel string, line string"


def test_ranges_join_without_gap_or_overlap(raw_small):
    for k in (-1, 0, 400, 999, 5000):
        parts = replay_range(raw_small, None, k).unionAll(replay_range(raw_small, k, None))
        assert rows(parts) == rows(raw_small)


def test_range_bounds(raw_small):
    got = [r["ordinal"] for r in replay_range(raw_small, 10, 13).orderBy("ordinal").collect()]
    assert got == [11, 12, 13]
    assert replay_range(raw_small, 10, 10).count() == 0
    with pytest.raises(ValueError):
        replay_range(raw_small, 11, 10)


def test_backlog(raw_small):
    assert backlog(raw_small, 989).count() == 10
    assert backlog(raw_small, -1).count() == 1000


def test_head(raw_small):
    assert log_head(raw_small).first()["head"] == 999
    assert log_head(raw_small.where("false")).first()["head"] == -1


def test_first_edits(raw_small):
    edits = parse_edits(raw_small)
    head = edits_head(edits, 5)
    assert head.collect() == sorted(edits.collect(), key=lambda r: r["ordinal"])[:5]
    assert "TakeOrderedAndProject" in plan(head)


def test_range_reaches_the_scan(spark, landed):
    log = spark.read.parquet(landed)
    text = plan(replay_range(log, 10, 13))
    assert "GreaterThan(ordinal,10)" in text and "LessThanOrEqual(ordinal,13)" in text


def test_ordinals_are_those_of_a_sort(spark, raw_small):
    raw = raw_small.drop("ordinal").repartition(7, F.rand(1))
    got = [tuple(r) for r in with_ordinals(raw).orderBy("ordinal").collect()]
    lines = sorted(map(tuple, raw.collect()))
    assert got == [(i, *line) for i, line in enumerate(lines)]


def test_ordinals_start_anywhere(spark, raw_small):
    got = with_ordinals(raw_small.drop("ordinal"), first=500, partitions=3)
    bounds = got.agg(F.min("ordinal"), F.max("ordinal"), F.countDistinct("ordinal")).first()
    assert tuple(bounds) == (500, 1499, 1000)


def test_ordinals_of_an_empty_log(spark):
    assert with_ordinals(spark.createDataFrame([], LINES)).count() == 0


def test_one_time_with_most_rows_and_many_equal_copies(spark):
    """The hot time and the copies of one row are spread over the partitions."""
    rnd = random.Random(3)
    data = [(rnd.randint(0, 50), "#c", f"x{rnd.randint(0, 9)}") for _ in range(4000)]
    data += [(7, "#c", "copy")] * 4000 + [(7, "#d", f"y{i}") for i in range(4000)]
    rnd.shuffle(data)
    raw = spark.createDataFrame(data, LINES).repartition(6)
    got = with_ordinals(raw, partitions=8)
    assert [tuple(r) for r in got.orderBy("ordinal").collect()] == [
        (i, *line) for i, line in enumerate(sorted(data))
    ]
    written = spark.read.parquet(*set(got.inputFiles()))
    sizes = [r["count"] for r in written.groupBy(F.shiftright("_place", 33)).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 12000 / 8 * 2


def test_ordinals_come_from_a_written_table(spark, raw_small):
    got = with_ordinals(raw_small.drop("ordinal"))
    assert all(shared_folder(spark).split(":")[-1] in path for path in got.inputFiles())
    assert "rangepartitioning" not in plan(got)
    assert "BroadcastHashJoin" in plan(got)


@pytest.mark.parametrize("n", [0, 1, 20, 900, 5000])
def test_first_edits_by_growing_ranges(raw_small, n):
    whole = parse_edits(raw_small).orderBy("ordinal").limit(n)
    assert rows(first_edits(raw_small, n)) == rows(whole)
    assert first_edits(raw_small.where("false"), n).count() == 0


def test_open_ends_keep_rows_without_ordinal(raw_small):
    log = raw_small.withColumn("ordinal", F.when(F.col("ordinal") > 9, F.col("ordinal")))
    assert replay_range(log).count() == 1000
    assert replay_range(log, end=50).count() == 41


@pytest.mark.parametrize("name", ["ordinal", "_place", "_partition"])
def test_names_that_clash(raw_small, name):
    with pytest.raises(ValueError, match=name):
        with_ordinals(raw_small.drop("ordinal").withColumn(name, F.lit(1)))
