"""Ranges of a log that open only the files they need, and hand-over to a stream."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from feedloom import (
    append_table,
    hand_over,
    judge_edits,
    judge_statuses,
    land_log,
    log_head_of,
    open_table,
    read_edits,
    read_edits_stream,
    read_raw_edits,
    read_tweets,
    run_available,
    write_manifest,
)
from feedloom.plans.fixtures import raw_statuses
from feedloom.schemas import EDIT_ROW
from feedloom.sources.manifest import MANIFEST, checked, manifest


@pytest.fixture(scope="module")
def large_log(spark, tmp_path_factory):
    """200 files, each with a range of ordinals, in folders by channel with odd names."""
    path = f"{tmp_path_factory.mktemp('manifest')}/log of edits 100% #1"
    raw = spark.range(4000).select(
        F.col("id").alias("ordinal"),
        (F.col("id") * 10).alias("received_ms"),
        F.when(F.col("id") % 2 == 0, "#en.wikipedia").otherwise("a b%20c").alias("channel"),
        F.concat(F.lit("line "), F.col("id")).alias("line"),
    )
    ordered = raw.repartitionByRange(100, "ordinal").sortWithinPartitions("ordinal")
    ordered.write.partitionBy("channel").parquet(path)
    assert sum(f.endswith(".parquet") for _, _, fs in os.walk(path) for f in fs) == 200
    write_manifest(spark, path)
    return path


def opened(df):
    """The rows, and the number of files that were opened for them."""
    found = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    files = [leaves.apply(i).metrics().get("numFiles") for i in range(leaves.size())]
    return found, sum(f.get().value() for f in files if f.isDefined())


def ordinals(found):
    return sorted(r["ordinal"] for r in found)


@pytest.mark.parametrize(
    "start, end, most", [(399, 440, 6), (None, 39, 3), (3959, None, 4), (5000, None, 0), (10, 10, 0)]
)
def test_only_the_files_of_a_range_are_opened(spark, large_log, start, end, most):
    found, files = opened(read_raw_edits(spark, large_log, None, start=start, end=end))
    first, last = -1 if start is None else start, 3999 if end is None else end
    assert ordinals(found) == list(range(first + 1, last + 1))
    assert files <= most


def test_one_channel_of_a_range(spark, large_log):
    found, files = opened(read_raw_edits(spark, large_log, "a b%20c", start=99, end=140))
    assert ordinals(found) == list(range(101, 141, 2)) and files <= 3


def test_head_is_in_the_manifest(spark, large_log):
    head = log_head_of(spark, large_log)
    found, files = opened(head)
    assert found[0]["head"] == 3999 and files <= 201  # the list of files and the manifest
    assert "ordinal" not in head._jdf.queryExecution().executedPlan().toString()


def test_a_log_that_grows(spark, tmp_path):
    raw = spark.range(300).selectExpr(
        "id AS ordinal", "id AS received_ms", "'c' AS channel", "'x' AS line"
    )
    path = land_log(raw.where("ordinal < 200"), f"{tmp_path}/log", files=8)
    raw.where("ordinal >= 200").coalesce(1).write.mode("append").parquet(path)
    # what the manifest does not know is opened
    assert checked(spark, path).where("rows is null").count() == 1
    found, files = opened(read_raw_edits(spark, path, None, start=10, end=20))
    assert ordinals(found) == list(range(11, 21)) and files <= 3
    found, files = opened(read_raw_edits(spark, path, None, start=190))
    assert ordinals(found) == list(range(191, 300)) and files <= 3
    assert log_head_of(spark, path).first()["head"] == 299
    # brought up to date
    for _ in range(4):
        write_manifest(spark, path)
    assert checked(spark, path).where("rows is null").count() == 0
    assert manifest(spark, path).agg(F.sum("rows")).first()[0] == 300
    assert len(os.listdir(f"{path}/{MANIFEST}")) == 2
    found, files = opened(read_raw_edits(spark, path, None, start=10, end=20))
    assert ordinals(found) == list(range(11, 21)) and files <= 2
    assert rows(read_raw_edits(spark, path, None)) == rows(raw)


def test_a_file_that_was_replaced_is_opened(spark, tmp_path):
    one = spark.range(10).selectExpr("id AS ordinal", "id AS received_ms", "'c' channel", "'x' line")
    path = land_log(one, f"{tmp_path}/log", files=1)
    (name,) = [f for f in os.listdir(path) if f.endswith(".parquet")]
    other = one.withColumn("ordinal", F.col("ordinal") + 1000)
    other.coalesce(1).write.parquet(f"{tmp_path}/other")
    (new,) = [f for f in os.listdir(f"{tmp_path}/other") if f.endswith(".parquet")]
    os.replace(f"{tmp_path}/other/{new}", f"{path}/{name}")
    for crc in [f for f in os.listdir(path) if f.endswith(".crc")]:
        os.remove(f"{path}/{crc}")
    os.utime(f"{path}/{name}", (1, 1))
    assert ordinals(read_raw_edits(spark, path, None, start=1004).collect()) == list(
        range(1005, 1010)
    )
    assert log_head_of(spark, path).first()["head"] == 1009


def test_rows_without_ordinals_and_an_empty_log(spark, tmp_path):
    schema = "ordinal bigint, received_ms bigint, channel string, line string"
    some = spark.createDataFrame([(None, 1, "c", "x"), (7, 1, "c", "x"), (None, 2, "c", "y")], schema)
    path = land_log(some, f"{tmp_path}/some", files=2)
    assert log_head_of(spark, path).first()["head"] == 7
    assert ordinals(read_raw_edits(spark, path, None, start=0).collect()) == [7]
    assert read_raw_edits(spark, path, None).count() == 3
    none = land_log(some.where("false"), f"{tmp_path}/none")
    assert log_head_of(spark, none).first()["head"] == -1
    assert read_raw_edits(spark, none, None, start=3).count() == 0


def test_a_log_without_manifest(spark, raw_small, tmp_path):
    path = f"{tmp_path}/log"
    raw_small.write.parquet(path)
    assert manifest(spark, path) is None
    expected = raw_small.where("ordinal > 100 AND ordinal <= 200")
    assert rows(read_raw_edits(spark, path, None, start=100, end=200)) == rows(expected)
    assert log_head_of(spark, path).first() == raw_small.agg(F.max("ordinal")).first()


def test_statuses_by_range(spark, small, tmp_path):
    path = land_log(raw_statuses(spark, small), f"{tmp_path}/log", files=10)
    found, files = opened(read_tweets(spark, path, start=20, end=39))
    assert len(found) > 10 and files <= 3
    plain = f"{tmp_path}/plain"
    raw_statuses(spark, small).write.parquet(plain)
    assert rows(read_tweets(spark, path, start=20, end=39)) == rows(
        read_tweets(spark, plain, start=20, end=39)
    )


def test_no_range_in_a_log_of_text(spark, tmp_path):
    spark.createDataFrame([("{}",)], "value string").write.text(f"{tmp_path}/t")
    with pytest.raises(ValueError, match="no ordinals"):
        read_tweets(spark, f"{tmp_path}/t", fmt="text", start=3)
    assert read_tweets(spark, f"{tmp_path}/t", fmt="text").count() == 0


def test_columns_that_clash_are_an_error(spark, raw_small, small):
    for name in ("title", "User", "reason"):
        with pytest.raises(ValueError, match=name.lower()):
            judge_edits(raw_small.withColumn(name, F.lit(1)))
    for name in ("text", "userlang", "_raw"):
        with pytest.raises(ValueError, match=name):
            judge_statuses(raw_statuses(spark, small).withColumn(name, F.lit(1)))
    assert "more" in judge_edits(raw_small.withColumn("more", F.lit(1))).columns


def test_stream_from_an_ordinal(spark, raw_small, tmp_path):
    path = land_log(raw_small, f"{tmp_path}/log", files=4)
    for start in (-1, 0, 500, 10_000):
        stream = read_edits_stream(spark, path, None, start=start)
        out = f"{tmp_path}/{start}"
        run_available(append_table(stream, "after", f"{out}/c", f"{out}/t"))
        expected = rows(read_edits(spark, path, None, start=start))
        assert rows(open_table(spark, "after", f"{out}/t", EDIT_ROW)) == expected


def test_hand_over_misses_nothing(spark, raw_small, tmp_path):
    """Also what lands between the two, and after the stream has begun; nothing comes twice."""
    path = land_log(raw_small.where("ordinal < 300"), f"{tmp_path}/log", files=4)
    table, stream, at = hand_over(spark, path, None)
    assert at == 299

    def land(a, b):
        part = raw_small.where(f"ordinal >= {a} AND ordinal < {b}")
        part.coalesce(1).write.mode("append").parquet(path)

    def streamed():
        run_available(append_table(stream, "rest", f"{tmp_path}/c", f"{tmp_path}/t"))
        return open_table(spark, "rest", f"{tmp_path}/t", EDIT_ROW)

    land(300, 400)
    first = rows(table)
    streamed()
    land(400, 2000)
    rest = streamed()
    whole = rows(read_edits(spark, path, None))
    assert sorted(first + rows(rest), key=repr) == whole
    assert first == rows(read_edits(spark, path, None, end=299)) and first != whole
