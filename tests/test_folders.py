"""Tables of batch folders, live tables, and what running streams tell."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

import feedloom.streaming.folders as folders
from feedloom import (
    RunningCount,
    append_folders,
    append_numbered,
    append_table,
    close_batches,
    for_each_batch,
    live_table,
    parse_edits,
    read_edits,
    read_edits_stream,
    read_folders,
    read_raw_edits,
    received_count,
    received_so_far,
    received_total,
    run_available,
    wait_for_rows,
)
from feedloom.schemas import EDIT_ROW, RAW_EDIT

NUMBERS = "ordinal bigint"


def put(spark, path, batch, numbers):
    data = spark.createDataFrame([(n,) for n in numbers], NUMBERS)
    data.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def numbers_in(spark, path):
    return sorted(r["ordinal"] for r in read_folders(spark, path, NUMBERS).collect())


def count_folders(path):
    closed = f"{path}/{folders.CLOSED}"
    own = [n for n in os.listdir(path) if n.startswith("batch=")]
    return len(own) + (len(os.listdir(closed)) if os.path.isdir(closed) else 0)


def test_few_folders_after_many_batches(spark, tmp_path):
    path = f"{tmp_path}/t"
    most = 0
    for batch in range(500):
        os.makedirs(f"{path}/batch={batch}")
        if batch == 0:
            put(spark, path, 0, [0])
            (part,) = [f for f in os.listdir(f"{path}/batch=0") if f.endswith(".parquet")]
            with open(f"{path}/batch=0/{part}", "rb") as file:
                one = file.read()
        else:  # the same small file, so that the test is not one of Spark's start of jobs
            with open(f"{path}/batch={batch}/part.parquet", "wb") as file:
                file.write(one)
        if batch % 4 == 3:
            close_batches(spark, path, batch, NUMBERS, ["ordinal"])
            most = max(most, count_folders(path))
    assert count_folders(path) < 20 and most < 28  # with those about to be removed
    assert numbers_in(spark, path) == [0] * 500
    assert len(folders.live_folders(spark, path)) < 16


class Stopped(Exception):
    pass


@pytest.mark.parametrize("at", ["mark_done", "remove_folder"])
def test_a_stop_in_the_middle_of_merging(spark, tmp_path, monkeypatch, at):
    """Merged but not marked, or marked and half removed: each row counts once, and it goes on."""
    path = f"{tmp_path}/t"
    for batch in range(6):
        put(spark, path, batch, [2 * batch, 2 * batch + 1])

    def stop(*args):
        raise Stopped

    if at == "remove_folder":  # the first merge goes well, its traces are removed at the next
        assert close_batches(spark, path, 4, NUMBERS, ["ordinal"], least=3)
        assert numbers_in(spark, path) == list(range(12))
    with monkeypatch.context() as patch:
        patch.setattr(folders, at, stop)
        with pytest.raises(Stopped):
            close_batches(spark, path, 6, NUMBERS, ["ordinal"], least=2)
    assert numbers_in(spark, path) == list(range(12))
    put(spark, path, 5, [10, 11])  # the last batch comes again
    assert numbers_in(spark, path) == list(range(12))
    put(spark, path, 6, [12])
    assert close_batches(spark, path, 6, NUMBERS, ["ordinal"], least=2)
    put(spark, path, 6, [12])
    assert numbers_in(spark, path) == list(range(13))
    close_batches(spark, path, 6, NUMBERS, ["ordinal"], least=2)
    assert count_folders(path) <= 3


def test_merged_files_have_ranges(spark, tmp_path):
    path = f"{tmp_path}/t"
    for batch in range(4):
        put(spark, path, batch, range(batch * 100, batch * 100 + 100))
    close_batches(spark, path, 4, NUMBERS, ["ordinal"], least=2, file_bytes=1000)
    bounds = read_folders(spark, path, NUMBERS).groupBy(F.input_file_name()).agg(
        F.min("ordinal").alias("a"), F.max("ordinal").alias("b")
    )
    bounds = sorted((r["a"], r["b"]) for r in bounds.collect())
    assert len(bounds) > 1
    assert all(x[1] < y[0] for x, y in zip(bounds[:-1], bounds[1:], strict=True))


@pytest.fixture
def log(raw_small, tmp_path):
    path = f"{tmp_path}/log"
    raw_small.repartition(9).write.parquet(path)
    return path


def test_numbered_log_is_merged(spark, raw_small, log, tmp_path):
    path = f"{tmp_path}/numbered"
    stream = read_raw_edits(spark, log, None, streaming=True, max_files_per_trigger=1)
    run_available(
        append_numbered(stream.drop("ordinal"), path, f"{tmp_path}/c", every=None, close_every=3)
    )
    whole = read_raw_edits(spark, path, None)
    assert sorted(r["ordinal"] for r in whole.collect()) == list(range(1000))
    assert rows(whole.drop("ordinal")) == rows(raw_small.drop("ordinal"))
    assert count_folders(path) < 9
    part = read_raw_edits(spark, path, None, start=99, end=499)
    assert rows(part) == rows(whole.where("ordinal > 99 AND ordinal <= 499"))
    assert rows(read_folders(spark, path, RAW_EDIT)) == rows(whole)


def test_table_of_folders_over_restarts(spark, raw_small, log, tmp_path):
    table = f"{tmp_path}/t"

    def run():
        stream = read_edits_stream(spark, log, None, max_files_per_trigger=2)
        run_available(append_folders(stream, table, f"{tmp_path}/c", None, close_every=2))
        assert rows(read_folders(spark, table, EDIT_ROW)) == rows(read_edits(spark, log, None))
        return received_so_far(spark, table).first()["received"]

    events = parse_edits(read_raw_edits(spark, log, None))
    assert run() == run() == received_total(received_count(events)).first()["received"]
    raw_small.where("ordinal < 77").coalesce(1).write.mode("append").parquet(log)
    events = parse_edits(read_raw_edits(spark, log, None))
    assert run() == received_total(received_count(events)).first()["received"]


def test_a_batch_that_comes_again_counts_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    for batch, n in [(0, 5), (1, 7), (1, 7), (2, 0), (2, 1)]:
        folders.count_batch(spark, path, batch, n)
    assert tuple(received_so_far(spark, path).first()) == (2, 1, 13)
    assert received_so_far(spark, f"{tmp_path}/none").count() == 0


def test_empty_batches_leave_nothing(spark, log, tmp_path):
    """And no batch is kept to see whether it is empty, or read twice to be counted."""
    persisted = spark.sparkContext._jsc.getPersistentRDDs
    before = persisted().size()
    stream = read_edits_stream(spark, log, None, max_files_per_trigger=1).where("false")
    table = f"{tmp_path}/t"
    run_available(append_folders(stream, table, f"{tmp_path}/c", None))
    assert not [n for n in os.listdir(table) if n.startswith("batch=")]
    assert read_folders(spark, table, EDIT_ROW).count() == 0
    assert tuple(received_so_far(spark, table).first()) == (8, 0, 0)
    seen = []
    stream = read_edits_stream(spark, log, None, max_files_per_trigger=1).where("false")
    run_available(for_each_batch(stream, lambda df, i: seen.append(i), f"{tmp_path}/d", None))
    assert seen == [] and persisted().size() == before


def test_one_scan_for_each_batch(spark, log, tmp_path):
    """The rows that Spark counts as read are those of the log; a second reading doubles them."""
    stream = read_raw_edits(spark, log, None, streaming=True)
    query = append_folders(stream, f"{tmp_path}/t", f"{tmp_path}/c", None)
    run_available(query)
    assert query.lastProgress.numInputRows == 1000

    def twice(df, i):
        df.count()
        df.count()

    query = for_each_batch(stream, twice, f"{tmp_path}/d", None)
    run_available(query)
    assert query.lastProgress.numInputRows >= 2000


# live tables and progress


def test_sql_sees_what_a_running_stream_writes(spark, raw_small, tmp_path):
    log, table = f"{tmp_path}/log", f"{tmp_path}/a `quoted` table"
    statement = "SELECT count(*) AS n FROM live_edits"

    def look():
        return spark.sql(statement).first()["n"]

    live_table(spark, "live_edits", table, EDIT_ROW)
    assert look() == 0 and spark.table("live_edits").schema == EDIT_ROW
    raw_small.where("ordinal < 300").coalesce(1).write.parquet(log)
    stream = read_edits_stream(spark, log, None)
    query = append_table(stream, "live_edits", f"{tmp_path}/c", table, every="0 seconds")
    try:
        wait_for_rows(spark, query, 60)
        first = look()
        assert first == read_edits(spark, log, None).count() > 0
        raw_small.where("ordinal >= 300").coalesce(1).write.mode("append").parquet(log)
        query.processAllAvailable()
        assert look() == read_edits(spark, log, None).count() > first
        assert query.isActive
    finally:
        query.stop()
    assert rows(spark.table("live_edits")) == rows(read_edits(spark, log, None))


def test_first_rows_that_come_late(spark, raw_small, tmp_path):
    log = f"{tmp_path}/log"
    raw_small.where("false").write.parquet(log)
    stream = read_edits_stream(spark, log, None)
    query = append_table(stream, "late", f"{tmp_path}/c", f"{tmp_path}/t", every="0 seconds")
    try:
        with pytest.raises(TimeoutError):
            wait_for_rows(spark, query, 1)
        assert query.isActive
        raw_small.coalesce(1).write.mode("append").parquet(log)
        assert wait_for_rows(spark, query, 60).numInputRows == 1000
        assert wait_for_rows(spark, query, 0.001).numInputRows == 1000  # it had some before
    finally:
        query.stop()


def test_a_query_that_fails_or_ends_without_rows(spark, log, raw_small, tmp_path):
    def fail(df, i):
        raise RuntimeError("cannot write")

    stream = read_raw_edits(spark, log, None, streaming=True)
    query = for_each_batch(stream, fail, f"{tmp_path}/c", "0 seconds")
    with pytest.raises(Exception, match="cannot write"):
        wait_for_rows(spark, query, 60)
    empty = f"{tmp_path}/empty"
    raw_small.where("false").write.parquet(empty)
    stream = read_raw_edits(spark, empty, None, streaming=True)
    query = append_folders(stream, f"{tmp_path}/t", f"{tmp_path}/d", None)
    with pytest.raises(EOFError):
        wait_for_rows(spark, query, 60)


def test_running_count(spark, raw_small, log, tmp_path):
    counter = RunningCount(spark)
    try:
        def run():
            stream = read_raw_edits(spark, log, None, streaming=True, max_files_per_trigger=3)
            query = append_folders(stream, f"{tmp_path}/t", f"{tmp_path}/c", None)
            run_available(query)
            return query

        assert counter.wait_for(run(), 1000, 60)
        raw_small.where("ordinal < 50").coalesce(1).write.mode("append").parquet(log)
        query = run()
        assert counter.wait_for(query, 1050, 60) and counter.received(query) == 1050
        assert not counter.wait_for(query, 1051, 0.1)
    finally:
        counter.close()
    assert received_so_far(spark, f"{tmp_path}/t").first()["received"] == 1050
