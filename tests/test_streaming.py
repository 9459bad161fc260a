"""Streams: the same rows as the tables, once each, over restarts."""

import os
import shutil
import time

import pytest
from conftest import rows

from feedloom import (
    append_numbered,
    append_table,
    edit_events,
    for_each_batch,
    latest_snapshot,
    memory_table,
    open_table,
    parse_edits,
    read_edit_events,
    read_edits,
    read_edits_stream,
    read_raw_edits,
    read_tweets,
    received_count,
    received_total,
    run_available,
    snapshots,
    stop_all,
    to_console,
)
from feedloom.plans.fixtures import land_raw_statuses
from feedloom.plans.queries import QUERIES
from feedloom.schemas import EDIT_ROW, TWEET_ROW
from feedloom.session import _given, clear_folders, folder_exists, new_folder


@pytest.fixture
def log(raw_small, tmp_path):
    """A log of four files."""
    path = f"{tmp_path}/log"
    raw_small.repartition(4).write.parquet(path)
    return path


def add(raw, path):
    raw.coalesce(1).write.mode("append").parquet(path)


def test_table_is_filled_once_over_restarts(spark, raw_small, log, tmp_path):
    table, checkpoint = f"{tmp_path}/table", f"{tmp_path}/checkpoint"

    def run():
        stream = read_edits_stream(spark, log, channel=None)
        run_available(append_table(stream, "edits_once", checkpoint, table))
        return open_table(spark, "edits_once", table, EDIT_ROW)

    assert rows(run()) == rows(read_edits(spark, log, channel=None))
    first = rows(run())
    assert first == rows(read_edits(spark, log, channel=None))
    add(raw_small.where("ordinal < 50"), log)
    again = rows(run())
    assert len(again) > len(first)
    assert again == rows(read_edits(spark, log, channel=None))
    n = spark.sql("SELECT count(*) AS n FROM edits_once").first()["n"]
    assert n == len(again)


def test_stop_in_the_middle(spark, log, tmp_path):
    """One of four files is taken, then the query stops; the next one takes the other three."""
    table, checkpoint = f"{tmp_path}/table", f"{tmp_path}/checkpoint"
    stream = read_edits_stream(spark, log, channel=None, max_files_per_trigger=1)
    query = append_table(stream, "part", checkpoint, table, every="1 hour")
    ends = time.time() + 60
    while query.lastProgress is None and time.time() < ends:
        time.sleep(0.1)
    query.stop()
    whole = rows(read_edits(spark, log, channel=None))
    assert 0 < open_table(spark, "part", table, EDIT_ROW).count() < len(whole)
    run_available(append_table(stream, "rest", checkpoint, table))
    assert rows(open_table(spark, "rest", table, EDIT_ROW)) == whole


def test_one_channel(spark, log, tmp_path):
    stream = read_edits_stream(spark, log)
    run_available(append_table(stream, "english", f"{tmp_path}/c", f"{tmp_path}/t"))
    assert rows(open_table(spark, "english", f"{tmp_path}/t", EDIT_ROW)) == rows(read_edits(spark, log))


def test_table_in_memory(spark, log):
    query = memory_table(read_edits_stream(spark, log, channel=None), "edits_memory")
    run_available(query)
    assert rows(spark.table("edits_memory")) == rows(read_edits(spark, log, channel=None))


def test_files_per_batch(spark, log, tmp_path):
    stream = read_edits_stream(spark, log, channel=None, max_files_per_trigger=1)
    query = append_table(stream, "slow", f"{tmp_path}/c", f"{tmp_path}/t")
    run_available(query)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 4


def test_each_batch(spark, log, tmp_path):
    stream = read_edit_events(
        spark, log, channel=None, streaming=True, max_files_per_trigger=1
    )
    seen = {}
    run_available(
        for_each_batch(stream, lambda df, i: seen.update({i: rows(df)}), f"{tmp_path}/c", None)
    )
    assert sorted(seen) == [0, 1, 2, 3]
    got = sorted((r for batch in seen.values() for r in batch), key=repr)
    assert got == rows(read_edit_events(spark, log, channel=None))


def test_empty_batches_are_skipped(spark, raw_small, tmp_path):
    path = f"{tmp_path}/log"
    add(raw_small.selectExpr("ordinal", "received_ms", "channel", "'no edit' AS line"), path)
    stream = edit_events(parse_edits(read_raw_edits(spark, path, None, streaming=True)))
    seen = []
    query = for_each_batch(stream, lambda df, i: seen.append(i), f"{tmp_path}/c", None)
    run_available(query)
    assert query.lastProgress.numInputRows == 1000
    assert seen == []


def test_default_interval_of_batches(spark, tmp_path, monkeypatch):
    asked = []

    def record(writer, every):
        asked.append(every)
        return writer.trigger(availableNow=True)

    monkeypatch.setattr("feedloom.streaming.sinks._trigger", record)
    for_each_batch(spark.readStream.format("rate").load(), lambda df, i: None, f"{tmp_path}/c").stop()
    assert asked == ["10 seconds"]


def test_counts_go_on_over_a_restart(spark, raw_small, log, tmp_path):
    path, checkpoint = f"{tmp_path}/counts", f"{tmp_path}/checkpoint"

    def run():
        raw = read_raw_edits(spark, log, None, streaming=True, max_files_per_trigger=2)
        run_available(snapshots(received_count(parse_edits(raw)), path, checkpoint, None))
        return latest_snapshot(spark, path)

    assert rows(run()) == rows(received_count(parse_edits(raw_small)))
    add(raw_small, log)
    counts = run()
    once = rows(received_count(parse_edits(raw_small)))
    assert rows(counts) == [(channel, 2 * n) for channel, n in once]
    assert received_total(counts).first()["received"] == 2 * parse_edits(raw_small).count()


def test_log_is_numbered_batch_by_batch(spark, raw_small, log, tmp_path):
    path, checkpoint = f"{tmp_path}/numbered", f"{tmp_path}/checkpoint"

    def run():
        raw = read_raw_edits(spark, log, None, streaming=True, max_files_per_trigger=1)
        run_available(append_numbered(raw.drop("ordinal"), path, checkpoint, every=None))
        return spark.read.parquet(path)

    lines = rows(raw_small.drop("ordinal"))
    numbered = run().orderBy("ordinal").collect()
    assert [r["ordinal"] for r in numbered] == list(range(1000))
    assert sorted(((*r[1:4],) for r in numbered), key=repr) == lines
    in_order = [(r["batch"], r["received_ms"], r["channel"], r["line"]) for r in numbered]
    assert in_order == sorted(in_order)
    assert len({b for b, *_ in in_order}) == 4
    add(raw_small.where("false"), log)
    add(raw_small, log)
    again = run().orderBy("ordinal").collect()
    assert again[:1000] == numbered
    assert [r["ordinal"] for r in again] == list(range(2000))


def test_numbered_batch_that_comes_again(spark, raw_small, log, tmp_path):
    """A crash after the rows are written and before the batch is committed."""
    path = f"{tmp_path}/numbered"

    def run(checkpoint):
        raw = read_raw_edits(spark, log, None, streaming=True, max_files_per_trigger=1)
        run_available(append_numbered(raw.drop("ordinal"), path, checkpoint, every=None))
        return rows(spark.read.parquet(path))

    assert run(f"{tmp_path}/a") == run(f"{tmp_path}/b")


def test_console(spark, log, capfd):
    query = to_console(read_edits_stream(spark, log, channel=None), rows=3)
    run_available(query)
    assert "only showing top 3 rows" in capfd.readouterr().out


@pytest.mark.parametrize("layout", ["file", "folder", "empty"])
@pytest.mark.parametrize(
    "name",
    [
        "edits_stream",
        "edits_count",
        "edits_channel_stream",
        "edit_events_stream",
        "received_count",
        "received_total",
        "log_ordinals_stream",
    ],
)
def test_streams_of_any_layout(spark, small, tmp_path, layout, name):
    """A table may be one file, a folder of files, or empty."""
    events = spark.read.parquet(f"{small}/events.parquet")
    if layout == "file":
        shutil.copy(f"{small}/events.parquet", f"{tmp_path}/events.parquet")
    elif layout == "folder":
        events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    else:
        events.limit(0).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got, whole = QUERIES[name](spark, str(tmp_path)), QUERIES[name](spark, small)
    assert got.schema == whole.schema
    if layout != "empty":
        assert rows(got) == rows(whole) != []
    else:
        assert rows(got) in ([], [(0,)])


def test_channel_stream_reads_one_folder(spark, landed):
    stream = read_edits_stream(spark, landed, "#fr.wikipedia")
    query = memory_table(stream, "one_folder")
    run_available(query)
    of_channel = spark.read.parquet(landed).where("channel = '#fr.wikipedia'").count()
    assert query.lastProgress.numInputRows == of_channel


def test_numbers_kept_do_not_grow(spark, log, tmp_path):
    path = f"{tmp_path}/numbered"
    raw = read_raw_edits(spark, log, None, streaming=True, max_files_per_trigger=1)
    run_available(append_numbered(raw.drop("ordinal"), path, f"{tmp_path}/c", every=None))
    assert sorted(os.listdir(f"{path}/_next")) == ["0", "1"]


def test_folders_are_cleared(spark):
    path = new_folder(spark, "to-clear")
    spark.range(1).write.parquet(path)
    assert folder_exists(spark, path)
    _given[:] = [path]
    assert clear_folders(spark) == 1 and not folder_exists(spark, path)


def test_tweets(spark, small, tmp_path):
    path = land_raw_statuses(spark, small)
    stream = read_tweets(spark, path, streaming=True, max_files_per_trigger=1)
    run_available(append_table(stream, "tweets", f"{tmp_path}/c", f"{tmp_path}/t"))
    assert rows(open_table(spark, "tweets", f"{tmp_path}/t", TWEET_ROW)) == rows(read_tweets(spark, path))


def test_errors_are_raised(spark, log, tmp_path):
    def fail(df, i):
        raise RuntimeError("cannot write")

    stream = read_edit_events(spark, log, channel=None, streaming=True)
    with pytest.raises(Exception, match="cannot write"):
        run_available(for_each_batch(stream, fail, f"{tmp_path}/c", None))


def test_query_that_does_not_end(spark):
    query = to_console(spark.readStream.format("rate").load(), every="1 hour")
    with pytest.raises(TimeoutError):
        run_available(query, timeout_s=1)
    assert not query.isActive


def test_stop_all(spark):
    started = [to_console(spark.readStream.format("rate").load(), every="1 hour") for _ in range(2)]
    assert stop_all(spark) == 2
    assert not any(q.isActive for q in started)
    assert stop_all(spark) == 0
