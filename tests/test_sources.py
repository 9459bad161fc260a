"""Logs read as tables: formats, channels, ranges; tweets."""

import json
from datetime import datetime

import pytest
from conftest import plan, rows

from feedloom import (
    edit_events,
    edit_rows,
    parse_edits,
    read_edit_events,
    read_edits,
    read_edits_stream,
    read_raw_edits,
    read_tweets,
    received_count,
    received_total,
    rejected_statuses,
    replay_range,
    tweet_rows,
)
from feedloom.plans.fixtures import land_raw_statuses
from feedloom.schemas import TWEET_ROW


def test_edits_of_the_default_channel(spark, landed, raw_small):
    english = raw_small.where("channel = '#en.wikipedia'")
    assert rows(read_edits(spark, landed)) == rows(edit_rows(parse_edits(english)))


def test_edits_of_all_channels(spark, landed, raw_small):
    got = read_edits(spark, landed, channel=None)
    assert rows(got) == rows(edit_rows(parse_edits(raw_small)))


def test_edits_of_a_range(spark, landed, raw_small):
    got = read_edits(spark, landed, channel=None, start=100, end=200)
    expected = edit_rows(parse_edits(replay_range(raw_small, 100, 200)))
    assert rows(got) == rows(expected)
    with pytest.raises(ValueError):
        read_edits(spark, landed, start=2, end=1)


def test_edit_events(spark, landed, raw_small):
    got = read_edit_events(spark, landed, channel=None)
    assert rows(got) == rows(edit_events(parse_edits(raw_small)))


@pytest.mark.parametrize("fmt", ["json", "orc", "csv"])
def test_other_formats(spark, raw_small, tmp_path, fmt):
    options = {"multiLine": True, "escape": '"'} if fmt == "csv" else {}
    raw = raw_small.where("line NOT LIKE '%\n%' AND line NOT LIKE '% '")
    raw.write.format(fmt).options(**options).save(f"{tmp_path}/log")
    got = read_edits(spark, f"{tmp_path}/log", channel=None, fmt=fmt)
    assert rows(got) == rows(edit_rows(parse_edits(raw)))


def test_channel_and_range_reach_the_scan(spark, landed):
    text = plan(read_edits(spark, landed, "#fr.wikipedia", 10, 20))
    assert "PartitionFilters: [isnotnull(channel" in text
    assert "GreaterThan(ordinal,10)" in text and "LessThanOrEqual(ordinal,20)" in text
    assert "Exchange" not in text
    unranged = plan(read_edits(spark, landed, "#fr.wikipedia").select("timestamp"))
    assert "ReadSchema: struct<received_ms:bigint,line:string>" in unranged


@pytest.mark.parametrize("files", [0, -1])
def test_bad_batch_size(spark, landed, files):
    with pytest.raises(ValueError):
        read_edits_stream(spark, landed, max_files_per_trigger=files)
    with pytest.raises(ValueError):
        read_tweets(spark, landed, streaming=True, max_files_per_trigger=files)


def test_batch_size_is_for_streams(spark, landed):
    with pytest.raises(ValueError):
        read_raw_edits(spark, landed, max_files_per_trigger=1)
    with pytest.raises(ValueError):
        read_tweets(spark, landed, max_files_per_trigger=1)


def test_received_counts(raw_small):
    edits = parse_edits(raw_small)
    counts = received_count(edits)
    by_channel = {r["channel"]: r["received"] for r in counts.collect()}
    assert len(by_channel) == 3
    assert sum(by_channel.values()) == edits.count() == received_total(counts).first()["received"]
    assert received_total(received_count(edits.where("false"))).first()["received"] == 0
    assert "partial_count" in plan(counts)


def status(**fields):
    base = {
        "created_at": "Sun Mar 11 08:00:01 +0000 2018",
        "text": "hello",
        "user": {"screen_name": "bob", "lang": "en", "id": 1},
        "retweeted": False,
        "id": 7,
    }
    return json.dumps({k: v for k, v in {**base, **fields}.items() if v is not ...})


def test_tweets(spark, tmp_path):
    at = datetime(2018, 3, 11, 8, 0, 1)
    lines = {
        status(): ("hello", "bob", "en", at, False),
        status(text="a\n\"b\" é", retweeted=True): ('a\n"b" é', "bob", "en", at, True),
        status(created_at="Mon Dec 31 23:59:59 -0130 2018"): (
            "hello",
            "bob",
            "en",
            datetime(2019, 1, 1, 1, 29, 59),
            False,
        ),
        status(retweeted=...): ("hello", "bob", "en", at, False),
        status(created_at="Mar 11 08:00:01 +0000 2018"): ("hello", "bob", "en", at, False),
        status(created_at="yesterday"): None,
        status(retweeted="yes"): None,
        status(user=...): ("hello", None, None, at, False),
        status(text="w " * 20000): ("w " * 20000, "bob", "en", at, False),
        '{"delete":{"status":{"id":1}}}': None,
        '{"limit":{"track":3}}': None,
        status(text=None): None,
        '{"text": "cut o': None,
        "": None,
    }
    (tmp_path / "log.txt").write_text("\n".join(lines), encoding="utf-8")
    got = read_tweets(spark, str(tmp_path), fmt="text")
    assert [(f.name, f.dataType) for f in got.schema] == [
        (f.name, f.dataType) for f in TWEET_ROW
    ]
    assert rows(got) == sorted((x for x in lines.values() if x), key=repr)


def test_each_status_is_parsed_once(spark, tmp_path):
    (tmp_path / "log.txt").write_text(status(), encoding="utf-8")
    assert plan(read_tweets(spark, str(tmp_path), fmt="text")).count("from_json") == 1


def test_rejected_statuses(spark):
    reasons = {
        '{"text": "cut o': "bad_json",
        "": "bad_json",
        " ": "bad_json",
        None: "bad_json",
        status(retweeted="yes"): "bad_field",
        status(user=[1]): "bad_field",
        '{"limit":{"track":3}}': "no_text",
        status(text=None): "no_text",
        status(created_at="yesterday"): "bad_time",
        status(created_at=...): "bad_time",
        status(): None,
    }
    raw = spark.createDataFrame([(i, v) for i, v in enumerate(reasons)], "n int, value string")
    got = {r["value"]: r["reason"] for r in rejected_statuses(raw).collect()}
    assert got == {v: reason for v, reason in reasons.items() if reason}
    assert tweet_rows(raw).count() == 1


def test_tweets_of_a_range(spark, small):
    path = land_raw_statuses(spark, small)
    whole = rows(read_tweets(spark, path))
    parts = [read_tweets(spark, path, end=50), read_tweets(spark, path, start=50)]
    assert sorted(rows(parts[0]) + rows(parts[1]), key=repr) == whole
    assert received_count(read_tweets(spark, path), by=[]).first()["received"] == len(whole)


def test_log_without_ordinals(spark, raw_small, tmp_path):
    raw_small.drop("ordinal").write.parquet(f"{tmp_path}/log")
    edits = read_edits(spark, f"{tmp_path}/log", channel=None)
    events = read_edit_events(spark, f"{tmp_path}/log", channel=None)
    assert edits.count() == events.count() == parse_edits(raw_small).count() > 0
