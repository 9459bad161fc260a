"""The same results in plain SQL, for DuckDB over the same tables."""

from feedloom import fixed_values as fixed
from feedloom.plans.fixtures import FIRST_STATUS_S, ODD_STATUSES, RAW_EDITS_SQL
from feedloom.plans.queries import CURVE_START_MS, DEMO_CHANNEL

_RAW = RAW_EDITS_SQL.format(ms="epoch_us(ts) // 1000", src="events")

_CTES = f"""
WITH raw AS ({_RAW}),
found AS (
 SELECT *, regexp_matches(line, '{fixed.EDIT_LINE_PATTERN}') AS is_edit,
  regexp_extract(line, '{fixed.EDIT_LINE_PATTERN}',
   ['title', 'flags', 'diffUrl', 'user', 'number', 'summary']) AS f
 FROM raw),
judged AS (
 SELECT *, CASE WHEN is_edit IS NOT TRUE THEN 'no_match'
  WHEN NOT regexp_matches(f.number, '^[+-]?[0-9]+$') OR try_cast(f.number AS INTEGER) IS NULL
   THEN 'bad_byte_diff'
  WHEN channel IS NULL THEN 'null_field' END AS reason
 FROM found),
parsed AS (
 SELECT ordinal, received_ms, channel, f.title AS title, f.flags AS flags,
  f.diffUrl AS diffUrl, f."user" AS "user", try_cast(f.number AS INTEGER) AS byteDiff,
  f.summary AS summary
 FROM judged WHERE reason IS NULL),
tests AS (
 SELECT *, contains(flags, 'M') AS isMinor, contains(flags, 'N') AS isNew,
  contains(flags, '!') AS isUnpatrolled, contains(flags, 'B') AS isBotEdit,
  starts_with(title, 'Special:') AS isSpecial, starts_with(title, 'Talk:') AS isTalk
 FROM parsed),
flagged AS (
 SELECT *, CAST(CASE WHEN isTalk THEN 32 WHEN isSpecial THEN 16 WHEN isBotEdit THEN 8
   WHEN isUnpatrolled THEN 4 WHEN isNew THEN 2 WHEN isMinor THEN 1 ELSE 0 END AS INTEGER) AS flag,
  CAST(CASE WHEN isMinor THEN 1 ELSE 0 END + CASE WHEN isNew THEN 2 ELSE 0 END
   + CASE WHEN isUnpatrolled THEN 4 ELSE 0 END + CASE WHEN isBotEdit THEN 8 ELSE 0 END
   + CASE WHEN isSpecial THEN 16 ELSE 0 END + CASE WHEN isTalk THEN 32 ELSE 0 END
   AS INTEGER) AS flag_mask
 FROM tests)
"""

_ROW = (
    "make_timestamp(received_ms * 1000) AS timestamp, channel, title, diffUrl, "
    '"user", byteDiff, summary'
)
_EDITS = f"{_CTES} SELECT {_ROW} FROM parsed"
_EVENTS = (
    f"{_CTES} SELECT received_ms AS timeStamp, channel, title, diffUrl, "
    '"user", byteDiff, summary, isMinor, isNew, isUnpatrolled, isBotEdit, isSpecial, isTalk, '
    "flag FROM flagged"
)
_TOP = ", top AS (SELECT coalesce(max(ordinal), -1) AS head FROM raw)"
_MIDDLE = (
    f"WITH raw AS ({_RAW}){_TOP} "
    "SELECT raw.* FROM raw, top WHERE ordinal > head // 4 AND ordinal <= head * 3 // 4"
)
_ORDINALS = (
    f"WITH raw AS ({_RAW}) "
    "SELECT row_number() OVER (ORDER BY received_ms NULLS FIRST, channel NULLS FIRST, "
    "line NULLS FIRST) - 1 AS ordinal, "
    "received_ms, channel, line FROM raw"
)
_REASON = "CASE " + " ".join(
    f"WHEN {'text IS NULL OR ' if reason == 'no_text' else ''}doc_id % {n} = 0 THEN '{reason}'"
    for reason, n in ODD_STATUSES.items()
) + " END"
_STATUSES = f"""
WITH statuses AS (
 SELECT doc_id AS ordinal, text, source AS "user", lang AS userLang,
  make_timestamp(({FIRST_STATUS_S} + doc_id) * 1000000) AS createdDate,
  doc_id % 5 = 0 AS isRetweeted, {_REASON} AS reason
 FROM documents),
top AS (SELECT coalesce(max(doc_id), -1) AS head FROM documents)
"""
_TWEET = 'text, "user", userLang, createdDate, isRetweeted'
_TWEETS = f"{_STATUSES} SELECT {_TWEET} FROM statuses WHERE reason IS NULL"


def _curve(rate: int, ramp: int, second: str = "s") -> str:
    """Rows by a second, as the sum of the speeds of the seconds before; none before second 0."""
    second = f"greatest({second}, 0)"
    r = f"least({second}, {ramp})"
    in_ramp = f"{rate // (ramp + 1)} * (CAST({r} AS HUGEINT) * ({r} + 1) // 2)"
    return f"CAST({in_ramp} AS BIGINT) + ({second} - {r}) * {rate}"


_STEP = 1000 * fixed.COUNTER_PARTITIONS // fixed.COUNTER_ROWS_PER_SECOND

ORACLE: dict[str, str] = {
    "edits": _EDITS,
    "edits_channel": f"{_EDITS} WHERE channel = '{DEMO_CHANNEL}'",
    "edit_events": _EVENTS,
    "edit_flags": (
        f"{_CTES} SELECT ordinal, isMinor, isNew, isUnpatrolled, isBotEdit, isSpecial, isTalk, "
        "flag, flag_mask FROM flagged"
    ),
    "edit_rejects": (
        f"{_CTES} SELECT ordinal, channel, line, reason FROM judged WHERE reason IS NOT NULL"
    ),
    "irc_format": _EDITS,
    "edits_count": f"{_CTES} SELECT count(*) AS n FROM parsed",
    "edits_head": f"{_CTES} SELECT ordinal, {_ROW} FROM parsed ORDER BY ordinal LIMIT 20",
    "log_head": f"WITH raw AS ({_RAW}) SELECT coalesce(max(ordinal), -1) AS head FROM raw",
    "replay_range": _MIDDLE,
    "log_range": _MIDDLE,
    "log_head_manifest": (
        f"WITH raw AS ({_RAW}) SELECT coalesce(max(ordinal), -1) AS head FROM raw"
    ),
    "backlog": (
        f"WITH raw AS ({_RAW}), top AS (SELECT coalesce(max(ordinal), -1) AS head FROM raw) "
        "SELECT raw.* FROM raw, top WHERE ordinal > head // 2"
    ),
    "log_ordinals": _ORDINALS,
    "log_ordinals_stream": _ORDINALS,
    "edits_stream": _EDITS,
    "edits_channel_stream": f"{_EDITS} WHERE channel = '{DEMO_CHANNEL}'",
    "edit_events_stream": _EVENTS,
    "edit_events_gaps": (
        f"{_CTES}{_TOP} SELECT received_ms AS timeStamp, channel, title, diffUrl, "
        '"user", byteDiff, summary, isMinor, isNew, isUnpatrolled, isBotEdit, isSpecial, isTalk, '
        "flag FROM flagged, top WHERE ordinal <= head // 4 OR ordinal > head * 3 // 4"
    ),
    "edits_live": (
        f"{_CTES}{_TOP}, looks AS (SELECT 0 AS look, -1 AS upto UNION ALL "
        "SELECT 1, head // 2 FROM top UNION ALL SELECT 2, head FROM top) "
        "SELECT look, (SELECT count(*) FROM parsed WHERE ordinal <= upto) AS n FROM looks"
    ),
    "edits_handover": _EDITS,
    "received_running": f"{_CTES} SELECT count(*) AS received FROM parsed",
    "received_count": f"{_CTES} SELECT channel, count(*) AS received FROM parsed GROUP BY channel",
    "received_total": f"{_CTES} SELECT count(*) AS received FROM parsed",
    "rate_curve": (
        f"WITH raw AS ({_RAW}), "
        "seconds AS (SELECT ordinal, "
        f"CAST(floor((received_ms - {CURVE_START_MS}) / 1000.0) AS BIGINT) AS s FROM raw) "
        f"SELECT ordinal, s AS second, {_curve(1, 0)} AS steady, {_curve(10, 4)} AS short_ramp, "
        f"{_curve(3, 9)} AS starved_ramp, {_curve(2_000_003, 1_500_000)} AS long_ramp FROM seconds"
    ),
    "due_times": f"""
WITH raw AS ({_RAW}),
bounds AS (SELECT {_curve(7, 6, '1')} AS a, {_curve(7, 6, '500')} AS b),
places AS (
 SELECT ordinal, CASE WHEN ordinal >= a AND ordinal < b THEN
  CAST(ordinal - a AS DOUBLE) * (CAST(499000 AS DOUBLE) / CAST(b - a AS DOUBLE)) END AS x
 FROM raw, bounds)
SELECT ordinal, make_timestamp(({CURVE_START_MS + 1000} + CAST(floor(x) AS BIGINT)
  + CASE WHEN x - floor(x) >= 0.5 THEN 1 ELSE 0 END) * 1000) AS due
FROM places
""",
    "due_times_stepped": f"""
WITH raw AS ({_RAW})
SELECT ordinal, make_timestamp(
 ({CURVE_START_MS} + ordinal // {fixed.COUNTER_PARTITIONS} * {_STEP}) * 1000) AS due
FROM raw
""",
    "tweets": _TWEETS,
    "tweet_rejects": (
        f"{_STATUSES} SELECT ordinal, reason FROM statuses WHERE reason IS NOT NULL"
    ),
    "tweets_stream": _TWEETS,
    "tweets_replay": (
        f"{_STATUSES} SELECT {_TWEET} FROM statuses, top WHERE reason IS NULL "
        "AND ordinal > head // 4 AND ordinal <= head * 3 // 4"
    ),
    "tweets_backlog": (
        f"{_STATUSES} SELECT ordinal, {_TWEET} FROM statuses, top "
        "WHERE reason IS NULL AND ordinal > head // 2"
    ),
    "tweets_head": f"{_STATUSES} SELECT head FROM top",
    "tweets_received": (
        f'{_STATUSES} SELECT "user", userLang, count(*) AS received FROM statuses '
        'WHERE reason IS NULL GROUP BY "user", userLang'
    ),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
