"""From raw lines to edits. Every operator takes a batch or a streaming frame."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.flags import flag_mask, flag_tests, highest_flag
from feedloom.functions.lines import byte_diff, delimited_fields, strip_irc_format
from feedloom.operators.log import log_head, reject_columns, replay_range
from feedloom.schemas import EDIT_EVENT, REJECTED_EDIT

_MADE = frozenset(
    ["title", "flags", "diffurl", "user", "bytediff", "summary", "reason", "parts"]
    + ["_plain", "_fields", "_unmatched"]
)


def for_channel(raw: DataFrame, channel: str | None) -> DataFrame:
    """Lines of one channel; of all channels when ``channel`` is None."""
    return raw if channel is None else raw.where(F.col("channel") == channel)


def line_parts(raw: DataFrame) -> DataFrame:
    """``raw`` with an array ``parts``, see ``delimited_fields``; null where a line is no edit.

    The array comes out of a generator because the optimizer would otherwise copy its
    expression into the filters above, and so match each line twice.
    """
    text = raw.withColumn("_plain", strip_irc_format(F.col("line")))
    text = text.withColumn("_fields", delimited_fields(F.col("_plain")))
    found = F.when(~F.startswith("_fields", F.lit("\n")), F.col("_fields"))
    parts = F.explode(F.array(F.split(found, "\n", -1))).alias("parts")
    return text.select(*raw.columns, parts)


def judge_edits(raw: DataFrame) -> DataFrame:
    """Every line with the texts found in it, and in ``reason`` why it is no edit, if it is none.

    For those who want edits and rejects from one pass over the log. The log may have further
    columns, but none named like one that is added.
    """
    reject_columns(raw, _MADE)
    parts = F.col("parts")
    # a generator again, so that the number is read once, not in the filter and above it
    found = F.struct(
        parts.isNull().alias("_unmatched"),
        parts[1].alias("title"),
        parts[2].alias("flags"),
        parts[3].alias("diffUrl"),
        parts[4].alias("user"),
        byte_diff(parts[5]).alias("byteDiff"),
        parts[6].alias("summary"),
    )
    reason = (
        F.when(F.col("_unmatched"), "no_match")
        .when(F.col("byteDiff").isNull(), "bad_byte_diff")
        .when(F.col("channel").isNull(), "null_field")
    )
    judged = line_parts(raw).select(*raw.columns, F.inline(F.array(found)))
    return judged.withColumn("reason", reason).drop("_unmatched")


def parse_edits(raw: DataFrame) -> DataFrame:
    """The edits among the lines, with the texts found in them."""
    return judge_edits(raw).where(F.col("reason").isNull()).drop("line", "reason")


def rejected_edits(raw: DataFrame) -> DataFrame:
    """The lines that are no edits, with the reason."""
    return judge_edits(raw).where(F.col("reason").isNotNull()).select(*REJECTED_EDIT.names)


def edit_flags(edits: DataFrame) -> DataFrame:
    """Adds the six tests on flags and title."""
    return edits.withColumns(flag_tests(F.col("flags"), F.col("title")))


def flag_code(edits: DataFrame) -> DataFrame:
    """Adds ``flag``, the bit of the last test that holds, and ``flag_mask`` with all of them."""
    return edits.withColumns({"flag": highest_flag(), "flag_mask": flag_mask()})


def edit_rows(edits: DataFrame) -> DataFrame:
    """The seven columns of an edit row."""
    return edits.select(
        F.timestamp_millis("received_ms").alias("timestamp"),
        "channel",
        "title",
        "diffUrl",
        "user",
        "byteDiff",
        "summary",
    )


def edit_events(edits: DataFrame) -> DataFrame:
    """The fourteen columns of an edit event."""
    flagged = flag_code(edit_flags(edits))
    return flagged.withColumnRenamed("received_ms", "timeStamp").select(*EDIT_EVENT.names)


def edits_head(edits: DataFrame, n: int = 20, ordinal: str = "ordinal") -> DataFrame:
    """The ``n`` first edits; each task keeps at most ``n`` rows."""
    return edits.orderBy(ordinal).limit(n)


def first_edits(raw: DataFrame, n: int = 20, ordinal: str = "ordinal") -> DataFrame:
    """The ``n`` first edits of a log, without a parse of all of it.

    Ranges of ordinals from the start on are read, each eight times as long as the one before,
    until there are ``n`` edits or the log ends. A range reaches the scan, which skips row
    groups beyond it. Lines without an ordinal are not among the first.
    """
    head = log_head(raw, ordinal).first()["head"]
    end = 8 * n
    while True:
        lines = replay_range(raw, None, min(end, head), ordinal)
        found = edits_head(parse_edits(lines), n, ordinal)
        if end >= head or found.count() == n:
            return found
        end *= 8
