"""When the rows of a log are due in a series of a given rate. No shuffle, nothing collected."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import fixed_values as fixed
from feedloom.functions.series import round_half_up, rows_by_second, whole_seconds


def _check_rate(rows_per_second: int, num_partitions: int = 1) -> None:
    if rows_per_second <= 0:
        raise ValueError(f"rows_per_second must be positive: {rows_per_second}")
    if num_partitions <= 0:
        raise ValueError(f"num_partitions must be positive: {num_partitions}")


def _check_ramp(rows_per_second: int, ramp_up: str | int) -> int:
    ramp_up_s = whole_seconds(ramp_up)
    if ramp_up_s < 0:
        raise ValueError(f"ramp_up must not be negative: {ramp_up!r}")
    if ramp_up_s > fixed.LONG_MAX // rows_per_second:
        raise OverflowError(f"a ramp of {ramp_up_s} s at {rows_per_second} rows/s is too long")
    return ramp_up_s


def due_times(
    log: DataFrame,
    start_s: int,
    end_s: int,
    start_time_ms: int,
    rows_per_second: int = fixed.RATE_ROWS_PER_SECOND,
    ramp_up: str | int = fixed.RATE_RAMP_UP,
    ordinal: str = "ordinal",
) -> DataFrame:
    """Adds ``due``: when a series that began at ``start_time_ms`` emits the row of each ordinal.

    The rows of the seconds from ``start_s`` to ``end_s`` are spread evenly over them. Rows of
    other seconds, and those without an ordinal, keep a null.
    """
    _check_rate(rows_per_second)
    ramp_up_s = _check_ramp(rows_per_second, ramp_up)
    if not 0 <= start_s <= end_s:
        raise ValueError(f"seconds are not in order: {start_s}, {end_s}")
    if end_s > fixed.LONG_MAX // rows_per_second:
        raise OverflowError(f"{end_s} s at {rows_per_second} rows/s is too long")
    first = rows_by_second(start_s, rows_per_second, ramp_up_s)
    last = rows_by_second(end_s, rows_per_second, ramp_up_s)
    ms_per_row = float((end_s - start_s) * 1000) / float(last - first) if last > first else 0.0
    value = F.col(ordinal)
    since_first = (value - F.lit(first).cast("bigint")).cast("double")
    ms = round_half_up(since_first * F.lit(ms_per_row)) + (start_time_ms + start_s * 1000)
    within = (value >= first) & (value < last)
    return log.withColumn("due", F.when(within, F.timestamp_millis(ms)))


def due_times_stepped(
    log: DataFrame,
    creation_ms: int,
    rows_per_second: int = fixed.COUNTER_ROWS_PER_SECOND,
    num_partitions: int = fixed.COUNTER_PARTITIONS,
    ordinal: str = "ordinal",
) -> DataFrame:
    """Adds ``due``: when one of ``num_partitions`` counters emits the row of each ordinal.

    They began at ``creation_ms``. Counter i emits i, i + n, i + 2n and so on, one row per step of ``1000 * n`` ms divided by
    the rate, whole ms. So the ordinal alone gives the time.
    """
    _check_rate(rows_per_second, num_partitions)
    step = 1000 * num_partitions // rows_per_second
    if step == 0:
        raise ValueError(f"more than {1000 * num_partitions} rows per second")
    turn = F.call_function("div", F.col(ordinal), F.lit(num_partitions).cast("bigint"))
    return log.withColumn("due", F.timestamp_millis(turn * step + creation_ms))
