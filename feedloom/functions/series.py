"""Column functions of the rate series and of times."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.fixed_values import STATUS_TIME_FORMAT

_UNIT_MICROS = {
    "us": 1,
    "ms": 1_000,
    "s": 1_000_000,
    "m": 60_000_000,
    "min": 60_000_000,
    "h": 3_600_000_000,
    "d": 86_400_000_000,
}


def _div(left: Column, right: Column) -> Column:
    return F.call_function("div", left, right)


def elapsed_seconds(ms: Column, start_ms: int) -> Column:
    """Whole seconds from ``start_ms`` to ``ms``, below zero before it, rounded down."""
    since = ms - F.lit(start_ms).cast("bigint")
    second = F.lit(1000).cast("bigint")
    return _div(since - F.pmod(since, second), second)


def value_at_second(second: Column, rows_per_second: int, ramp_up_s: int) -> Column:
    """Number of rows emitted by the time ``second``.

    The speed grows by the same step each second of the ramp, so the ramp adds up to
    ``step * r * (r + 1) / 2``. The even one of ``r`` and ``r + 1`` is halved before anything
    is multiplied, so nothing overflows unless the result does. A rate that is too low for its
    ramp has a step of 0. Nothing has been emitted before second 0.
    """
    second = F.greatest(second.cast("bigint"), F.lit(0).cast("bigint"))
    ramp = F.lit(ramp_up_s).cast("bigint")
    after = F.greatest(second - ramp, F.lit(0).cast("bigint"))
    value = after * F.lit(rows_per_second).cast("bigint")
    step = rows_per_second // (ramp_up_s + 1)
    if ramp_up_s == 0 or step == 0:
        return value
    in_ramp = F.least(second, ramp)
    odd = in_ramp % F.lit(2).cast("bigint")
    half = F.shiftright(in_ramp + odd, 1)
    return half * (in_ramp + 1 - odd) * F.lit(step).cast("bigint") + value


def round_half_up(x: Column) -> Column:
    """``x`` to the nearest whole number, halves up. Exact: the fraction of a double is."""
    whole = F.floor(x)
    return whole + F.when(x - whole >= 0.5, 1).otherwise(0)


def status_time(created_at: Column) -> Column:
    """Creation time of a status, with or without a weekday; null when it cannot be read."""
    text = F.regexp_replace(created_at, r"^[A-Za-z]{3} (?=[A-Za-z]{3} )", "")
    return F.try_to_timestamp(text, F.lit(STATUS_TIME_FORMAT))


def whole_seconds(duration: str | int) -> int:
    """A duration such as ``5s`` in seconds, a smaller unit cut off. No unit means seconds."""
    found = re.fullmatch(r"(-?\d+)([a-z]*)", str(duration).strip().lower(), re.ASCII)
    unit = found and (found[2] or "s")
    if unit not in _UNIT_MICROS:
        raise ValueError(f"not a duration: {duration!r}")
    micros = int(found[1]) * _UNIT_MICROS[unit]
    return -(-micros // 1_000_000) if micros < 0 else micros // 1_000_000


def rows_by_second(second: int, rows_per_second: int, ramp_up_s: int) -> int:
    """``value_at_second`` for a bound of a range, which the driver has to know."""
    second = max(second, 0)
    in_ramp = min(second, ramp_up_s)
    step = rows_per_second // (ramp_up_s + 1)
    return step * (in_ramp * (in_ramp + 1) // 2) + (second - in_ramp) * rows_per_second
