"""Column functions for what an edit's flags text and title say."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom import fixed_values as fixed


def flag_tests(flags: Column, title: Column) -> dict[str, Column]:
    return {
        "isMinor": F.contains(flags, F.lit(fixed.MINOR_MARK)),
        "isNew": F.contains(flags, F.lit(fixed.NEW_MARK)),
        "isUnpatrolled": F.contains(flags, F.lit(fixed.UNPATROLLED_MARK)),
        "isBotEdit": F.contains(flags, F.lit(fixed.BOT_MARK)),
        "isSpecial": F.startswith(title, F.lit(fixed.SPECIAL_PREFIX)),
        "isTalk": F.startswith(title, F.lit(fixed.TALK_PREFIX)),
    }


FLAG_BITS = {
    "isMinor": fixed.IS_MINOR,
    "isNew": fixed.IS_NEW,
    "isUnpatrolled": fixed.IS_UNPATROLLED,
    "isBotEdit": fixed.IS_BOT_EDIT,
    "isSpecial": fixed.IS_SPECIAL,
    "isTalk": fixed.IS_TALK,
}


def highest_flag() -> Column:
    """The bit of the highest flag that is set, 0 if none is."""
    return F.greatest(*_set_bits()).alias("flag")


def flag_mask() -> Column:
    """All flags that are set, as one bit mask."""
    return sum(_set_bits(), F.lit(0)).alias("flag_mask")


def _set_bits() -> list[Column]:
    return [F.when(F.col(name), bit).otherwise(0) for name, bit in FLAG_BITS.items()]
