"""These must be exactly as they are for results to be right."""

# The edit line: title, flags, diff URL, user, byte difference, summary.
EDIT_LINE_PATTERN = r"\[\[(.*)\]\]\s(.*)\s(.*)\s\*\s(.*)\s\*\s\(\+?(.\d*)\)\s(.*)"

# Bits of the flag code.
IS_MINOR = 1
IS_NEW = 2
IS_UNPATROLLED = 4
IS_BOT_EDIT = 8
IS_SPECIAL = 16
IS_TALK = 32

# Markers looked for in the flags text, and title prefixes.
MINOR_MARK = "M"
NEW_MARK = "N"
UNPATROLLED_MARK = "!"
BOT_MARK = "B"
SPECIAL_PREFIX = "Special:"
TALK_PREFIX = "Talk:"

# Defaults of the sources.
DEFAULT_CHANNEL = "#en.wikipedia"
RATE_ROWS_PER_SECOND = 1
RATE_RAMP_UP = "0s"
COUNTER_ROWS_PER_SECOND = 6
COUNTER_PARTITIONS = 5
BATCH_INTERVAL = "10 seconds"

# mIRC colour and format codes in a chat line.
IRC_FORMAT_PATTERN = "\x03(\\d{1,2}(,\\d{1,2})?)?|[\x02\x0f\x11\x16\x1d\x1e\x1f]"

# Creation time of a status, e.g. "Sun Mar 11 08:00:01 +0000 2018"; the weekday is not read.
STATUS_TIME_FORMAT = "MMM dd HH:mm:ss Z yyyy"

LONG_MAX = 2**63 - 1
