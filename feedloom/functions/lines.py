"""Column functions over one chat line."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.fixed_values import IRC_FORMAT_PATTERN

_FORMAT_CODES = "\x02\x03\x0f\x11\x16\x1d\x1e\x1f"
_LINE_ENDS = "\n\r\u0085\u2028\u2029"  # what "." does not match

# An edit line, see EDIT_LINE_PATTERN, has five greedy fields. Matched as it stands, the time
# grows with the fourth power of the length when a long line almost matches. Two other forms
# give the same fields. Both put them on lines of their own: "." matches no line end, so no
# field holds one. Their second alternative takes any text, with all fields empty.

# For text without line ends: the pattern of the reversed line. Greedy fields read from the
# left mean that the last possible "* (n)" counts, before it the last "*", before that the last
# blank and the last "]]", and then the first "[[". Read from the end, each of these is simply
# the next one, and a later choice can never succeed where the next one failed. So no group has
# to give anything back, and the time is linear. The last group is set in a match only.
_BACKWARD = (
    r"^(?>(.*?)\s\)(\d*?.)\+?\(\s\*\s)"
    r"(?>(.*?)\s\*\s)"
    r"(?>(.*?)\s)"
    r"(?>(.*?)\s\]\])"
    r"(.*)(\[\[).*$"
    r"|^.*$"
)
_BACKWARD_FIELDS = "$1\n$2\n$3\n$4\n$5\n$6\n$7"

# For any text: a separator may be a line end, so what comes next depends on the line one is on. A
# field ends at its last separator from which the rest can be reached. Which separators these are
# is found from the end of the text, by one replacement for each kind, which puts marks at them:
# a at the blank before "* (n)"; b at the blank before a "*" that is followed by one with a on its
# line; c at a blank that is followed by one with b; d at a "]]" and blank followed by one with c.
# A mark stands for all places to the left of it on its line, and a line end can be a separator
# itself; then it stands for the line before. Each replacement reads a line once or twice, going
# on where the last match on the line ended (\G). With the marks in place every field ends at the
# last mark of its kind on the line, and nothing has to be tried again, so the time is linear.
# Marks begin with a character that "." does not match, so no field holds one. Texts may have it:
# there it only divides, as does another that it is turned into.
_MARK = "\u0085"
_BREAK = "\u2029"
_IN_LINE = rf"[^\n\r{_BREAK}]"
_BLANK = r"[ \t\x0B\f]"
_NO_BLANK = rf"[^\n\r{_BREAK} \t\x0B\f]"


def _mark(kinds: str) -> str:
    """A mark of one of these kinds in reversed text."""
    return f"[{kinds}]{_MARK}"


_AT_LINE_END = rf"(?!{_mark('b')}(?:{_mark('a')})?[\n\r])"
_MARKS = [
    (r"(\s\)\d*.\+?\(\s\*)(?=\s)", f"$1a{_MARK}"),
    (
        rf"((?:(?<={_BLANK}\*|{_mark('a')}[\n\r]\*)\G|{_mark('a')}\s){_IN_LINE}*?\s\*)"
        rf"(?=(?:{_mark('a')})?\s)",
        f"$1b{_MARK}",
    ),
    (
        rf"({_mark('b')}(?:{_mark('a')})?\s(?:{_AT_LINE_END}{_NO_BLANK})*+)"
        rf"((?:{_AT_LINE_END}{_IN_LINE})*+)",
        f"$1c{_MARK}$2c{_MARK}",
    ),
    (
        rf"((?:(?<={_BLANK}|{_mark('c')}(?:{_mark('abc')}){{0,3}}[\n\r])\G"
        rf"|{_mark('c')}(?:{_mark('abc')})*+\s){_IN_LINE}*?\s)(?=\]\])",
        f"$1d{_MARK}",
    ),
]


def _end(kind: str) -> str:
    """A separator of a kind: a blank with its mark among others."""
    others = "abcd".replace(kind, "")
    return rf"\s(?:{_MARK}[{others}])*+{_MARK}{kind}(?:{_MARK}[abcd])*+"


_SPACE = rf"\s(?:{_MARK}[abcd])*+"
_FORWARD = (
    rf"^(?s:.*?)[\n\r{_BREAK}](?>{_IN_LINE}*?\[\[)"
    rf"(?>({_IN_LINE}*)\]\]{_MARK}d){_SPACE}"
    rf"(?>({_IN_LINE}*){_end('c')})"
    rf"(?>({_IN_LINE}*){_end('b')}\*){_SPACE}"
    rf"(?>({_IN_LINE}*){_end('a')}\*){_SPACE}"
    rf"\(\+?({_IN_LINE}(?:{_MARK}[abcd])*+\d*)\){_SPACE}({_IN_LINE}*)(?s:.*)"
    r"|^(?s:.*)"
)
_FORWARD_FIELDS = "$5\n$1\n$2\n$3\n$4\n$5\n$6"

_WHOLE_NUMBER = "^[+-]?[0-9]+$"
_OTHER_DIGIT_FIRST = r"^\p{Nd}[0-9]*$"


def _has_any(text: Column, characters: str) -> Column:
    """Byte search, far cheaper than a regular expression on text that has none of them."""
    found = F.contains(text, F.lit(characters[0]))
    for character in characters[1:]:
        found = found | F.contains(text, F.lit(character))
    return found


def strip_irc_format(line: Column) -> Column:
    """``line`` without colour and format codes."""
    plain = F.regexp_replace(line, F.lit(IRC_FORMAT_PATTERN), F.lit(""))
    return F.when(_has_any(line, _FORMAT_CODES), plain).otherwise(line)


def delimited_fields(line: Column) -> Column:
    """The parts of an edit line as seven texts with a newline between them.

    Title, flags, diff URL, user, number and summary stand at 1 to 6. At 0 stands a text that
    is empty exactly when the line is no edit.
    """
    marked = F.reverse(F.translate(line, f"{_MARK}\u2028", _BREAK * 2))
    for pattern, with_mark in _MARKS:
        marked = F.regexp_replace(marked, F.lit(pattern), F.lit(with_mark))
    lines = F.reverse(F.concat(marked, F.lit("\n")))  # each line comes after a line end
    forward = F.regexp_replace(lines, F.lit(_FORWARD), F.lit(_FORWARD_FIELDS))
    forward = F.regexp_replace(forward, F.lit(f"{_MARK}[abcd]"), F.lit(""))
    backward = F.regexp_replace(F.reverse(line), F.lit(_BACKWARD), F.lit(_BACKWARD_FIELDS))
    return F.when(_has_any(line, _LINE_ENDS), forward).otherwise(F.reverse(backward))


def byte_diff(number: Column) -> Column:
    """The number as an int; null when it is none or does not fit.

    A plain cast would take blanks around the number too. The first digit, the only character
    the pattern leaves open, may be one of another script. In Unicode the digits of a script
    start at a multiple of 16, and 6 after it in two ranges.
    """
    code = F.ascii(number)
    late = code.between(0x0966, 0x0DEF) | code.between(0x1946, 0x194F)
    digit = code % 16 - F.when(late, 6).otherwise(0)
    translated = F.concat(digit.cast("string"), F.substr(number, F.lit(2)))
    other = number.rlike(_OTHER_DIGIT_FIRST) & (code < 0x10000)
    return F.when(number.rlike(_WHOLE_NUMBER), number.try_cast("int")).when(
        other, translated.try_cast("int")
    )
