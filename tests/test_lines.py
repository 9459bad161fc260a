"""Edit lines: golden lines, the two forms of the pattern, rejects and flags."""

import itertools
import random
import time
import unicodedata

from conftest import plan, rows
from pyspark.sql import functions as F

from feedloom import (
    edit_events,
    edit_flags,
    edit_rows,
    flag_code,
    judge_edits,
    parse_edits,
    rejected_edits,
)
from feedloom.fixed_values import EDIT_LINE_PATTERN
from feedloom.functions.lines import byte_diff, delimited_fields, strip_irc_format
from feedloom.operators.edits import line_parts
from feedloom.plans.fixtures import coloured
from feedloom.schemas import EDIT_EVENT, EDIT_ROW, REJECTED_EDIT

RAW = "ordinal bigint, received_ms bigint, channel string, line string"
GREEDY = "[[Talk:A]] !N http://x * 1.2.3.4 * (+0) see [[B]] * c * (+9) tail"

# line -> title, flags, diffUrl, user, byteDiff, summary, flag, flag_mask
EDITS = {
    "[[Foo]] MB http://x * Bob * (+12) fix": ("Foo", "MB", "http://x", "Bob", 12, "fix", 8, 9),
    "[[Foo]]  http://x * Bob * (-3) ": ("Foo", "", "http://x", "Bob", -3, "", 0, 0),
    GREEDY: (
        "Talk:A",
        "!N http://x * 1.2.3.4 * (+0) see",
        "[[B]]",
        "c",
        9,
        "tail",
        32,
        38,
    ),
    "[[Special:Log/x]] create  * Bob * (5) y": (
        "Special:Log/x",
        "create",
        "",
        "Bob",
        5,
        "y",
        16,
        16,
    ),
    "[[Foo]] M http://x * Bob * (++5) y": ("Foo", "M", "http://x", "Bob", 5, "y", 1, 1),
    "pre [[Foo]] M http://x * Bob * (7) l1\nl2": ("Foo", "M", "http://x", "Bob", 7, "l1", 1, 1),
    "[[User talk:A]] ! http://x * Bob * (0) y": (
        "User talk:A",
        "!",
        "http://x",
        "Bob",
        0,
        "y",
        4,
        4,
    ),
    "[[[Foo]]]\tN\thttp://x\t*\tBob\t*\t(1)\ty": ("[Foo]", "N", "http://x", "Bob", 1, "y", 2, 2),
    "[[Foo]]\nM\nhttp://x\n*\nBob\n*\n(1)\ny": ("Foo", "M", "http://x", "Bob", 1, "y", 1, 1),
    "[[Foo]] M http://x * Bob * (٣) y": ("Foo", "M", "http://x", "Bob", 3, "y", 1, 1),
    "[[Foo]] M http://x * Bob * (2147483647) y": (
        "Foo",
        "M",
        "http://x",
        "Bob",
        2147483647,
        "y",
        1,
        1,
    ),
}
REJECTS = {
    "[[Foo]]  http://x * Bob * (-3)": "no_match",
    "[[Special:Log/block]] block * Bob * blocked": "no_match",
    "": "no_match",
    "[[\n\n\n\n\n\n": "no_match",
    "[[Foo]] M http://x * Bob * (+) y": "bad_byte_diff",
    "[[Foo]] M http://x * Bob * ( 5) y": "bad_byte_diff",
    "[[Foo]] M http://x * Bob * (+99999999999) y": "bad_byte_diff",
    "[[Foo]] M http://x * Bob * (2147483648) y": "bad_byte_diff",
    "[[Foo]] M http://x * Bob * (x) y": "bad_byte_diff",
}


def raw_of(spark, lines, channel="#c"):
    return spark.createDataFrame([(i, 5, channel, line) for i, line in enumerate(lines)], RAW)


def test_golden_edits(spark):
    edits = flag_code(edit_flags(parse_edits(raw_of(spark, EDITS))))
    names = ["title", "flags", "diffUrl", "user", "byteDiff", "summary", "flag", "flag_mask"]
    got = {r["ordinal"]: tuple(r[n] for n in names) for r in edits.collect()}
    assert got == dict(enumerate(EDITS.values()))


def test_golden_rejects(spark):
    got = rejected_edits(raw_of(spark, REJECTS))
    assert got.columns == REJECTED_EDIT.names
    assert {r["line"]: r["reason"] for r in got.collect()} == REJECTS


def test_missing_channel_and_line(spark):
    edit = next(iter(EDITS))
    raw = spark.createDataFrame([(0, 5, None, edit), (1, 5, "#c", None), (2, 5, None, "x")], RAW)
    reasons = {r["ordinal"]: r["reason"] for r in rejected_edits(raw).collect()}
    assert reasons == {0: "null_field", 1: "no_match", 2: "no_match"}
    assert parse_edits(raw).count() == 0


def test_edits_and_rejects_are_all_lines(raw_small):
    kept = parse_edits(raw_small).select("ordinal")
    left = rejected_edits(raw_small).select("ordinal")
    assert rows(kept.unionAll(left)) == rows(raw_small.select("ordinal"))


def test_one_pass_gives_edits_and_rejects(raw_small):
    judged = judge_edits(raw_small).cache()
    edits = judged.where("reason IS NULL").drop("line", "reason")
    assert rows(edits) == rows(parse_edits(raw_small))
    rejects = judged.where("reason IS NOT NULL").select("ordinal", "channel", "line", "reason")
    assert rows(rejects) == rows(rejected_edits(raw_small))


def random_lines(n, line_ends):
    choice = random.Random(11).choice
    number = random.Random(12).randint
    tokens = ["[[", "]]", "[", "]", " ", "*", "(", ")", "+", "-", "1", "12", "a", "M", "!", "\t"]
    tokens += [" * ", " * (", "(+1) ", "]] ", " * (+", "é", "😀", "\x0b", "\x1c"] + line_ends

    def some(most):
        return "".join(choice(tokens) for _ in range(number(0, most)))

    for i in range(n):
        if i % 2:
            yield some(28)
        else:
            yield f"[[{some(4)}]] {some(6)} x * {some(6)} * ({some(3)}) {some(8)}"


def test_fields_equal_those_of_the_pattern(spark):
    """Both forms of the pattern give what the plain pattern gives, on lines full of traps."""
    lines = [*random_lines(30000, []), *random_lines(10000, ["\n", "\r", "\u0085", "\u2028"])]
    lines = spark.createDataFrame([(x,) for x in lines], "line string")
    groups = [F.regexp_extract("line", EDIT_LINE_PATTERN, i) for i in range(1, 7)]
    expected = F.when(F.col("line").rlike(EDIT_LINE_PATTERN), F.array(*groups))
    parts = F.split(delimited_fields(F.col("line")), "\n", -1)
    got = F.when(parts[0] != "", F.slice(parts, 2, 6))
    both = lines.select("line", expected.alias("expected"), got.alias("got")).cache()
    assert both.where("expected IS NOT NULL").count() > 3000
    assert both.where("expected IS NULL").count() > 3000
    assert both.where("NOT (expected <=> got)").collect() == []
    assert lines.where(F.size(parts) != 7).count() == 0


def texts_with_line_ends(n):
    """Fields and separators in their order or in none, with line ends in all places."""
    rng = random.Random(13)
    parts = ["[[", "]]", "[", "]", " ", "*", "(", ")", "+", "1", "a", "\t", "\n", "\n", "\r"]
    parts += ["\u0085", "\u2029", " * ", " *\n", "\n* ", "\n*\n", " * (1) ", "\n* (2)\n"]
    parts += [" *\n(+3) ", "]] ", "]]\n", "(4)\n", "é", "\x0b"]

    def some(most):
        return "".join(rng.choice(parts) for _ in range(rng.randint(0, most)))

    def blank():
        return rng.choice(" \n \r\t")

    for i in range(n):
        if i % 3:
            number = rng.choice(["5", "+5", "a", " ", ")", "+12", "+", "53"])
            fields = [some(5) + "[[" + some(3) + "]]", some(3), some(3), "*", some(3), "*"]
            text = "".join(f + blank() for f in [*fields, f"({number})"]) + some(6)
        else:
            text = some(30)
        yield text + "\n"


def test_fields_of_texts_with_line_ends(spark):
    lines = spark.createDataFrame([(x,) for x in texts_with_line_ends(100_000)], "line string")
    groups = [F.regexp_extract("line", EDIT_LINE_PATTERN, i) for i in range(1, 7)]
    expected = F.when(F.col("line").rlike(EDIT_LINE_PATTERN), F.array(*groups))
    parts = F.split(delimited_fields(F.col("line")), "\n", -1)
    got = F.when(parts[0] != "", F.slice(parts, 2, 6))
    both = lines.repartition(4).select(
        "line", expected.alias("expected"), got.alias("got"), F.size(parts).alias("n")
    )
    both = both.cache()
    assert both.where("expected IS NOT NULL").count() > 10_000
    assert both.where("NOT (expected <=> got) OR n != 7").collect() == []


def test_time_is_linear_for_texts_with_line_ends(spark):
    """The first of these took 141 s when it was tried place by place."""

    def texts(n):
        return [
            " * (1) [[a" + "]] b * c " * n + "\n",
            "[[a" + "]] b * c " * n + "\n * (1) x",
            "\n".join(["[[a" + "]] b * c " * 10] * (n // 10)) + " * (1) x\n",
            "[[" * n * 5 + " ]] * (1) x\n",
            " * (1)" * n + "\n",
            "\n * (1)" * n,
            "[[a]] b c * d * (1 " * n + "\n",
            "]] " * n * 4 + " * * (1) \n",
            "\n" * n * 10,
            "[[a]]\n" * n + "b c * d * (1) x",
            "(11111111" * n + "\n",
        ]

    for text in texts(100) + texts(16_000):
        frame = spark.createDataFrame([(text,)], "line string")
        started = time.time()
        frame.select(delimited_fields(F.col("line"))).collect()
        assert time.time() - started < (1 if len(text) > 50_000 else 10)


def test_time_is_linear_for_long_lines_that_do_not_match(spark):
    """With the plain pattern the first of these takes 44 s at a length of 1450."""
    long = [
        " * (1) [[a" + "]] b * c " * 20000,
        "[[a]] " + " * x ]] [[ (1) " * 20000,
        "[[a]] b * " * 30000,
        "\n[[a]] b * x " * 20000,
    ]
    started = time.time()
    assert rejected_edits(raw_of(spark, long)).count() == 4
    assert time.time() - started < 30


def test_time_for_long_texts_with_line_ends(spark):
    def texts(n):
        return [
            " * (1) [[a" + "]] b * c " * n + "\n",
            "[[a" + "]] b * c " * n + "\n * (1) x",
            "\n".join(["[[a" + "]] b * c " * 10] * (n // 10)) + " * (1) x\n",
            "[[" * n + " ]] * (1) x\n",
        ]

    def matched(raw, test):
        return [r["ordinal"] for r in raw.where(test).select("ordinal").collect()]

    plain = F.col("line").rlike(EDIT_LINE_PATTERN)
    assert matched(raw_of(spark, texts(10)), plain) == [2]
    assert matched(judge_edits(raw_of(spark, texts(10))), "reason IS NULL") == [2]
    started = time.time()
    assert matched(judge_edits(raw_of(spark, texts(1000))), "reason IS NULL") == [2]
    assert time.time() - started < 30


def test_nothing_is_left_of_lines_that_do_not_match(spark):
    lines = [" * * (+1) x", "\n * * (+1) x", "[[a]] b * (+1) x"]
    for r in judge_edits(raw_of(spark, lines)).collect():
        assert r["reason"] == "no_match"
        assert (r["title"], r["flags"], r["diffUrl"], r["user"], r["summary"]) == (None,) * 5


def test_long_text_is_kept_whole(spark):
    summary = "word " * 50000
    raw = raw_of(spark, [f"[[Foo]] M http://x * Bob * (1) {summary}"])
    assert parse_edits(raw).first()["summary"] == summary


def test_digits_of_all_scripts(spark):
    digits = {c: unicodedata.decimal(c, None) for c in map(chr, range(0x10000))}
    numbers = [(c + "4", d * 10 + 4) for c, d in digits.items() if d is not None]
    numbers += [("\U0001d7ce4", None), ("4٣", None), ("-٣", None), ("-7", -7), ("", None)]
    got = spark.createDataFrame(numbers, "number string, expected int")
    assert got.where(~byte_diff(F.col("number")).eqNullSafe(F.col("expected"))).collect() == []


def test_format_codes_are_stripped(spark):
    lines = {
        "\x0314[[\x0307Foo\x0314]]\x034 M\x0310 \x0302http://x\x03": "[[Foo]] M http://x",
        "\x02b\x0f \x033,12c\x03 \x1fu\x16 \x03": "b c u ",
        "plain 12,3": "plain 12,3",
        "\x03123": "3",
    }
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = df.select("line", strip_irc_format(F.col("line"))).collect()
    assert {r[0]: r[1] for r in got} == lines


def test_coloured_lines_give_the_same_edits(raw_small):
    colours = coloured(raw_small)
    lines = raw_small.where("line is not null").count()
    assert colours.where(F.col("line").contains("\x03")).count() == lines
    assert rows(parse_edits(colours)) == rows(parse_edits(raw_small))


def test_flag_is_the_highest_bit_of_the_mask(spark):
    marks = ["".join(c) for n in range(5) for c in itertools.combinations("MN!B", n)]
    titles = ["Foo", "Talk:Foo", "Special:Foo", "User talk:Foo", "special:Foo"]
    lines = [f"[[{t}]] {m} http://x * Bob * (1) y" for t in titles for m in marks]
    got = flag_code(edit_flags(parse_edits(raw_of(spark, lines)))).collect()
    assert len(got) == 80
    for r in got:
        assert r["flag"] == (1 << r["flag_mask"].bit_length() >> 1)
        bits = [("M", 1), ("N", 2), ("!", 4), ("B", 8)]
        expected = sum(bit for mark, bit in bits if mark in r["flags"])
        expected += 16 * r["title"].startswith("Special:") + 32 * r["title"].startswith("Talk:")
        assert r["flag_mask"] == expected


def test_schemas(raw_small):
    edits = parse_edits(raw_small)
    assert [(f.name, f.dataType) for f in edit_rows(edits).schema] == [
        (f.name, f.dataType) for f in EDIT_ROW
    ]
    assert [(f.name, f.dataType) for f in edit_events(edits).schema] == [
        (f.name, f.dataType) for f in EDIT_EVENT
    ]


def test_each_line_is_matched_once(raw_small):
    """The filter must not carry a copy of the match."""
    for df in (edit_events(parse_edits(raw_small)), rejected_edits(raw_small)):
        assert plan(df).count("reverse(regexp_replace") == 1
        # two tests of the number, in the one place that reads it
        assert plan(df).count("RLIKE") == 2
    assert line_parts(raw_small).columns == [*raw_small.columns, "parts"]
