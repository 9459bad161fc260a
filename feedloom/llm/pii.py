"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

Spark's regular expressions give the texts of all matches and the texts between them, from whose
lengths the places follow. No Python runs on the executors. The patterns in use give up nothing
they have matched and start no run in its middle, so that their time is linear in the text; they
match what the plain patterns beside them match, which tests compare.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lengths of IBANs by country.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
#: An IBAN of these has its country's length, so that it ends before the next word.
_LISTED = "(?:{})(?![A-Za-z0-9])".format(
    "|".join(
        rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{length - 4}}}"
        for length, codes in IBAN_LENGTHS.items()
    )
)
_CODES = "|".join(" ".join(IBAN_LENGTHS.values()).split())

#: Kinds in their order, and their plain patterns. The last is the method's own.
PLAIN_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # other countries: as long as it goes, up to a listed one
    "iban": rf"(?<![A-Za-z0-9])(?:{_LISTED}|(?!{_CODES})[A-Z]{{2}}[0-9]{{2}}"
    rf"(?:\x20?(?!(?<![A-Za-z0-9]){_LISTED})[A-Z0-9]){{11,30}}(?![A-Za-z0-9]))",
}
BASE_KINDS = ("email", "ip", "card", "phone")
#: Words that make a kind likelier when they stand close before it.
CONTEXT = {
    "email": "e-?mail|mail|contact|write",
    "ip": "ip|address|host|server",
    "card": "card|visa|credit|payment|debit",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|account|bank|transfer|konto|compte|cuenta",
}
#: Scores of a match: what its pattern says, what a checksum adds, what a word nearby adds.
PATTERN_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.4}
CHECKSUM_SCORE = {"card": 0.4, "iban": 0.4}
CONTEXT_SCORE = 0.2
CONTEXT_WIDTH = 40
#: Spans of the method's own kinds need this score.
LEAST_SCORE = 0.7
#: Spans whose places are added up in one go.
_RUN = 256


@dataclass(frozen=True)
class _Search:
    """``pattern`` finds what the plain one does; without ``hint`` in the text there is no span."""

    pattern: str
    hint: str


_SEARCH = {
    "email": _Search(
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"@[A-Za-z0-9-]++\.[A-Za-z0-9-]",
    ),
    "ip": _Search(
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]"
    ),
    "card": _Search(r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": _Search(PLAIN_PATTERNS["phone"], r"\+[0-9][\x20().0-9-]"),
    "iban": _Search(PLAIN_PATTERNS["iban"], r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]"),
}


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn test."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(
        numbers,
        lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def mod_97(iban: Column) -> Column:
    """Whether an IBAN, in capitals and perhaps with blanks, leaves 1 when divided by 97."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, F.length(plain)), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        letter = code >= 65
        return F.when(letter, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    characters = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.aggregate(characters, F.lit(0), step) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "iban":
        return mod_97(match)
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        value = lambda p: F.substring(p, 1, 3).cast("int")
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (value(p) <= 255))
    few, many = (12, 19) if kind == "card" else (9, 15)
    digits = _digits(match)
    count = F.length(digits)
    fits = (count >= few) & (count <= many)
    return F.when(fits, luhn(digits)).otherwise(False) if kind == "card" else fits


def spans(kind: str, text: Column) -> Column:
    """The confirmed spans of a kind, an array of structs as in ``_SPANS``.

    Places count code points, the end is exclusive. Of overlapping matches of a kind the leftmost
    is taken, and one that is not confirmed is dropped as a whole.
    """
    search = _SEARCH[kind]
    rank = list(PLAIN_PATTERNS).index(kind)
    matches = F.regexp_extract_all(text, F.lit(search.pattern), 0)
    between = F.split(text, search.pattern, -1)
    nearby = F.lit(rf"(?i)\b(?:{CONTEXT[kind]})\b[^\n]{{0,{CONTEXT_WIDTH}}}$")

    def measured(match: Column, before: Column) -> Column:
        close = F.substring(before, -CONTEXT_WIDTH, CONTEXT_WIDTH)
        confirmed = _confirmed(kind, match)
        score = F.lit(PATTERN_SCORE[kind] + CHECKSUM_SCORE.get(kind, 0.0)) + F.when(
            F.regexp_like(close, nearby), CONTEXT_SCORE
        ).otherwise(0.0)
        keep = confirmed if kind in BASE_KINDS else confirmed & (score >= LEAST_SCORE)
        return F.struct(
            F.length(before).alias("gap"),
            F.length(match).alias("size"),
            keep.alias("keep"),
            F.least(score, F.lit(1.0)).alias("score"),
        )

    # the text after the last match has no match to go with
    paired = F.zip_with(matches, between, lambda m, b: F.struct(m.alias("m"), b.alias("b")))
    found = F.transform(
        F.filter(paired, lambda x: x["m"].isNotNull()), lambda x: measured(x["m"], x["b"])
    )
    placed = _let(found, lambda items: _placed(items, kind, rank))
    nothing = F.array().cast(_SPANS)
    return F.when(F.regexp_like(text, F.lit(search.hint)), placed).otherwise(nothing)


_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


def _placed(items: Column, kind: str, rank: int) -> Column:
    """Adds up gaps and sizes to places, in runs, so that the time stays near linear."""
    runs = F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), F.lit(_RUN))
    total = lambda a, x: a + x["gap"] + x["size"]
    sums = F.transform(
        runs, lambda at: F.aggregate(F.slice(items, at, F.lit(_RUN)), F.lit(0), total)
    )

    def run(at: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast(_SPANS).alias("found"))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + x["gap"]
            span = F.struct(
                begin.alias("start"),
                F.lit(rank).alias("rank"),
                (begin + x["size"]).alias("end"),
                F.lit(kind).alias("kind"),
                x["score"].alias("score"),
            )
            more = F.when(x["keep"], F.concat(acc["found"], F.array(span))).otherwise(acc["found"])
            return F.struct((begin + x["size"]).alias("at"), more.alias("found"))

        return F.aggregate(F.slice(items, at, F.lit(_RUN)), start, step, lambda a: a["found"])

    def runs_placed(sums: Column) -> Column:
        firsts = F.transform(
            runs,
            lambda at, i: F.aggregate(F.slice(sums, F.lit(1), i), F.lit(0), lambda a, x: a + x),
        )
        return F.flatten(F.zip_with(runs, firsts, run))

    return _let(sums, runs_placed)


def _listed(found: Column) -> Column:
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs`` with the personal data in its whole text.

    Columns: ``doc_id``; ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``n_iban``;
    ``base_sha256``, the digest of the list of spans of the first four kinds; ``spans``, the list
    of all; ``score``, the largest of its scores, 0 without any. A list has
    ``kind:start:end`` by start, then by kind, with commas. A null text is empty. Rows with a
    null or repeated id are searched each. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    kinds = list(PLAIN_PATTERNS)
    rows = rows.select("doc_id", *(spans(k, F.col("text")).alias(f"of_{k}") for k in kinds))
    every = F.array_sort(F.concat(*(f"of_{k}" for k in kinds)))
    rows = rows.select(
        "doc_id",
        *(F.size(f"of_{k}").cast("bigint").alias(f"n_{k}") for k in kinds),
        every.alias("every"),
    )
    base = F.filter("every", lambda s: s["kind"].isin(*BASE_KINDS))
    best = F.aggregate("every", F.lit(0.0), lambda a, s: F.greatest(a, s["score"]))
    return rows.select(
        "doc_id",
        *(f"n_{k}" for k in kinds),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("every")).alias("spans"),
        best.alias("score"),
    )
