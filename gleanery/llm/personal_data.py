"""Personal data in text: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything is a column expression on one row, so a table of any size is scanned once without a shuffle. A span is
(start, end, score) in code points, end exclusive, score in percent.

The words near a span are those in the gaps to the matches before and after it. An IBAN ends where its country's length says, whatever
follows; one of a country that is not listed is its longest beginning in whole groups that passes the check.

Defined results: a null or empty text has no spans; matches that fail their check are dropped, and what lies within a match is not searched again; repeated rows
get equal results; other columns of the table are ignored. Patterns repeat groups possessively, which Java runs as loops,
so a very long text neither recurses nor backtracks over itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<start:int,end:int,score:int>>"
CONTEXT_CHARS = 40
DOUBTFUL = r"(?i)\b(example|sample|dummy|test|version|isbn|invoice|order)\b"


@dataclass(frozen=True)
class Kind:
    """pattern proposes; `present` is a cheap test that a text can hold a match at all; prior is the score in percent."""

    name: str
    pattern: str
    present: str
    prior: int
    hints: str
    base: bool


EMAIL = Kind(
    "email",
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "@",
    90,
    r"(?i)\b(e-?mail|mail|contact|write)\b",
    True,
)
IP = Kind(
    "ip",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9]\.[0-9]",
    60,
    r"(?i)\b(ip|host|server|address|login)\b",
    True,
)
CARD = Kind(
    "card",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"[0-9][\x20-]?[0-9]",
    80,
    r"(?i)\b(card|visa|mastercard|credit|debit|payment)\b",
    True,
)
PHONE = Kind(
    "phone",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    r"\+[0-9]",
    70,
    r"(?i)\b(phone|tel|telephone|call|mobile|fax)\b",
    True,
)
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_COUNTRIES = "|".join(code for codes in IBAN_LENGTHS.values() for code in codes.split())
IBAN_OF_COUNTRY = "|".join(
    rf"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, codes in IBAN_LENGTHS.items()
)
IBAN = Kind(
    "iban",
    rf"\b(?:{IBAN_OF_COUNTRY}|[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?)\b",
    r"[A-Z]{2}[0-9]{2}",
    80,
    r"(?i)\b(iban|bank|account|konto)\b",
    False,
)
LOCAL_PHONE = Kind(
    "local_phone",
    r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
    r"[0-9]{3}\)?[\x20.-][0-9]{3}",
    40,
    r"(?i)\b(phone|tel|telephone|call|mobile|fax)\b",
    False,
)
KINDS = (EMAIL, IP, CARD, PHONE, IBAN, LOCAL_PHONE)
ADDED_SCORE = 50


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled; the sum of all digits is a multiple of ten."""
    turned = F.reverse(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(turned, place, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(place % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def passes_mod97(code: Column) -> Column:
    """ISO 7064: the first four signs go to the end, letters count 10 to 35, the remainder by 97 is 1."""
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def add(rest: Column, place: Column) -> Column:
        sign = F.ascii(F.substring(moved, place, F.lit(1)))
        return F.when(sign >= 65, rest * 100 + sign - 55).otherwise(rest * 10 + sign - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def iban_in(hit: Column) -> Column:
    """The IBAN a match begins with, spaces included, else an empty text: without a country's length it may have taken words that follow."""

    def passes(part: Column) -> Column:
        code = F.regexp_replace(part, " ", "")
        return F.when(F.length(code).between(15, 34), passes_mod97(code)).otherwise(False)

    groups = F.split(hit, " ")
    counts = F.when(hit.rlike(f"^({IBAN_COUNTRIES})"), F.array(F.size(groups))).otherwise(F.sequence(F.size(groups), F.lit(1), F.lit(-1)))
    parts = F.transform(counts, lambda n: F.array_join(F.slice(groups, F.lit(1), n), " "))
    return F.coalesce(F.get(F.filter(parts, passes), F.lit(0)), F.lit(""))


def confirmed(kind: Kind, hit: Column, before: Column) -> Column:
    """The check of a kind on one proposed match; `before` is the text since the previous match."""
    if kind is IP:
        return ~F.exists(F.split(hit, r"\."), lambda part: ~part.rlike("^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"))
    if kind is CARD:
        digits = digits_of(hit)
        return F.when(F.length(digits).between(16, 19), passes_luhn(digits)).otherwise(False)
    if kind is PHONE:
        return F.length(digits_of(hit)).between(8, 15)
    if kind is LOCAL_PHONE:
        return ~F.right(before, F.lit(6)).rlike(r"[0-9+][\x20().-]*$")
    return F.lit(True)


def score(kind: Kind, before: Column, after: Column) -> Column:
    near = F.concat(F.right(before, F.lit(CONTEXT_CHARS)), F.lit(" "), F.left(after, F.lit(CONTEXT_CHARS)))
    raised = F.lit(kind.prior) + F.when(near.rlike(kind.hints), 20).otherwise(0) - F.when(near.rlike(DOUBTFUL), 30).otherwise(0)
    return F.least(raised, F.lit(100))


def spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind in order. Positions come from the lengths of the pieces between the matches."""
    pieces = F.split(text, kind.pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    tail = F.slice(pieces, F.lit(2), F.size(hits))
    steps = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(hits)).alias("before"), hits.alias("hit"), tail.alias("after"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def walk(state: Column, step: Column) -> Column:
        begin = state["at"] + F.length(step["before"])
        upto = begin + F.length(step["hit"])
        if kind is IBAN:
            length = F.length(iban_in(step["hit"]))
            end, good = begin + length, length > 0
            after = F.concat(F.substring(step["hit"], length + 1, F.length(step["hit"])), step["after"])
        else:
            end, good, after = upto, confirmed(kind, step["hit"], step["before"]), step["after"]
        points = score(kind, step["before"], after)
        if not kind.base:
            good = good & (points >= ADDED_SCORE)
        one = F.array(F.struct(begin.alias("start"), end.alias("end"), points.alias("score"))).cast(SPANS)
        return F.struct(upto.alias("at"), F.when(good, F.concat(state["spans"], one)).otherwise(state["spans"]).alias("spans"))

    none = F.array().cast(SPANS)
    present = F.contains(text, F.lit("@")) if kind is EMAIL else text.rlike(kind.present)
    return F.when(present, F.aggregate(steps, start, walk)["spans"]).otherwise(none)


def with_spans(table: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """Adds one struct column: an array of spans per kind. The table's own columns stay as they are."""
    body = F.coalesce(F.col(text), F.lit(""))
    return table.withColumn(into, F.struct(*(spans(body, kind).alias(kind.name) for kind in KINDS)))


def listed(pii: Column, kinds: tuple[Kind, ...], last: str = "end") -> Column:
    """kind:start:end (or another field than end) of all spans, comma-joined in the order of the kinds."""


    def of(kind: Kind) -> Column:
        return F.transform(pii[kind.name], lambda s: F.concat_ws(":", F.lit(kind.name), s["start"], s[last]))

    return F.array_join(F.concat(*map(of, kinds)), ",")


def digest(table: DataFrame, text: str = "text") -> DataFrame:
    """Counts of the base kinds, hash of their spans, all spans, then all scores and the counts of the other kinds, per row of `doc_id`."""
    base = tuple(k for k in KINDS if k.base)
    found = with_spans(table.select("doc_id", F.col(text).alias("text")), "text", "pii")
    pii = F.col("pii")

    def counts(base_kinds: bool) -> list[Column]:
        return [F.size(pii[k.name]).cast("long").alias(f"n_{k.name}") for k in KINDS if k.base == base_kinds]

    return found.select(
        "doc_id",
        *counts(True),
        F.sha2(listed(pii, base), 256).alias("base_sha256"),
        listed(pii, KINDS).alias("spans"),
        listed(pii, KINDS, "score").alias("scores"),
        *counts(False),
    )


def masked(table: DataFrame, text: str = "text", least: int = 50) -> DataFrame:
    """The table with each span of at least that score replaced by its kind in angle brackets, overlaps by the first span."""
    found = with_spans(table.select(F.struct("*").alias("row"), F.col(text).alias("body")), "body", "pii")  # no name can clash

    def marked(kind: Kind) -> Column:
        strong = F.filter(F.col("pii")[kind.name], lambda s: s["score"] >= least)
        mark = F.lit(f"<{kind.name}>").alias("mark")
        return F.transform(strong, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), mark))

    marks = F.concat(*map(marked, KINDS))
    body = F.col("body")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def walk(state: Column, mark: Column) -> Column:
        gap = F.substring(body, state["at"] + 1, mark["start"] - state["at"])
        return F.when(
            mark["start"] >= state["at"],
            F.struct(mark["end"].alias("at"), F.concat(state["out"], gap, mark["mark"]).alias("out")),
        ).otherwise(state)

    done = F.aggregate(F.array_sort(marks), start, walk)
    whole = F.concat(done["out"], F.substring(body, done["at"] + 1, F.length(body)))
    clean = F.when(F.size(marks) > 0, whole).otherwise(body)
    return found.select(*(clean.alias(c) if c == text else F.col("row")[c].alias(c) for c in table.columns))
