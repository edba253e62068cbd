"""Character references (``&eacute;``, ``&#233;``, ``&#xe9;``) decoded without a Python worker, as an HTML parser does."""

from __future__ import annotations

from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that count without a semicolon, the longest first, so that a pattern takes as much as it can.
_OPEN_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
_OPEN = "(?:" + "|".join(_OPEN_NAMES) + ")"
_PIECES = rf"(&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[A-Za-z][A-Za-z0-9]{{1,31}};|{_OPEN})|[^&]+|&)"


@cache
def _named() -> str:
    """The standard named references as one literal string ``name\\tchar\\n...`` for str_to_map."""
    rows = [f"{name.rstrip(';')}\t{char}" for name, char in html5.items() if name.endswith(";") and char not in "\t\n"]
    return "\n".join(rows)


@cache
def _windows() -> dict[int, str]:
    """What the numbers 128 to 159 stand for: the signs of the Windows code page, where it has one."""
    signs = {number: bytes([number]).decode("cp1252", "ignore") for number in range(0x80, 0xA0)}
    return {number: sign for number, sign in signs.items() if sign}


def _code_point(digits: Column, base: int) -> Column:
    """The character of a number: U+FFFD for none, surrogates and numbers too large; '' for other invalid ones."""
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    number = F.when(F.length(short) <= 7, F.conv(short, base, 10).cast("int")).otherwise(0x110000)
    table = F.create_map(*[F.lit(item) for pair in _windows().items() for item in pair])
    utf32 = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    none = (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    control = number.between(1, 8) | (number == 11) | number.between(14, 31) | number.between(127, 159)
    noncharacter = number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(0xFFFE) == 0xFFFE)
    return (
        F.when(none, "\ufffd")
        .when(number.between(0x80, 0x9F), F.coalesce(F.try_element_at(table, number), utf32))
        .when(number == 13, "\r")
        .when(control | noncharacter, "")
        .otherwise(utf32)
    )


def decode_references(text: Column) -> Column:
    """Decode character references in one left-to-right pass."""
    names = F.str_to_map(F.lit(_named()), F.lit("\n"), F.lit("\t"))

    def piece_value(piece: Column) -> Column:
        body = F.rtrim(F.substr(piece, F.lit(2)), F.lit(";"))
        rest = F.substr(piece, F.lit(2))
        prefix = F.regexp_extract(rest, f"^{_OPEN}", 0)  # a name that is unknown may begin with one that needs no semicolon
        by_prefix = F.when(prefix != "", F.concat(F.try_element_at(names, prefix), F.substr(rest, F.length(prefix) + 1)))
        decoded = (
            F.when(body.rlike("^#[xX]"), _code_point(F.substr(body, F.lit(3)), 16))
            .when(F.startswith(body, F.lit("#")), _code_point(F.substr(body, F.lit(2)), 10))
            .when(body == "amp", "&")  # the usual one, without a search through all names
            .otherwise(F.coalesce(F.try_element_at(names, body), by_prefix))
        )
        is_reference = F.startswith(piece, F.lit("&")) & (F.length(piece) > 1)
        return F.when(is_reference, F.coalesce(decoded, piece)).otherwise(piece)

    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(1))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, piece_value), "")).otherwise(text)
