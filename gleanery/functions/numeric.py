"""Scores, prices and number coercion as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import strip

# A decimal number, and an underscore that does not stand between two digits.
_NUMBER = r"^[+-]?(?:[0-9][0-9_]*\.?[0-9_]*|\.[0-9][0-9_]*)(?:[eE][+-]?[0-9][0-9_]*)?$"
_STRAY_UNDERSCORE = r"_(?![0-9])|(?<![0-9])_"

# Rating words of the book catalogue.
RATINGS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}


def _first_run(raw: Column) -> Column:
    """First run of digits and dots after thousands separators are gone ('' if there is none)."""
    return F.regexp_extract(F.replace(raw, F.lit(","), F.lit("")), "[0-9.]+", 0)


def has_bad_number(raw: Column) -> Column:
    """True where the text holds a digit run that is no number, such as ``1.2.3``."""
    return _first_run(F.coalesce(raw, F.lit(""))).rlike(r"^\.+$|\..*\.")


def parse_score(raw: Column) -> Column:
    """Score text to number: ``1,234 points`` → 1234, ``3.5k`` → 3500; NULL without a number.

    A ``k`` (thousand) or else an ``m`` (million) counts wherever it stands in the text.
    """
    text = F.lower(raw)
    scale = F.when(F.contains(text, F.lit("k")), 1_000.0).when(F.contains(text, F.lit("m")), 1_000_000.0)
    return F.round(_first_run(raw).try_cast("double") * scale.otherwise(1.0), 2)


def parse_price(raw: Column) -> Column:
    """Price text to number: ``£1,012.99`` → 1012.99; NULL without a number."""
    return _first_run(raw).try_cast("double")


def coerce_number(raw: Column) -> Column:
    """Text to a finite, non-negative number; everything else becomes NULL."""
    text = strip(raw)
    value = F.when(text.rlike(_NUMBER) & ~text.rlike(_STRAY_UNDERSCORE), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
    return non_negative(value)


def non_negative(value: Column) -> Column:
    """Keep finite values from zero up, NULL otherwise."""
    return F.when((value >= 0) & (value < float("inf")), value)


def rating_value(css_class: Column) -> Column:
    """``star-rating Three`` → 3; 0 for an unknown word."""
    word = F.trim(F.replace(F.coalesce(css_class, F.lit("")), F.lit("star-rating"), F.lit("")))
    table = F.create_map(*[F.lit(item) for pair in RATINGS.items() for item in pair])
    return F.coalesce(F.try_element_at(table, word), F.lit(0))
