"""Field rules of a clean record, as a list of messages per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions.numeric import coerce_number, non_negative
from gleanery.functions.tags import coerce_tags
from gleanery.functions.text import strip
from gleanery.operators.limits import Limits

# Fixed values: (field, least length, greatest length) in characters after stripping.
LENGTHS = (
    ("source_name", 1, 100),
    ("title", 1, 500),
    ("url", 0, 2000),
    ("description", 0, 2000),
    ("author", 0, 255),
    ("category", 0, 100),
    ("batch_id", 1, None),
    ("fingerprint", 1, None),
)
# Stored number types; a larger number cannot be stored and fails the row.
STORED_NUMBERS = {"score": "decimal(12,4)", "price": "decimal(12,2)"}


def _coerced_number(rows: DataFrame, name: str) -> Column:
    if isinstance(rows.schema[name].dataType, T.StringType):
        return coerce_number(F.col(name))
    return non_negative(F.col(name).cast("double"))


def rules(storage_limits: bool = True) -> dict[str, Column]:
    """Message and condition of every rule, over coerced fields."""
    broken = {}
    for name, least, greatest in LENGTHS:
        length = F.char_length(name)
        broken[f"{name}: not a string"] = F.col(name).isNull()
        if least:
            broken[f"{name}: shorter than {least}"] = length < least
        if greatest:
            broken[f"{name}: longer than {greatest}"] = length > greatest
    if storage_limits:
        for name, kind in STORED_NUMBERS.items():
            broken[f"{name}: does not fit {kind}"] = F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
    return broken


def validate_records(rows: DataFrame, storage_limits: bool = True, limits: Limits = Limits()) -> DataFrame:
    """Coerce the fields and add ``errors ARRAY<STRING>``; a row is valid if that is empty.

    Text is stripped, tags are cut (to 20 of 100 characters unless ``limits`` say otherwise), scores and prices that are negative or no
    number become NULL. ``storage_limits`` also reports numbers that do not fit the stored type.
    """
    fields = {name: strip(F.col(name)) for name, _, _ in LENGTHS}
    fields["url"] = F.coalesce(fields["url"], F.lit(""))
    fields["tags"] = coerce_tags(F.col("tags"), limits.tags, limits.tag_length)
    fields |= {name: _coerced_number(rows, name) for name in STORED_NUMBERS}
    coerced = rows.withColumns(fields)

    checks = [F.when(held, message) for message, held in rules(storage_limits).items()]
    return coerced.withColumn("errors", F.array_compact(F.array(*checks)))


def valid_rows(checked: DataFrame) -> DataFrame:
    """Rows that passed, without the error list."""
    return checked.filter(F.size("errors") == 0).drop("errors")


def invalid_rows(checked: DataFrame) -> DataFrame:
    """Rows that failed, with their messages."""
    return checked.filter(F.size("errors") > 0)


def as_stored(rows: DataFrame) -> DataFrame:
    """Numbers in their stored types."""
    return rows.withColumns({name: F.col(name).try_cast(kind) for name, kind in STORED_NUMBERS.items()})
