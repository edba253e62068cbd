"""Tag lists as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import strip, truncate

MAX_TAGS = 20
MAX_TAG_LENGTH = 100


def parse_tags(tags: Column) -> Column:
    """Lower-case slugs, blanks as '-', without empties and repeats, in order of first appearance."""
    slugs = F.transform(tags, lambda tag: F.replace(F.lower(strip(tag)), F.lit(" "), F.lit("-")))
    kept = F.array_distinct(F.filter(slugs, lambda slug: slug.isNotNull() & (slug != "")))
    return F.coalesce(kept, F.array().cast("array<string>"))


def first_tags(tags: Column, count: int = MAX_TAGS) -> Column:
    """The first ``count`` tags."""
    return F.slice(tags, 1, count)


def coerce_tags(tags: Column, count: int = MAX_TAGS, length: int = MAX_TAG_LENGTH) -> Column:
    """Stored form of a tag list: no empties, each cut to ``length`` characters, the first ``count``; NULL → []."""
    kept = F.filter(tags, lambda tag: tag.isNotNull() & (tag != ""))
    cut = F.transform(first_tags(kept, count), lambda tag: strip(truncate(tag, length)))
    return F.coalesce(cut, F.array().cast("array<string>"))
