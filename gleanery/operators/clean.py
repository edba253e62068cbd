"""Raw records to clean records: projection, junk and error rows, first-wins de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.numeric import has_bad_number, parse_price, parse_score
from gleanery.functions.tags import first_tags, parse_tags
from gleanery.functions.text import clean_field, clean_text, is_junk_title, truncate
from gleanery.functions.url import absolute_groups, canonical_url, normalise_url
from gleanery.operators.limits import Limits
from gleanery.schemas import CLEAN_COLUMNS, FIRST, RAW, ROW_HASH, SEQUENCE, UNREADABLE


def fingerprint(url: Column, title: Column) -> Column:
    """SHA-1 of the canonical URL, or of the plain title where there is no usable URL."""
    return F.sha1(F.coalesce(F.nullif(normalise_url(url), F.lit("")), clean_text(title)))


def row_outcome(title: Column, score: Column, extra: Column) -> Column:
    """What cleaning makes of a raw row: ``junk``, ``error`` (unreadable page, item or number) or ``kept``."""
    unreadable = has_bad_number(score) | has_bad_number(extra["price"])
    lost = extra[UNREADABLE].isNotNull()
    return F.when(lost, "error").when(is_junk_title(clean_text(title)), "junk").when(unreadable, "error").otherwise("kept")


def row_hash(raw: DataFrame) -> Column:
    """128 bits of the whole raw row: two hashes that are combined from its columns in different order."""
    entries = F.array_sort(F.map_entries("extra"))
    columns = [entries if name == "extra" else F.col(name) for name in RAW.fieldNames() if name in raw.columns]
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *reversed(columns)).alias("b"))


def _cuts(limits: Limits) -> Column:
    """Names of the fields of a row that its limits cut."""
    cut = {name: F.char_length(name) > length for name, length in limits.texts.items()}
    cut["tags"] = F.size("tags") > limits.tags
    cut["tag"] = F.exists(first_tags(F.col("tags"), limits.tags), lambda tag: F.char_length(tag) > limits.tag_length)
    return F.array_compact(F.array(*[F.when(held, name) for name, held in cut.items()]))


def clean_records(
    raw: DataFrame,
    ingested_at: Column | None = None,
    keep: list[str] | None = None,
    limits: Limits = Limits(),
    note_cuts: bool = False,
) -> DataFrame:
    """The 13 clean columns (and the sequence columns, the row's hash and ``keep``) of every usable raw row.

    Rows with a junk title, and rows whose score or price is no number, are left out. Texts and tag lists are cut to
    ``limits``; with ``note_cuts`` the array ``cuts`` names the fields that were.
    """
    extra_columns = [c for c in [*SEQUENCE, *(keep or [])] if c in raw.columns]
    readable = raw.filter(
        F.col("extra")[UNREADABLE].isNull() & ~has_bad_number(F.col("score")) & ~has_bad_number(F.col("extra")["price"])
    )
    staged = readable.withColumn("_groups", absolute_groups(F.col("url"))).select(
        *extra_columns,
        row_hash(raw).alias(ROW_HASH.name),
        "source_name",
        clean_text(F.col("title")).alias("title"),
        canonical_url(F.col("url"), F.col("_groups")).alias("url"),
        clean_field("description").alias("description"),
        clean_text(F.col("author")).alias("author"),
        F.when(F.map_contains_key("extra", "category"), F.col("extra")["category"]).otherwise("").alias("category"),
        parse_tags(F.col("tags")).alias("tags"),
        parse_score(F.col("score")).alias("score"),
        parse_price(F.col("extra")["price"]).alias("price"),
        F.lit(None).cast("timestamp").alias("published_at"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
        "batch_id",
    )
    useful = staged.filter(~is_junk_title(F.col("title")))
    # The title is cleaned once more for the key, as in ``fingerprint``; the URL already is canonical.
    key = F.when(F.col("url") != "", F.col("url")).otherwise(clean_text(F.col("title")))
    shaped = {name: F.col(name) for name in CLEAN_COLUMNS[:-1]}
    shaped |= {name: truncate(F.col(name), length) for name, length in limits.texts.items()}
    shaped["tags"] = first_tags(F.col("tags"), limits.tags)
    columns = [column.alias(name) for name, column in shaped.items()]
    noted = [_cuts(limits).alias("cuts")] if note_cuts else []
    return useful.select(*extra_columns, ROW_HASH.name, *columns, F.sha1(key).alias("fingerprint"), *noted)


def keep_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key in the given order.

    Planned as a group limit of one, applied before and after the shuffle: a group of copies, however
    large, sends one row per task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def drop_duplicates_in_run(cleaned: DataFrame) -> DataFrame:
    """First row per fingerprint within one source run."""
    return keep_first(cleaned, ["batch_id", "fingerprint"], FIRST)


def load_projection(cleaned: DataFrame) -> DataFrame:
    """The 13 stored columns in their fixed order."""
    return cleaned.select(*CLEAN_COLUMNS)
