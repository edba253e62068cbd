"""Row types that travel between the stages.

``RAW`` is what producers emit, ``CLEAN_COLUMNS`` what is stored, ``AUDIT`` one row per source run.
Rows of a DataFrame have no order, so raw rows carry their place in the run explicitly
(``source_ord``, ``page_no``, ``item_pos``); "first wins" rules sort by ``SEQUENCE``.
"""

from __future__ import annotations

from pyspark.sql import types as T

SEQUENCE = ["source_ord", "page_no", "item_pos"]
# Unnumbered pages, and several runs in one load, tie in SEQUENCE; a hash of the whole raw row then decides, whatever the
# partitioning. Rows equal in it are equal, so either may stay.
ROW_HASH = T.StructField("row_hash", T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
FIRST = [*SEQUENCE, "batch_id", ROW_HASH.name]
# Key in ``extra`` of a raw row that stands for a page, document or item that could not be read; its value is the reason.
UNREADABLE = "#unreadable"

RAW = T.StructType(
    [
        T.StructField("source_name", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("score", T.StringType()),
        T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("source_ord", T.LongType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("item_pos", T.LongType()),
    ]
)

CLEAN_COLUMNS = [
    "source_name", "title", "url", "description", "author", "category", "tags",
    "score", "price", "published_at", "ingested_at", "batch_id", "fingerprint",
]

STORED = T.StructType(
    [
        T.StructField("source_name", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("score", T.DecimalType(12, 4)),
        T.StructField("price", T.DecimalType(12, 2)),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("records_raw", T.LongType()),
        T.StructField("records_clean", T.LongType()),
        T.StructField("records_failed", T.LongType()),
        T.StructField("records_junk", T.LongType()),
        T.StructField("records_error", T.LongType()),
        T.StructField("records_duplicate", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)
AUDIT_KEY = ["batch_id", "source_name"]
