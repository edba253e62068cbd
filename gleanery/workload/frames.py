"""The given tables seen as raw records, stored records, audit rows and landed files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.stats import batch_summary

INGESTED = datetime(2024, 1, 31)


def moment(text: str) -> Column:
    """A point in time without zone, like the timestamps of the tables."""
    return F.lit(text).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    """Compact rows dealt over all cores before each becomes a page: one task or a few read a small file, however much work
    its rows make."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _raw(rows: DataFrame, position: str, **fields: Column) -> DataFrame:
    defaults = {
        "url": F.lit(""), "description": F.lit(""), "author": F.lit(""), "tags": F.array().cast("array<string>"),
        "score": F.lit(""), "extra": F.create_map().cast("map<string,string>"),
        "scraped_at": F.lit(INGESTED).cast("timestamp"),
        "source_ord": F.lit(0).cast("bigint"), "page_no": F.lit(0).cast("bigint"),
        "item_pos": F.col(position).cast("bigint"),
    }
    columns = defaults | fields
    order = ["source_name", "url", "title", "description", "author", "tags", "score", "extra", "scraped_at",
             "batch_id", "source_ord", "page_no", "item_pos"]
    return rows.select(*[columns[name].alias(name) for name in order])


def documents_raw(documents: DataFrame) -> DataFrame:
    """A document as a record: first line as title, whole text as description, no URL."""
    return _raw(
        documents,
        "doc_id",
        source_name=F.col("source"),
        title=F.substring_index("text", "\n", 1),
        description=F.col("text"),
        author=F.concat(F.lit("  "), F.col("source"), F.lit(" ")),
        tags=F.array("lang", F.upper("lang"), F.concat(F.lit("Source "), F.col("source"))),
        score=F.concat(F.format_number("n_chars", 0), F.lit(" chars")),
        extra=F.create_map(F.lit("category"), F.col("lang")),
        batch_id=F.concat(F.lit("run-"), F.col("source")),
    )


def parts_raw(parts: DataFrame) -> DataFrame:
    """A part as a record without URL; sizes bring junk titles, broken scores and over-long categories."""
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    return _raw(
        parts,
        "p_partkey",
        source_name=F.col("p_brand"),
        title=F.when(F.col("p_size") == 7, "N/A").otherwise(F.concat_ws(" ", "p_name", "p_size")),
        score=F.when(F.col("p_size") == 9, "1.2.3").otherwise(price),
        extra=F.create_map(
            F.lit("category"),
            F.when(F.col("p_size") == 11, F.repeat("p_type", F.lit(40))).otherwise(F.col("p_type")),
            F.lit("price"),
            F.concat(F.lit("£"), F.format_number("p_retailprice", 2)),
        ),
        batch_id=F.concat(F.lit("run-"), F.col("p_brand")),
    )


def events_stored(events: DataFrame) -> DataFrame:
    """An event as a stored record; one run per hour and event type."""
    return events.select(
        F.col("event_type").alias("source_name"),
        F.concat(F.lit("event "), F.col("event_id")).alias("title"),
        F.concat(F.lit("https://events.example.com/"), F.col("user_id")).alias("url"),
        F.col("event_type").alias("category"),
        F.col("value").alias("score"),
        F.col("ts").alias("ingested_at"),
        F.date_format("ts", "yyyy-MM-dd-HH").alias("batch_id"),
        F.col("event_id").cast("string").alias("fingerprint"),
    )


def lines_stored(lineitem: DataFrame) -> DataFrame:
    """An order line as a stored record; three sources and categories hold all rows."""
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_returnflag").alias("source_name"),
        F.col("l_returnflag").alias("category"),
        F.col("l_extendedprice").alias("score"),
        F.col("l_shipdate").alias("ingested_at"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("fingerprint"),
    )


def events_log(events: DataFrame) -> DataFrame:
    """Audit rows of the event runs; runs of type ``error`` failed."""
    failed = F.col("source_name") == "error"
    return batch_summary(events_stored(events)).select(
        "batch_id",
        "source_name",
        "records_raw",
        "records_clean",
        "records_failed",
        "started_at",
        "finished_at",
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.repeat(F.concat(F.col("batch_id"), F.lit(" ")), F.lit(100))).otherwise("").alias("error_message"),
    )


def landed_pages(pages: DataFrame, key: str) -> DataFrame:
    """Pages as landed for the source ``key``."""
    return pages.select(
        F.lit(key).alias("source_key"),
        F.col("page_id").alias("page_no"),
        "url",
        "html",
        F.lit(INGESTED).cast("timestamp").alias("scraped_at"),
        F.lit("run-pages").alias("batch_id"),
    )
