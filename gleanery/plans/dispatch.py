"""From landed pages and documents of all sources to raw records, each source by its own kind of producer."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.lookup import lookup_join
from gleanery.plans.batch import combine
from gleanery.sources.documents import extract_documents
from gleanery.sources.pages import attach_sources, extract_catalogue, extract_items, extract_quotes
from gleanery.sources.registry import DEFAULT_TYPE, get_producer, register_producer, registered, runnable_sources, select_source

# Names of the two spiders a source may ask for.
register_producer("BooksSpider", extract_catalogue)
register_producer("QuotesSpider", extract_quotes)


def new_batch_id() -> str:
    """A batch id of its own for a run that was given none."""
    return str(uuid.uuid4())


def _answers(landed: DataFrame, sources: DataFrame) -> DataFrame:
    settings = sources.select(
        F.col("key").alias("source_key"), F.col("name").alias("source_name"), F.col("url").alias("source_url"), "source_ord"
    )
    joined = lookup_join(landed, settings, ["source_key"], how="inner")
    page = F.coalesce(F.col("page_no").cast("bigint"), F.lit(0))
    return joined.select(
        "source_name", "source_url", F.col("body").alias("document"), "scraped_at", "batch_id", "source_ord", page.alias("page_no")
    )


def raw_records(
    landed: DataFrame, sources: DataFrame, key: str | None = None, crawled: bool = False, max_items: int | None = None
) -> DataFrame:
    """Raw records of landed rows (``source_key, page_no, url, body, scraped_at, batch_id``) of all runnable sources.

    ``key`` takes one source only. The source's type picks the producer: selectors for pages, the JSON mapping for
    answers; with ``crawled`` also the producer registered under the source's ``spider_class``. Rows of other sources are left
    out. Rows without ``batch_id`` get one for this call.
    """
    marked = landed.withColumn("batch_id", F.coalesce("batch_id", F.lit(new_batch_id())))
    pages = marked.withColumnRenamed("body", "html")
    chosen = runnable_sources(sources) if key is None else select_source(sources, key)
    kind = F.coalesce("scraper_type", F.lit(DEFAULT_TYPE))
    found = [
        extract_items(attach_sources(pages, chosen.filter(kind == "bs4"))),
        extract_documents(_answers(marked, chosen.filter(kind == "api")), max_items=max_items),
    ]
    if crawled:
        wanted = sources.filter(F.col("scraper_type") == "scrapy") if key is None else sources.filter(F.col("key") == key)
        asked = {row.spider_class for row in wanted.select("spider_class").distinct().toLocalIterator()}  # a short list
        for name in sorted(asked.intersection(registered())):
            theirs = wanted.filter(F.col("spider_class") == name)
            found.append(get_producer(name)(attach_sources(pages, theirs)))
    return combine(*found)
