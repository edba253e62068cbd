"""Ranks per category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.operators.lookup import lookup_join
from gleanery.session import shared_folder


def _order() -> list[Column]:
    # The fingerprint settles ties, which otherwise would depend on the run.
    return [F.desc_nulls_last("score"), F.desc("ingested_at"), F.col("fingerprint")]


def with_category(records: DataFrame) -> DataFrame:
    """Records that have a category."""
    return records.filter(F.col("category").isNotNull() & (F.col("category") != ""))


def top_per_category(records: DataFrame, count: int = 10, within: list[str] | None = None) -> DataFrame:
    """The best ``count`` records of every category (of each value of ``within``) with their ``rank_in_category``.

    The limit on the rank is pushed below the shuffle, so each task sends at most ``count`` rows of a
    category.
    """
    rank = F.row_number().over(Window.partitionBy(*(within or []), "category").orderBy(*_order()))
    return with_category(records).withColumn("rank_in_category", rank).filter(F.col("rank_in_category") <= count)


def rank_in_category(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """The rank of every record in its category, however large the category is.

    Rows are range-partitioned on (category, order) and numbered where they lie, so a large category is spread over many
    tasks. A rank is the row's number less the first one of its category in the task, plus the rows of the category in the
    tasks before; only those counts, one row per category and task, are joined back.
    """
    spark = records.sparkSession
    shared_folder(spark)
    order = [F.col("category"), *_order()]
    width = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = with_category(records).repartitionByRange(width, *order).sortWithinPartitions(*order)
    # The checkpoint fixes the number of every row; its upper bits are the task.
    placed = sorted_rows.withColumn("_id", F.monotonically_increasing_id()).checkpoint().withColumn("_task", F.shiftright("_id", 33))
    counts = placed.groupBy("category", "_task").agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"))
    before = Window.partitionBy("category").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("category", "_task", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    ranked = lookup_join(placed, offsets, ["category", "_task"], how="inner")
    return ranked.withColumn("rank_in_category", F.col("_id") + F.col("_shift")).select(*records.columns, "rank_in_category")
