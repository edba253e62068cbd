"""Enrichment of stored records: category backfill and score normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.lookup import lookup_join, spread_join

SCORE = "decimal(12,4)"


def backfill_category(records: DataFrame, categories: DataFrame) -> DataFrame:
    """Fill NULL and empty categories from ``categories`` (source_name, category), where known."""
    known = categories.select("source_name", F.col("category").alias("_known"))
    blank = F.col("category").isNull() | (F.col("category") == "")
    joined = spread_join(records, known, ["source_name"])
    filled = F.when(blank, F.coalesce("_known", "category")).otherwise(F.col("category"))
    return joined.withColumn("category", filled).select(*records.columns)


def score_bounds(records: DataFrame) -> DataFrame:
    """Least and greatest score per source, over the scores there are."""
    score = F.col("score").cast(SCORE)
    return (
        records.filter(F.col("score").isNotNull())
        .groupBy("source_name")
        .agg(F.min(score).alias("min_score"), F.max(score).alias("max_score"))
    )


def with_score_bounds(records: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Every record with its source's bounds; ``bounds`` are computed where none are at hand.

    Two-step on purpose: a window over the source would put all rows of a source into one task, while
    the aggregate shrinks before its shuffle and its result joins back without moving the records.
    """
    return lookup_join(records, score_bounds(records) if bounds is None else bounds, ["source_name"])


def normalise_scores(records: DataFrame, into: str = "score", bounds: DataFrame | None = None) -> DataFrame:
    """Scores scaled to [0, 1] per source, four decimals; unscalable rows keep their score.

    ``into`` names the result column, so the raw score can be kept beside it.
    """
    score = F.col("score").cast(SCORE)
    scaled = F.round((score - F.col("min_score")) / F.nullif(F.col("max_score") - F.col("min_score"), F.lit(0)), 4)
    value = F.when(F.col("max_score") > F.col("min_score"), scaled.cast(SCORE)).otherwise(score)
    return with_score_bounds(records, bounds).withColumn(into, value).drop("min_score", "max_score")
