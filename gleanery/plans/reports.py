"""Reporting queries over the stored tables; ``as_of`` stands for the present time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.ranking import top_per_category
from gleanery.operators.stats import source_stats

__all__ = ["top_items", "latest_runs", "failed_runs", "latest_of_source", "kept_after_purge", "source_stats"]


def top_items(records: DataFrame, count: int = 3) -> DataFrame:
    """Best items of every category, ordered by category and rank."""
    return (
        top_per_category(records, count)
        .select("category", "source_name", "title", "score", "rank_in_category")
        .orderBy("category", "rank_in_category")
    )


def latest_runs(log: DataFrame, count: int = 20) -> DataFrame:
    """The runs that finished last."""
    return (
        log.select("source_name", "status", "records_raw", "records_clean", "records_failed", "finished_at", "batch_id")
        .orderBy(F.desc("finished_at"), "batch_id", "source_name")
        .limit(count)
    )


def failed_runs(log: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Runs of the last 24 hours that did not succeed."""
    now = F.current_timestamp() if as_of is None else as_of
    recent = F.col("finished_at") > now - F.expr("INTERVAL 24 HOURS")
    return log.filter((F.col("status") != "success") & recent).select("source_name", "error_message", "finished_at")


def latest_of_source(records: DataFrame, source_name: str, count: int = 10) -> DataFrame:
    """The records of one source that were ingested last."""
    return (
        records.filter(F.col("source_name") == source_name)
        .select("title", "url", "category", "ingested_at", "fingerprint")
        .orderBy(F.desc("ingested_at"), "fingerprint")
        .limit(count)
    )


def kept_after_purge(records: DataFrame, as_of: Column | None = None, days: int = 90) -> DataFrame:
    """Records young enough to stay."""
    now = F.current_timestamp() if as_of is None else as_of
    return records.filter(F.col("ingested_at") >= now - F.expr(f"INTERVAL {int(days)} DAYS"))
