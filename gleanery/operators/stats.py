"""Aggregates over records and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gleanery.operators.clean import row_outcome
from gleanery.operators.limits import Limits
from gleanery.operators.validate import rules
from gleanery.schemas import AUDIT_KEY


def source_stats(records: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Per source: rows, distinct URLs, mean score, last ingestion, rows of the last 24 hours.

    Ordered by row count, largest first. Distinct URLs are counted per (source, url) before they are
    per source, so a source with most of the rows is spread over all tasks.
    """
    now = F.current_timestamp() if as_of is None else as_of
    return (
        records.groupBy("source_name")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_distinct("url").alias("unique_urls"),
            F.avg(F.col("score").cast("decimal(12,4)")).alias("avg_score"),
            F.max("ingested_at").alias("last_ingested_at"),
            F.count_if(F.col("ingested_at") > now - F.expr("INTERVAL 24 HOURS")).alias("records_last_24h"),
        )
        .orderBy(F.desc("total_records"), "source_name")
    )


def batch_summary(records: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Audit rows recomputed from stored records, of one batch or of all."""
    chosen = records if batch_id is None else records.filter(F.col("batch_id") == batch_id)
    return chosen.groupBy(*AUDIT_KEY).agg(
        F.count(F.lit(1)).alias("records_raw"),
        F.count(F.lit(1)).alias("records_clean"),
        F.lit(0).cast("bigint").alias("records_failed"),
        F.min("ingested_at").alias("started_at"),
        F.max("ingested_at").alias("finished_at"),
        F.lit("success").alias("status"),
    )


def raw_counts(raw: DataFrame) -> DataFrame:
    """Per source run: raw rows, and how many of them are junk or unreadable. Reads three columns."""
    outcome = raw.select(*AUDIT_KEY, row_outcome(F.col("title"), F.col("score"), F.col("extra")).alias("outcome"))
    return outcome.groupBy(*AUDIT_KEY).agg(
        F.count(F.lit(1)).alias("records_raw"),
        F.count_if(F.col("outcome") == "junk").alias("records_junk"),
        F.count_if(F.col("outcome") == "error").alias("records_error"),
    )


def checked_counts(checked: DataFrame) -> DataFrame:
    """Per source run: rows that passed and rows that failed validation.

    Validation strips texts, so rows carry the keys they came with as ``raw_keys``; runs are counted under those.
    """
    return checked.groupBy(*[F.col("raw_keys")[key].alias(key) for key in AUDIT_KEY]).agg(
        F.count_if(F.size("errors") == 0).alias("records_clean"),
        F.count_if(F.size("errors") > 0).alias("records_failed"),
    )


def _counted_rules() -> list[tuple[str, Column]]:
    cuts = [*Limits().texts, "tags", "tag"]
    held = [(f"cut: {name}", F.array_contains("cuts", name)) for name in cuts]
    return held + [(message, F.array_contains("errors", message)) for message in rules()]


def observed_rule_names() -> list[str]:
    return [rule for rule, _ in _counted_rules()]


def with_rule_counts(checked: DataFrame, observation: Observation) -> DataFrame:
    """Checked rows whose ``cuts`` and ``errors`` are counted per rule by whatever action runs over them, in the same pass."""
    counters = [F.count_if(F.coalesce(held, F.lit(False))).alias(rule) for rule, held in _counted_rules()]
    return checked.observe(observation, *counters)


def observed_rules(observation: Observation) -> list[tuple[str, int]]:
    """Every rule and the rows it held for, after the action; all 0 where it had no rows."""
    found = observation.get
    return [(rule, found.get(rule) or 0) for rule in observed_rule_names()]


def run_counts(raw: DataFrame, checked: DataFrame) -> DataFrame:
    """Counts of every source run; raw = junk + error + duplicate + clean + failed. Keys may be NULL."""
    ours, theirs = raw_counts(raw), checked_counts(checked).withColumnsRenamed({key: f"_{key}" for key in AUDIT_KEY})
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in AUDIT_KEY]
    joined = ours.join(theirs, same, "left").drop(*[f"_{key}" for key in AUDIT_KEY])
    joined = joined.na.fill(0, ["records_clean", "records_failed"])
    left_over = F.col("records_raw") - F.col("records_junk") - F.col("records_error")
    duplicates = left_over - F.col("records_clean") - F.col("records_failed")
    return joined.withColumn("records_duplicate", duplicates)


def run_totals(runs: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row: raw, clean and inserted records over all runs."""
    zero = F.lit(0).cast("bigint")
    counted = runs.select(F.col("records_raw").alias("r"), F.col("records_clean").alias("c"), zero.alias("i"))
    added = inserted.select(zero.alias("r"), zero.alias("c"), F.lit(1).cast("bigint").alias("i"))
    totals = {"r": "total_raw", "c": "total_clean", "i": "total_inserted"}
    return counted.unionByName(added).agg(
        *[F.coalesce(F.sum(name), zero).alias(total) for name, total in totals.items()]
    )


def run_duration(started_at: Column, finished_at: Column) -> Column:
    """Seconds between start and end of a run."""
    return F.timestamp_diff("MICROSECOND", started_at, finished_at) / F.lit(1e6)
