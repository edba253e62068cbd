"""Keyed merges as DataFrame functions: keep what exists, or overwrite chosen columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.clean import keep_first
from gleanery.operators.limits import Limits
from gleanery.schemas import AUDIT_KEY


def rows_to_insert(existing: DataFrame, new: DataFrame, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """New rows whose key is not stored yet, first one per key. Only the key of ``existing`` is read."""
    keys = keys or ["fingerprint"]
    return keep_first(new, keys, order).join(existing.select(*keys), keys, "left_anti")


def keyed_merge(existing: DataFrame, new: DataFrame, keys: list[str], overwrite: list[str]) -> DataFrame:
    """All rows of both sides by key; on a match the ``overwrite`` columns come from ``new``.

    Both sides hold one row per key; keys may be NULL. A NULL in other columns of ``new`` does overwrite.
    """
    columns = existing.columns
    old = existing.select(F.struct(*columns).alias("_old"))
    fresh = new.select(F.struct(*columns).alias("_new"))
    same = [F.col(f"_old.{key}").eqNullSafe(F.col(f"_new.{key}")) for key in keys]
    joined = old.join(fresh, same, "full_outer")

    def value(name: str):
        if name in keys:
            return F.coalesce(f"_old.{name}", f"_new.{name}").alias(name)
        after = F.col(f"_new.{name}")
        before = F.col(f"_old.{name}")
        stays = F.col("_new").isNull() if name in overwrite else F.col("_old").isNotNull()
        return F.when(stays, before).otherwise(after).alias(name)

    return joined.select(*[value(name) for name in columns])


def upsert_audit(log: DataFrame, runs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Audit rows after logging ``runs``: on a known key everything but the start time is replaced."""
    cut = runs.withColumn("error_message", F.left(F.coalesce("error_message", F.lit("")), F.lit(limits.error_message)))
    replaced = [name for name in log.columns if name not in (*AUDIT_KEY, "started_at")]
    return keyed_merge(log, cut, AUDIT_KEY, replaced)


def upsert_summary(log: DataFrame, summary: DataFrame) -> DataFrame:
    """Audit rows after a batch summary: on a known key only count, end time and status are replaced."""
    filled = summary
    for name in log.columns:
        if name not in filled.columns:
            empty = F.lit("") if name == "error_message" else F.lit(0) if name.startswith("records_") else F.lit(None)
            filled = filled.withColumn(name, empty.cast(log.schema[name].dataType))
    return keyed_merge(log, filled, AUDIT_KEY, ["records_clean", "finished_at", "status"])
