"""One load from end to end: produce, stage, clean, validate, store, audit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators.clean import clean_records, drop_duplicates_in_run
from gleanery.operators.enrich import backfill_category
from gleanery.operators.limits import Limits
from gleanery.operators.merge import upsert_audit, upsert_summary
from gleanery.operators.stats import batch_summary, observed_rules, run_counts, run_totals, with_rule_counts
from gleanery.operators.validate import validate_records
from gleanery.plans.warehouse import Warehouse
from gleanery.schemas import AUDIT, AUDIT_KEY, RAW
from gleanery.session import shared_folder

_RUN = T.StructType(
    [
        *[f for f in AUDIT if f.name in (*AUDIT_KEY, "started_at", "finished_at", "status", "error_message")],
    ]
)


@dataclass
class SourceRun:
    """One source to ingest: ``produce`` returns its raw records (schema ``RAW``)."""

    source_name: str
    batch_id: str
    produce: Callable[[], DataFrame]


@dataclass
class RunOutcome:
    source_name: str
    batch_id: str
    started_at: datetime
    finished_at: datetime
    success: bool
    error_message: str = ""

    @property
    def duration_seconds(self) -> float:
        return (self.finished_at - self.started_at).total_seconds()


def _now() -> datetime:
    return datetime.now(timezone.utc)


def check_batch(
    raw: DataFrame, ingested_at: Column | None = None, limits: Limits = Limits(), counted: Observation | None = None
) -> DataFrame:
    """Cleaned, de-duplicated and validated rows of raw records, with their ``errors`` and the keys of their run.

    ``counted`` receives the number of rows per broken rule and cut field when an action runs over the result.
    """
    cleaned = drop_duplicates_in_run(clean_records(raw, ingested_at, limits=limits, note_cuts=counted is not None))
    checked = validate_records(cleaned.withColumn("raw_keys", F.struct(*AUDIT_KEY)), limits=limits)
    return checked if counted is None else with_rule_counts(checked, counted).drop("cuts")


def produce(warehouse: Warehouse, run: SourceRun, load_id: str) -> RunOutcome:
    """Stage the raw records of one source; a producer that fails leaves an empty, failed run."""
    started = _now()
    try:
        warehouse.stage(run.produce(), "staged_raw", load_id, producer=run.batch_id)
    except Exception as failure:  # noqa: BLE001 - whatever a producer raises ends only its own run
        return RunOutcome(run.source_name, run.batch_id, started, _now(), False, str(failure))
    return RunOutcome(run.source_name, run.batch_id, started, _now(), True)


def store(
    warehouse: Warehouse,
    load_id: str,
    runs: list[RunOutcome] | None = None,
    categories: DataFrame | None = None,
    ingested_at: Column | None = None,
    raise_failure: bool = False,
    limits: Limits = Limits(),
) -> DataFrame:
    """Process the staged raw records of a load; returns one row with the load's totals.

    Rows per broken rule and cut field are counted while the checked rows are written, and kept as ``rule_counts``.
    A failure to store is written to the audit log; with ``raise_failure`` it is raised after that.

    ``runs`` are the outcomes of the producers; without them every source run found in the staged rows
    counts as a successful one. A run ends as ``failed`` if its producer failed, ``partial`` if storing
    failed, else ``success``.
    """
    spark = warehouse.spark
    raw = warehouse.staged("staged_raw", load_id).drop("producer")
    error, failed = "", None
    try:
        counted = Observation()
        warehouse.stage(check_batch(raw, ingested_at, limits, counted), "staged_checked", load_id)
        warehouse.stage(spark.createDataFrame(observed_rules(counted), "rule string, rows bigint"), "rule_counts", load_id)
        checked = warehouse.staged("staged_checked", load_id)
        warehouse.quarantine(checked, load_id)
        filled = checked if categories is None else backfill_category(checked, categories)
        warehouse.load(filled, load_id)
    except Exception as failure:  # noqa: BLE001 - recorded in the audit log
        error, failed = str(failure) or type(failure).__name__, failure
    checked = warehouse.staged("staged_checked", load_id)

    shared_folder(spark)
    counts = run_counts(raw, checked).checkpoint()  # a row per source run, used for the log and the totals
    if runs is None:
        moment = F.current_timestamp() if ingested_at is None else ingested_at
        entries = counts.select(
            *AUDIT_KEY, moment.alias("started_at"), moment.alias("finished_at"),
            F.lit("partial" if error else "success").alias("status"), F.lit(error).alias("error_message"),
        )
    else:
        status = {True: "partial" if error else "success", False: "failed"}
        rows = [
            (r.batch_id, r.source_name, r.started_at, _now(), status[r.success], r.error_message or error) for r in runs
        ]
        entries = spark.createDataFrame(rows, _RUN)
    renamed = counts.withColumnsRenamed({key: f"_{key}" for key in AUDIT_KEY})
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in AUDIT_KEY]
    logged = entries.join(renamed, same, "left").na.fill(0).select(*AUDIT.fieldNames())

    inserted = warehouse.table("clean_records").filter(F.col("load_id") == load_id)
    summary = batch_summary(inserted)
    touched = summary.select(*AUDIT_KEY).union(logged.select(*AUDIT_KEY))
    known = warehouse.log(without=load_id, runs=touched)
    warehouse.add_to_log(upsert_audit(upsert_summary(known, summary), logged, limits), load_id)
    if failed is not None and raise_failure:
        raise failed
    totals = run_totals(counts, inserted).checkpoint()
    if not error:
        warehouse.clear_stage(load_id)
    return totals


def run_batch(
    warehouse: Warehouse,
    sources: list[SourceRun],
    load_id: str,
    categories: DataFrame | None = None,
    ingested_at: Column | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """Ingest all given sources in one load; a single source is a list of one."""
    outcomes = [produce(warehouse, run, load_id) for run in sources]
    return store(warehouse, load_id, outcomes, categories, ingested_at, limits=limits)


def combine(*producers: DataFrame) -> DataFrame:
    """Raw records of several producers in one frame."""
    first, *others = [frame.select(*RAW.fieldNames()) for frame in producers]
    for frame in others:
        first = first.unionByName(frame)
    return first
