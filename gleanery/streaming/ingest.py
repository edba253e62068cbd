"""Incremental ingest: every trigger takes the files that arrived since the last one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from gleanery.operators.limits import Limits
from gleanery.plans.batch import store
from gleanery.plans.warehouse import Warehouse


def ingest_stream(
    warehouse: Warehouse,
    landing: DataFrame,
    to_raw: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    name: str = "ingest",
    categories: DataFrame | None = None,
    ingested_at: Column | None = None,
    trigger: dict | None = None,
    limits: Limits = Limits(),
) -> StreamingQuery:
    """Start the ingest of a streaming ``landing`` frame; ``to_raw`` turns landed rows into raw records.

    A micro-batch is one load, named after its number. If storing it fails, the audit row is written and the
    failure ends the stream before its offsets are committed, so that the next start runs the same micro-batch again.
    Loads replace their own partitions and ignore their own earlier rows when looking for known keys, so that leaves the
    same tables. Known keys are found by joining the stored table: exact for any age,
    with no state to keep in the stream.
    """

    def one_load(rows: DataFrame, number: int) -> None:
        load_id = f"{name}-{number:09d}"
        warehouse.stage(to_raw(rows), "staged_raw", load_id, producer=name)
        store(warehouse, load_id, categories=categories, ingested_at=ingested_at, raise_failure=True, limits=limits)

    return (
        landing.writeStream.foreachBatch(one_load)
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
