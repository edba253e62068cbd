"""Helpers for tables of vectors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.lookup import lookup_join


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.when(F.size(vector) > 0, finite & F.exists(vector, lambda x: x != 0)), F.lit(False))


def stacked(blobs: Sequence[bytes]) -> np.ndarray:
    """Rows of float64 vectors that were stored as bytes."""
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)


def in_blocks(rows: DataFrame, keys: list[str], name: str, size: int) -> DataFrame:
    """keys and the number of blocks of about `size` rows that each key needs."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.select(*keys, F.ceil(F.col("_n") / size).cast("int").alias(name))


def gridded(rows: DataFrame, blocks: DataFrame, keys: list[str], own: str, other: str, number: Column) -> DataFrame:
    """Every row in its own block of its key, once for each block of the other side: columns own and other hold block numbers.

    `blocks` has keys and, named as own and other, how many blocks there are. `number` is hashed to find the own block.
    """
    counts = blocks.withColumnsRenamed({own: "_own", other: "_other"})
    held = lookup_join(rows, counts, keys, "inner")
    placed = held.withColumn(own, F.pmod(F.xxhash64(number), F.col("_own")).cast("int"))
    return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_other") - 1))).drop("_own", "_other")
