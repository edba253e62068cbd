"""Equi-joins to a lookup side of unknown size and rows of unknown skew.

``lookup_join`` measures the lookup side first; ``spread_join`` starts no job and needs no size: what it broadcasts is bounded
by a number of keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import shared_folder

MAX_BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 32
#: Keys that a spread join sends to all tasks.
HOT_KEYS = 10_000


def lookup_join(
    rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Join ``rows`` to ``lookup`` (inner or left), which holds one row per key.

    The lookup side is computed once and kept under the shared folder, so its size is known: below
    ``max_bytes`` it is broadcast and ``rows`` do not move. Above it the join shuffles with a salt, so
    that a key holding a large share of ``rows`` is spread over ``SALTS`` tasks.
    """
    shared_folder(rows.sparkSession)
    lookup = lookup.checkpoint()
    size = lookup.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    if size <= max_bytes:
        return rows.join(F.broadcast(lookup), on, how)
    return salted_join(rows, lookup, on, how)


def spread_join(rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", hot_keys: int = HOT_KEYS) -> DataFrame:
    """Join ``rows`` to ``lookup`` (inner or left), which holds one row per key.

    The ``hot_keys`` most frequent keys of ``rows`` are found by a partial count; their lookup rows, one each, are broadcast, so
    rows of those keys stay where they are, however many there are. Only rows of the other keys shuffle, none of which
    holds more than a ``hot_keys``-th of all rows, and rows with a missing key, which are spread. Rows are read once for the
    count (keys only) and once for each of the two groups; nothing is stored, and nothing runs until the result is asked for.
    """
    counted = rows.select(*on).groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    hot = F.broadcast(counted.orderBy(F.desc("_rows"), *on).limit(hot_keys).select(*on))
    theirs = F.broadcast(lookup.join(hot, on, "left_semi"))
    direct = rows.join(hot, on, "left_semi").join(theirs, on, how)
    missing = F.lit(False)
    for key in on:
        missing = missing | F.col(key).isNull()
    place = F.when(missing, F.xxhash64(F.spark_partition_id(), *_hashed(rows))).otherwise(F.lit(0).cast("long"))
    others = rows.join(hot, on, "left_anti").withColumn("_place", place)
    shuffled = others.join(lookup.withColumn("_place", F.lit(0).cast("long")), [*on, "_place"], how).drop("_place")
    return direct.unionByName(shuffled)


def _hashed(rows: DataFrame) -> list[str]:
    """The columns that a hash of a row can take in: all without a map inside, structs and lists too."""
    return [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]


def salted_join(rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", salts: int = SALTS) -> DataFrame:
    """Shuffle join in which every key of ``rows`` is split over ``salts`` tasks.

    The salt is a hash of the whole row and its task, so a repeated task puts every row where it was before, and equal rows
    of several tasks are spread.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(F.spark_partition_id(), *_hashed(rows)), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")
