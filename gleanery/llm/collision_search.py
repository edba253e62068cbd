"""Nearest neighbours by largest inner product with collision-counting hashing.

Vectors are scaled by the largest norm of the table and get one more coordinate that makes all of them unit vectors; then the largest
inner product is the smallest distance to the query's unit vector. `PROJECTIONS` random lines each keep the vectors of a shard
as a sorted array. A query looks at a window around its own place in every array; windows widen together (virtual rehashing: a
larger radius is a wider window of the same array). A vector that lies in at least NEEDED windows is verified once with its
exact inner product. A query is done in a shard when its k-th best is within the current radius; the last radius takes in
every vector.

At radius R a vector within R lies in a window with probability 0.826, so of `PROJECTIONS` = 48 windows it is in 39.6 on average; the
threshold of 31 misses it with probability below 0.001.

Shards and query blocks follow from hashes of vec_id and hold about SHARD and QUERY_BLOCK rows; every pair of them is a group
of its own, which returns at most k rows per query. No shard is left out.

Defined results: vectors null, empty, zero or with null or non-finite components take no part, neither do rows without vec_id; vectors
of another length than the query's are no candidates. Ties go to the smaller vec_id. Rows that repeat a vec_id are
candidates each, but never of a query with that vec_id; as queries they count once, with the first vector by hash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.texts import stored
from gleanery.llm.vectors import usable
from gleanery.operators.lookup import lookup_join

NEAREST = 20
PROJECTIONS = 48
NEEDED = 31
HALF_WINDOW = 1.36  # of the radius; the window of width 2.72 R is where two radii in a ratio of 2 differ most
RADII = (0.4, 0.6, 0.9, 1.35)
SHARD, QUERY_BLOCK = 8192, 512
SEED = 20


def augmented(vectors: np.ndarray, largest: float) -> np.ndarray:
    scaled = vectors / largest
    return np.column_stack([scaled, np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))])


class SortedLines:
    """The vectors of a shard, projected on each line and sorted there: the places in order, and the rank of each vector."""

    def __init__(self, vectors: np.ndarray, lines: np.ndarray, largest: float) -> None:
        places = (augmented(vectors, largest) @ lines).T
        order = np.argsort(places, axis=1, kind="stable")
        self.places = np.take_along_axis(places, order, axis=1)
        self.ranks = np.empty(order.shape, dtype=np.uint16 if len(vectors) < 1 << 16 else np.uint32)
        np.put_along_axis(self.ranks, order, np.arange(len(vectors), dtype=self.ranks.dtype)[None, :], axis=1)

    def collisions(self, at: np.ndarray, half: float) -> np.ndarray:
        """For each query (row) and vector (column) the number of windows around the query that hold the vector."""
        counts = np.zeros((len(at), self.ranks.shape[1]), dtype=np.uint8)
        for line, ranks, own in zip(self.places, self.ranks, at.T, strict=True):
            low = np.searchsorted(line, own - half).astype(ranks.dtype)
            width = np.searchsorted(line, own + half, side="right").astype(ranks.dtype) - low
            counts += ranks[None, :] - low[:, None] < width[:, None]  # unsigned: ranks below the window wrap around
        return counts


def search_shard(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, largest: float, k: int) -> list[tuple]:
    """(query, vec_id, score) of the k best of the shard found for each query."""
    lines = np.random.default_rng(SEED).standard_normal((vectors.shape[1] + 1, PROJECTIONS))
    index = SortedLines(vectors, lines, largest)
    norms = np.sqrt((queries**2).sum(axis=1))
    at = np.column_stack([queries / norms[:, None], np.zeros(len(queries))]) @ lines
    left = ids[None, :] != query_ids[:, None]  # not yet verified
    active, best, found = np.arange(len(queries)), [(ids[:0], np.zeros(0))] * len(queries), []
    for radius in (*RADII, math.inf):
        fresh = left[active] if math.isinf(radius) else left[active] & (index.collisions(at[active], HALF_WINDOW * radius) >= NEEDED)
        left[active] &= ~fresh
        more = []
        for q, row in zip(active.tolist(), fresh, strict=True):
            candidates = np.flatnonzero(row)
            names = np.concatenate([best[q][0], ids[candidates]])
            scores = np.concatenate([best[q][1], np.einsum("ij,j->i", vectors[candidates], queries[q])])
            if len(scores) > k:
                near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])  # with all ties
                names, scores = names[near], scores[near]
            order = np.lexsort((names, -scores))[:k]
            best[q] = names[order], scores[order]
            least = norms[q] * largest * (1 - radius**2 / 2)  # the inner product at the distance of the radius
            if math.isinf(radius) or (len(order) == k and best[q][1][-1] >= least):
                found += [(int(query_ids[q]), int(name), float(score)) for name, score in zip(*best[q], strict=True)]
            else:
                more.append(q)
        active = np.array(more, dtype=int)
        if not len(active):
            break
    return found


def search(vectors: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of `vectors` for each of `queries` (both vec_id, embedding)."""

    def prepared(rows: DataFrame) -> DataFrame:
        wide = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
        return wide.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).withColumn("length", F.size("vector"))

    own = stored(prepared(vectors), "vectors")
    asked = prepared(queries).groupBy("vec_id").agg(F.min_by(F.struct("vector", "length"), F.xxhash64("vector")).alias("_v"))
    asked = stored(asked.select("vec_id", "_v.*"), "queries")
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    sizes = own.groupBy("length").agg(
        F.sqrt(F.max(square)).alias("largest"), F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("shards")
    )
    blocks = asked.groupBy("length").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks"))
    plan = stored(sizes.join(blocks, "length"), "plan")

    def placed(rows: DataFrame, shard: Column, block: Column) -> DataFrame:
        held = lookup_join(rows, plan, ["length"], "inner")
        return held.select("vec_id", "vector", "largest", "length", shard.alias("shard"), block.alias("block"))

    number = F.xxhash64("vec_id")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    in_shard = placed(own, F.pmod(number, F.col("shards")).cast("int"), F.lit(0)).drop("block")
    in_shard = lookup_join(in_shard, plan.select("length", "blocks"), ["length"], "inner").withColumn("block", every("blocks"))
    in_block = placed(asked, F.lit(0), F.pmod(number, F.col("blocks")).cast("int")).drop("shard")
    in_block = lookup_join(in_block, plan.select("length", "shards"), ["length"], "inner").withColumn("shard", every("shards"))
    in_block = in_block.select(*(F.col(c).alias(c) for c in in_block.columns))  # columns of its own: both sides share the plan
    grid = ["length", "shard", "block"]

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ("query_id", "vec_id", "score")
        found = []
        if left.num_rows and right.num_rows:
            matrix = lambda table: table["vector"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
            ids, asking = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            found = search_shard(matrix(left), ids, matrix(right), asking, left["largest"][0].as_py(), k)
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=list(names))

    pairs = in_shard.groupBy(*grid).cogroup(in_block.groupBy(*grid)).applyInArrow(nearest, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
