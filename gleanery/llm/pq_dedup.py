"""Near-duplicate vectors by product quantisation: coarse inverted lists, residual subspace codes, exact cosine rerank.

A vector is stored once, in the list of its nearest coarse centre, as codes of its residual in SUBSPACES subspaces and the
error of that code. A query reads every list that can hold a partner: partners at cosine c are at most r = sqrt(2 - 2c)
apart as unit vectors, and a vector in another list lies beyond the plane halfway between the two centres, so lists whose
plane is farther than r are skipped. In a list the asymmetric distance (query exact, stored vector as code, by table look-up) less
the stored error is a lower bound of the true distance; what it cannot rule out is compared exactly. Both bounds are certain, so
no link is lost, whatever the centres are.

Centres and codebooks are fitted on the driver from a bounded sample (`SAMPLE` vectors by a hash of vec_id). Equal vectors under a
label form a class and are searched once. Lists and their queries are cut into blocks of about BLOCK rows, each pair of blocks a
group of its own; a block returns counts per query and a spanning forest of its links, never the pairs.

Defined results: vectors without label, null, empty, zero or with null or non-finite components are linked with nothing, and so are
vectors of different lengths. Repeated rows count as other vectors. Rows sharing a vec_id but not the vector are taken as
one node. A row without vec_id counts only as a copy; where no copy has a vec_id, component_id is null and it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.graph import components
from gleanery.llm.minhash import spanning
from gleanery.llm.texts import stored
from gleanery.llm.vectors import gridded, in_blocks, stacked, usable

COSINE = 0.98
SAMPLE = 1 << 15
LISTS = 1024
VECTORS_PER_CENTRE = 2048
SUBSPACES = 8
CODES = 32
ROUNDS = 8
BLOCK = 1024
SLACK = 1e-9


def squared(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of two matrices."""
    return np.maximum((one**2).sum(axis=1)[:, None] + (other**2).sum(axis=1)[None, :] - 2 * one @ other.T, 0)


def k_means(points: np.ndarray, count: int, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's rounds from evenly spaced starting points; a centre that loses all points stays where it is."""
    centres = points[np.linspace(0, len(points) - 1, min(count, len(points))).astype(int)].copy()
    for _ in range(rounds):
        nearest = squared(points, centres).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


@dataclass
class Quantiser:
    """Coarse centres and a codebook per subspace; `parts` are the columns of each subspace."""

    centres: np.ndarray
    parts: list[np.ndarray]
    books: list[np.ndarray]

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and code error of unit vectors."""
        lists = squared(units, self.centres).argmin(axis=1)
        rest = units - self.centres[lists]
        codes = np.empty((len(units), len(self.parts)), dtype=np.uint8)
        error = np.zeros(len(units))
        for m, (part, book) in enumerate(zip(self.parts, self.books, strict=True)):
            codes[:, m] = squared(rest[:, part], book).argmin(axis=1)
            error += ((rest[:, part] - book[codes[:, m]]) ** 2).sum(axis=1)
        return lists, codes, np.sqrt(error)

    def probes(self, units: np.ndarray, lists: np.ndarray, reach: float) -> list[np.ndarray]:
        """All lists that may hold a vector within reach."""
        apart = squared(units, self.centres)
        own = apart[np.arange(len(units)), lists]
        between = np.sqrt(squared(self.centres, self.centres))[lists]
        return [np.flatnonzero(row) for row in apart - own[:, None] <= 2 * reach * between + SLACK]

    def lower_bounds(self, units: np.ndarray, which: int, codes: np.ndarray, errors: np.ndarray) -> np.ndarray:
        """At least so far is each query (row) from each stored vector (column) of a list."""
        rest = units - self.centres[which]
        total = np.zeros((len(units), len(codes)))
        for m, (part, book) in enumerate(zip(self.parts, self.books, strict=True)):
            total += squared(rest[:, part], book)[:, codes[:, m]]
        return np.sqrt(total) - errors[None, :]


def fit(units: np.ndarray, total: int) -> Quantiser:
    """`total`, the number of vectors to be stored, sets the number of lists."""
    centres = k_means(units, int(np.clip(total / VECTORS_PER_CENTRE, 1, LISTS)))
    rest = units - centres[squared(units, centres).argmin(axis=1)]
    parts = [part for part in np.array_split(np.arange(units.shape[1]), SUBSPACES) if len(part)]
    return Quantiser(centres, parts, [k_means(rest[:, part], CODES) for part in parts])


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per label and vector: node (smallest vec_id), copies, and the vector's length and components."""
    some = rows.filter(F.col("_usable")).groupBy("_h1", "_h2")
    found = some.agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.any_value("label").alias("label"), F.any_value("embedding").alias("vector")
    )
    return found.filter(F.col("node").isNotNull()).withColumn("length", F.size("vector"))


def keyed(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, embedding, whether it takes part, and a 128-bit hash of label and vector."""
    vector = F.col("embedding").cast("array<double>")
    return embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        "label",
        vector.alias("embedding"),
        (F.col("label").isNotNull() & usable(vector)).alias("_usable"),
        F.xxhash64("label", vector).alias("_h1"),
        F.xxhash64(F.lit(7), vector, "label").alias("_h2"),
    )


def search_length(classes: DataFrame, cosine: float) -> DataFrame:
    """a, n, b rows of vectors of one length: n is how many vectors a is linked with, a and b is a link of the spanning forests."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    total = classes.count()
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vector").toArrow()
    width = len(sample["vector"][0])
    points = unit(sample["vector"].combine_chunks().flatten().to_numpy().reshape(-1, width))
    spark = classes.sparkSession
    model = spark.sparkContext.broadcast(fit(points, total))
    layout = pa.schema(
        [("node", pa.int64()), ("raw", pa.binary()), ("list", pa.int32()), ("codes", pa.binary()), ("error", pa.float64()), ("probes", pa.list_(pa.int32()))]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            units = unit(raw)
            lists, codes, errors = model.value.encode(units)
            columns = [
                batch.column("node"),
                pa.array([row.tobytes() for row in raw], pa.binary()),
                pa.array(lists, pa.int32()),
                pa.array([row.tobytes() for row in codes], pa.binary()),
                pa.array(errors),
                pa.array(model.value.probes(units, lists, reach), pa.list_(pa.int32())),
            ]
            others = [batch.column(name) for name in ("label", "copies")]
            yield pa.RecordBatch.from_arrays(columns + others, names=[*layout.names, "label", "copies"])

    kind = dict(classes.dtypes)["label"]
    schema = f"node long, raw binary, list int, codes binary, error double, probes array<int>, label {kind}, copies long"
    index = stored(classes.select("node", "vector", "label", "copies").mapInArrow(encode, schema), "codes")
    lists = index.select("label", "list", "node", "raw", "codes", "error", "copies")
    queries = index.select("label", F.explode("probes").alias("list"), "node", "raw")
    keys = ["label", "list"]
    blocks = in_blocks(lists, keys, "i", BLOCK).join(in_blocks(queries, keys, "j", BLOCK), keys)
    blocks = stored(blocks, "blocks")
    left = gridded(lists, blocks, keys, "i", "j", F.col("node"))
    right = gridded(queries, blocks, keys, "j", "i", F.col("node"))
    right = right.select(*(F.col(c).alias(c) for c in right.columns))  # columns of its own: both sides come from one table

    def rerank(key: tuple, own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(asking):
            return pd.DataFrame({"a": [], "n": [], "b": []}).astype("int64")
        held, asked = stacked(own["raw"]), stacked(asking["raw"])
        codes = np.frombuffer(b"".join(own["codes"]), np.uint8).reshape(len(own), -1)
        bounds = model.value.lower_bounds(unit(asked), key[1], codes, own["error"].to_numpy())
        x, y = np.nonzero(bounds <= reach + 1e-7)
        near, sure = unit(asked), unit(held)
        good = np.concatenate([(near[x[at : at + 65536]] * sure[y[at : at + 65536]]).sum(axis=1) for at in range(0, len(x), 65536)] or [np.zeros(0)])
        ids, partners = asking["node"].to_numpy(), own["node"].to_numpy()
        use = (good >= cosine) & (ids[x] != partners[y])
        x, y = x[use], y[use]
        counts = np.bincount(x, own["copies"].to_numpy()[y], minlength=len(ids)).astype("int64")
        every = [*ids.tolist(), *partners.tolist()]
        place = {node: i for i, node in reversed(list(enumerate(every)))}
        links = spanning(every, ((place[a], place[b]) for a, b in zip(ids[x].tolist(), partners[y].tolist(), strict=True)))
        found = [(int(ids[i]), int(counts[i]), int(ids[i])) for i in np.flatnonzero(counts)]
        return pd.DataFrame(found + [(a, 0, b) for a, b in links], columns=["a", "n", "b"]).astype("int64")

    grid = [*keys, "i", "j"]
    return left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInPandas(rerank, "a long, n long, b long")


def linked(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows = keyed(embeddings)
    classes = stored(classes_of(rows), "classes")
    lengths = [row.length for row in classes.select("length").distinct().collect()]  # of a column of vectors: one, as a rule
    found = classes.select(F.col("node").alias("a"), F.lit(0).cast("long").alias("n"), F.col("node").alias("b"))
    for length in lengths:
        found = found.unionByName(search_length(classes.filter(F.col("length") == length), cosine))
    found = stored(found, "links")
    counts = found.groupBy("a").agg(F.sum("n").alias("_n"))
    roots = components(found.select("a", "b"))
    nodes = classes.join(counts, classes["node"] == counts["a"]).join(roots, "node", "left")
    nodes = nodes.select(
        "_h1", "_h2", (F.col("_n") + F.col("copies") - 1).alias("_links"), F.coalesce("component", "node").alias("_root")
    )
    slim = rows.select("vec_id", "_usable", "_h1", "_h2")
    joined = slim.join(nodes, ["_h1", "_h2"], "left")
    root = F.when(F.col("_usable"), F.col("_root")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.when(F.col("_usable"), F.coalesce("_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        root.alias("component_id"),
        F.coalesce(F.col("vec_id") == root, root.isNull()).alias("kept"),
    )
