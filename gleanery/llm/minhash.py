"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations make all coordinates of a signature: the first scatters the shingles over a circle of 2^32 places, the second,
shifted by k places, gives coordinate k. BANDS bands of ROWS coordinates let a pair at the threshold of 0.8 collide with
probability 1 - (1 - 0.8^5)^25 = 0.99995.

1. One pass over the texts writes size, fingerprint and bands of each set. Documents with equal sets form a class, which
   goes on as its smallest doc_id: copies are never paired.
2. In each bucket every class is compared with the smallest one (a star, not all pairs), and links that hold on the full sets
   are joined to components.
3. Buckets that still hold several components are compared in full, in square blocks of at most BLOCK classes a side, each a
   task of its own; a block returns a spanning forest of its links, not the pairs. No bucket is capped.

Defined results: a document without words or text has an empty set and is linked with nothing. Rows that share a doc_id are one
document: linked, kept or dropped together. A row without doc_id counts only as a copy: it takes the component of its class and is not
kept; where no row of the class has a doc_id, its component is null and it is kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.graph import components
from gleanery.llm.texts import in_small_batches, lean, stored
from gleanery.operators.lookup import lookup_join

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 25, 5
BLOCK = 128
STRETCH = 8192
CACHE_WORDS = 100_000


class WordHashes(dict):
    """64-bit hash per word, kept while a task runs and emptied before it grows without bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(x: np.ndarray) -> np.ndarray:
    """A permutation of the circle of 2^32 places, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def shingles(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes: A-Z lower-cased, words between ASCII blanks."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    found = mixed64(each[: len(words) - width + 1] + np.uint64(width))
    for step in range(1, width):
        found = mixed64(found ^ each[step : len(words) - width + 1 + step])
    return np.unique(found)


def signature(found: np.ndarray, count: int) -> np.ndarray:
    """Coordinate k is the least place of the set under the second permutation shifted by k."""
    circle = mixed64(found + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)
    shifts = np.arange(1, count + 1, dtype=np.uint32)[:, None]
    least = np.full(count, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(circle), STRETCH):
        np.minimum(least, permuted(circle[None, at : at + STRETCH] - shifts).min(axis=1), out=least)
    return least


def banded(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band, different for equal coordinates of different bands."""
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for row in least.reshape(bands, rows).T.astype(np.uint64):
        keys = mixed64(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys.view(np.int64)


def sketched(docs: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n, print (of the whole set, null if it is empty), bands."""
    layout = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("print", pa.binary()), ("bands", pa.list_(pa.int64()))])

    @lean
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, prints, keys = [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), width, hashes)
                sizes.append(len(found))
                prints.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(banded(signature(found, bands * rows), bands, rows) if len(found) else None)
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, schema=layout)

    rows_of = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows_of.mapInArrow(sketch, "doc_id long, n long, print binary, bands array<long>")


def full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """node, members (the sorted set as bytes) of the documents named by `nodes`; a row for each different text of a doc_id."""
    layout = pa.schema([("node", pa.int64()), ("members", pa.binary()), ("print", pa.binary())])

    @lean
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [shingles(text.as_py(), width, hashes).tobytes() for text in batch.column("text")]
            prints = [xxhash.xxh3_128_digest(members) for members in found]
            yield pa.record_batch([batch.column("node"), pa.array(found, pa.binary()), pa.array(prints, pa.binary())], schema=layout)

    rows = lookup_join(docs.select(F.col("doc_id").cast("long").alias("node"), "text"), nodes.select("node"), ["node"], "inner")
    return in_small_batches(rows).mapInArrow(sets, "node long, members binary, print binary").dropDuplicates(["node", "print"]).drop("print")


def alike(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    both = len(one) + len(other)
    if 100 * min(len(one), len(other)) < percent * max(len(one), len(other)):
        return False
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return shared > 0 and 100 * shared >= percent * (both - shared)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose full sets are alike."""
    layout = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    @lean
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = batch.column("one"), batch.column("other")
            good = [
                alike(np.frombuffer(one[i].as_buffer(), np.uint64), np.frombuffer(other[i].as_buffer(), np.uint64), percent)
                for i in range(batch.num_rows)
            ]
            yield pa.record_batch([batch.column("a"), batch.column("b")], schema=layout).filter(pa.array(good, pa.bool_()))

    first = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("one")), "a")
    second = first.join(sets.select(F.col("node").alias("b"), F.col("members").alias("other")), "b")
    return in_small_batches(second).select("a", "b", "one", "other").mapInArrow(check, "a long, b long")


def shared_counts(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sets, by a product over the shingles that both lists hold."""
    common = np.intersect1d(np.unique(np.concatenate(one)), np.unique(np.concatenate(other)), assume_unique=True)
    total = np.zeros((len(one), len(other)), dtype=np.float32)
    for at in range(0, len(common), STRETCH):
        stretch = common[at : at + STRETCH]
        left, right = (np.zeros((len(side), len(stretch)), dtype=np.float32) for side in (one, other))
        for block, side in ((left, one), (right, other)):
            for i, found in enumerate(side):
                block[i, np.searchsorted(stretch, np.intersect1d(found, stretch, assume_unique=True))] = 1
        total += left @ right.T
    return total.astype(np.int64)


def spanning(nodes: list[int], pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of the pairs (positions in `nodes`) those that join two trees so far."""
    parent = list(range(len(nodes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    chosen = []
    for i, j in pairs:
        if (x := root(i)) != (y := root(j)):
            parent[x] = y
            chosen.append((nodes[i], nodes[j]))
    return chosen


def block_links(open_rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links within the buckets of `open_rows` (band, node, main): a bucket is cut into blocks, a pair of blocks is a task's group.

    `main` marks members of the bucket's first component, which are joined already and not compared with each other. The
    block of a member follows from a hash, so a bucket of any size is spread over many groups of about 2 * BLOCK sets.
    """
    counted = open_rows.groupBy("band").agg(F.count_if("main").alias("mains"), F.count_if(~F.col("main")).alias("others"))
    blocks = counted.select(
        "band", F.ceil(F.col("mains") / BLOCK).cast("int").alias("_m"), F.ceil(F.col("others") / BLOCK).cast("int").alias("_o")
    )
    rows = lookup_join(open_rows, blocks, ["band"], "inner")
    hashed = F.xxhash64("node")
    own = F.when(F.col("main"), F.pmod(hashed, F.col("_m"))).otherwise(F.col("_m") + F.pmod(hashed, F.col("_o"))).cast("int")
    first = F.when(F.col("main"), F.col("_m")).otherwise(0)
    rows = rows.withColumn("own", own).withColumn("with", F.explode(F.sequence(first, F.col("_m") + F.col("_o") - 1)))
    rows = rows.select("band", "node", "own", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))
    held = rows.join(sets, "node")

    def links(group: pd.DataFrame) -> pd.DataFrame:
        i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
        nodes = group["node"].tolist()
        found = [np.frombuffer(x, np.uint64) for x in group["members"]]
        own = group["own"].to_numpy()
        rows_at = np.flatnonzero(own == i)
        columns_at = np.flatnonzero(own == j)
        if not len(rows_at) or not len(columns_at):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        shared = shared_counts([found[k] for k in rows_at], [found[k] for k in columns_at])
        length = np.array([len(x) for x in found])
        union = length[rows_at][:, None] + length[columns_at][None, :] - shared
        x, y = np.nonzero((100 * shared >= percent * union) & (shared > 0))
        chosen = spanning(nodes, ((rows_at[p], columns_at[q]) for p, q in zip(x, y, strict=True) if rows_at[p] != columns_at[q]))
        return pd.DataFrame(chosen, columns=["a", "b"]).astype("int64")

    return held.groupBy("band", "i", "j").applyInPandas(links, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, print, n and component of every row of `docs` (doc_id, text)."""
    sketches = stored(sketched(docs, width), "sketches")
    some = sketches.filter(F.col("print").isNotNull() & F.col("doc_id").isNotNull())
    classes = some.groupBy("print").agg(F.min("doc_id").alias("node"), F.min("n").alias("n"), F.any_value("bands").alias("bands"))
    classes = stored(classes, "classes")
    bands = classes.select(F.explode("bands").alias("band"), "node", "n")
    buckets = bands.groupBy("band").agg(F.min(F.struct("node", "n")).alias("centre"), F.count(F.lit(1)).alias("size"))
    members = stored(bands.join(buckets.filter("size > 1"), "band"), "members")
    small, large = F.least("n", "centre.n"), F.greatest("n", "centre.n")
    stars = members.filter((F.col("node") != F.col("centre.node")) & (100 * small >= percent * large))
    stars = stored(stars.select(F.col("node").alias("a"), F.col("centre.node").alias("b")).distinct(), "stars")
    # documents that share an id are one document
    twins = some.groupBy("doc_id").agg(F.min("print").alias("_p"), F.max("print").alias("_q")).filter("_p != _q").select("doc_id")
    ids = some.join(classes.select("print", "node"), "print").join(twins, "doc_id", "left_semi")
    same = ids.select(F.col("node").alias("a"), F.col("doc_id").alias("b")).distinct()
    sets = stored(full_sets(docs, members.select("node").distinct(), width), "sets")
    links = stored(verified(stars, sets, percent).unionByName(same), "links")
    found = components(links)
    joined = members.select("band", "node", "size").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = joined.filter("size > 2").groupBy("band").agg(F.min("component").alias("_p"), F.max("component").alias("_q")).filter("_p != _q")
    unresolved = lookup_join(joined, several, ["band"], "inner")
    unresolved = stored(unresolved.select("band", "node", (F.col("component") == F.col("_p")).alias("main")), "open")
    if not unresolved.isEmpty():
        found = components(links.unionByName(block_links(unresolved, sets, percent)))
    nodes = classes.select("print", "node").join(found, "node", "left").select("print", F.coalesce("component", "node").alias("component"))
    return sketches.join(nodes, "print", "left").select(
        "doc_id", "print", "n", F.when(F.col("print").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component")
    )


def kept(doc_id: Column, component: Column) -> Column:
    return F.coalesce(doc_id == component, component.isNull())


def digest(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    rows = near_duplicates(docs, width, percent)
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept(F.col("doc_id"), F.col("component")).alias("kept")
    )


def one_of_each(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents with one of each group left, the one with the smallest doc_id; columns unchanged.

    Of rows without doc_id those stay whose set no document with a doc_id has.
    """
    rows = near_duplicates(docs, width, percent)
    gone = ~kept(F.col("doc_id"), F.col("component"))
    marks = rows.filter(gone & F.col("doc_id").isNotNull()).select("doc_id", F.lit(True).alias("dropped")).distinct()
    wrapped = docs.select(F.struct("*").alias("doc")).withColumn("doc_id", F.col("doc.doc_id").cast("long"))  # no name can clash
    left = lookup_join(wrapped, marks, ["doc_id"], "left").filter(F.col("dropped").isNull())

    @F.pandas_udf("binary")
    def print_of(texts: pd.Series) -> pd.Series:
        hashes = WordHashes()
        sets = (shingles(text, width, hashes) for text in texts)
        return pd.Series([xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None for found in sets], dtype=object)

    nameless = left.filter(F.col("doc_id").isNull()).select("doc", print_of("doc.text").alias("print"))
    known = rows.filter(gone & F.col("doc_id").isNull()).select("print").distinct()
    return left.filter(F.col("doc_id").isNotNull()).select("doc.*").unionByName(nameless.join(known, "print", "left_anti").select("doc.*"))
