"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.texts import stored


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) for every node of `edges` (a, b; longs that are not null).

    Alternating large-star and small-star steps until nothing changes. Every step is a minimum per node (summed before the
    shuffle) and a join that Spark may split where a node has very many edges; each result is written to the shared folder.
    """
    links = edges.filter(F.col("a") != F.col("b"))
    links = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        links = stored(small_star(large_star(links)), "stars")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    centres = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)


def large_star(links: DataFrame) -> DataFrame:
    """Every node points its larger neighbours to the smallest one around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    larger = both.filter(F.col("b") > F.col("a")).join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Every node points itself and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("_m"))
    smaller = links.join(least, "a").filter(F.col("b") != F.col("_m")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return smaller.unionByName(least.select("a", F.col("_m").alias("b"))).distinct()
