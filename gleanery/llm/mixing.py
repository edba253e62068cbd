"""Mix sources to target weights: repetition rates per source, whole copies plus one hash-seeded Bernoulli copy.

Defined results: a null text has size 0; rows without source form a source of their own, last in order; a source whose rows
are all empty has rate 0; repeated rows each count and draw alike; rows without doc_id share one draw. An empty table gives
an empty mix. Sources are only counted, never gathered: a source holding most rows costs one partial sum per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.texts import stored, word_count
from gleanery.operators.lookup import lookup_join

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
SEED = "mix-1"
_DRAWS = 2**32


def source_key(source: Column) -> Column:
    """A key that is never null, so that rows without source join as well; sorts by code point, null last."""
    return F.when(source.isNull(), "~").otherwise(F.concat(F.lit("s"), source))


def numbered(sources: DataFrame, key: str) -> DataFrame:
    """Adds `place`, the position of each row in the order of the key, without sorting in one task."""
    spark = sources.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = sources.repartitionByRange(width, key).sortWithinPartitions(key)
    placed = stored(placed.withColumn("_id", F.monotonically_increasing_id()), "sources")
    placed = placed.withColumn("_part", F.shiftright("_id", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    local = F.col("_id") - F.shiftleft("_part", 33)
    return lookup_join(placed, offsets, ["_part"], "inner").select(*sources.columns, (F.col("_before") + local).alias("place"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source: key, source_size, target, rate.

    `sizes` has key and size. All sizes are shared by weight; a source that would be repeated more than `max_repeat` times stops
    there and what it leaves is shared again, until none is above. Each round is one sum over the sources; only two
    numbers reach the driver.
    """
    summed = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*map(F.lit, weights))
    weight = F.element_at(cycle, (F.pmod("place", F.lit(len(weights))) + 1).cast("int")).cast("long")
    sources = stored(numbered(summed, "key").withColumn("weight", weight), "weighted")
    limit = F.col("source_size") * max_repeat
    first = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, rest, shares = first[0] or 0, first[0] or 0, first[1] or 0
    while True:
        share = F.lit(float(rest)) * F.col("weight") / F.lit(float(shares or 1))
        above = share > limit
        kept, left = sources.agg(F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight")))).first()
        kept, left = kept or 0, left or 0
        if total - kept == rest and left == shares:
            break
        rest, shares = total - kept, left
    target = F.when(above, limit.cast("double")).otherwise(share)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return sources.select("key", "source_size", target.alias("target"), rate.alias("rate"))


def copies(rate: Column, doc_id: Column, seed: str = SEED) -> Column:
    """How often a document is emitted: floor(rate), and once more with probability rate - floor(rate)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / _DRAWS
    whole = F.floor(rate)
    return whole + F.when(draw < rate - whole, 1).otherwise(0)


def mixed(docs: DataFrame, plan: DataFrame, seed: str = SEED) -> DataFrame:
    """The documents of the mix: each row as often as its source's rate and its own draw say, columns unchanged."""
    keyed = docs.select(source_key(F.col("source")).alias("_key"), F.struct(*(docs[c] for c in docs.columns)).alias("_doc"))
    rated = lookup_join(keyed, plan.select(F.col("key").alias("_key"), F.col("rate").alias("_rate")), ["_key"], "inner")
    number = copies(F.col("_rate"), F.col("_doc.doc_id"), seed).cast("int")
    return rated.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), number))).select("_doc.*")


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", source_key(F.col("source")).alias("key"), word_count(F.col("text")).alias("size"))


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Plan and emission over one table of documents."""
    return mixed(docs, targets(sized(docs)), seed)


def digest(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Per document: size, source_size, target, and the words the mix takes of it. The texts are read once."""
    sizes = stored(sized(docs), "sizes")
    rows = lookup_join(sizes, targets(sizes), ["key"], "inner")
    taken = F.col("size") * copies(F.col("rate"), F.col("doc_id"), seed)
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"))
