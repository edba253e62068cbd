"""Delete runs of lines that stand earlier in the corpus, found by winnowing over line hashes.

A run is repeated if at least `RUN_WORDS` words of whole lines in succession stand earlier, in the order (doc_id, text hash,
line). Winnowing is done over windows of words instead of a fixed number of lines, so a run of one long line is found as
well as one of many short ones: a window is the shortest stretch of lines with RUN_WORDS words that opens with a line
(to the right) or closes with it (to the left). The smallest line hash of a window is its fingerprint. Every repeated run
holds whole windows, so it shares their fingerprints: nothing can be missed.

Fingerprints are counted over the corpus, and only windows whose fingerprint is repeated go on. Windows with equal
content are joined with their first position. A maximal match is the union of the windows that open and close in it, so looking
up windows of both directions extends a match both ways, without comparing each copy with each other. All lines of a window that
stands earlier are deleted; the first position always stays.

Defined results: blank lines have no words, belong to no window and stay, but between two deleted lines they go as well.
Null texts stay null, empty ones empty. Identical rows (same doc_id and text) count as one document and get the same
result; rows without doc_id come first in order. Lines are split at line feeds.
Cost: one shuffle of line hashes by document, one of windows by fingerprint, and texts move only once at the end.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gleanery.llm.texts import stored, word_count

RUN_WORDS = 50
DOC = ("_doc", "_text")


def keys_of(doc_id: Column, text: Column) -> list[Column]:
    """_doc orders documents and is never null; _text tells apart rows that share a doc_id."""
    known = doc_id.isNotNull()
    key = F.struct(known.alias("known"), F.coalesce(doc_id.cast("long"), F.lit(0)).alias("id"))
    return [key.alias("_doc"), F.xxhash64(text).alias("_text")]


def lines_of(docs: DataFrame) -> DataFrame:
    """_doc, _text, line, hash, words of every line that has words, once per document."""
    keyed = docs.select(*keys_of(F.col("doc_id"), F.col("text")), F.posexplode(F.split("text", "\n")).alias("line", "content"))
    hashed = keyed.select(*DOC, "line", F.xxhash64("content").alias("hash"), word_count(F.col("content")).cast("int").alias("words"))
    first = F.row_number().over(Window.partitionBy(*DOC, "line").orderBy("hash"))
    return hashed.filter(F.col("words") > 0).repartition(*DOC).withColumn("_n", first).filter("_n = 1").drop("_n")


def windows_of(lines: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """_doc, _text, begin, end, fingerprint, content hash of each window, opening and closing ones."""
    by_line = Window.partitionBy(*DOC).orderBy("line")
    ended = lines.withColumn("upto", F.sum("words").over(by_line.rowsBetween(Window.unboundedPreceding, 0)))
    ended = ended.withColumn("before", F.col("upto") - F.col("words"))

    def framed(window: WindowSpec) -> Column:
        return F.struct(
            F.min("line").over(window).alias("begin"),
            F.max("line").over(window).alias("end"),
            F.sum("words").over(window).alias("words"),
            F.min("hash").over(window).alias("fingerprint"),
            F.xxhash64(F.collect_list("hash").over(window)).alias("content"),
        )

    opening = Window.partitionBy(*DOC).orderBy("before").rangeBetween(0, run_words - 1)
    closing = Window.partitionBy(*DOC).orderBy("upto").rangeBetween(1 - run_words, 0)
    found = ended.withColumn("opening", framed(opening)).withColumn("closing", framed(closing))
    one = F.explode(F.array_distinct(F.array("opening", "closing"))).alias("w")
    return found.select(*DOC, one).select(*DOC, "w.*").filter(F.col("words") >= run_words).drop("words")


def repeated_lines(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """_doc, _text and the array `gone` of lines to delete, for documents that have any."""
    windows = stored(windows_of(lines_of(docs), run_words), "windows")
    place = F.struct(*DOC, F.col("begin"))
    fingerprints = windows.groupBy("fingerprint").agg(F.min(place).alias("_low"), F.max(place).alias("_high"))
    shared = fingerprints.filter(F.col("_low") < F.col("_high")).select("fingerprint")
    candidates = windows.join(shared, "fingerprint", "left_semi").drop("fingerprint")
    first = candidates.groupBy("content").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    first = first.filter(F.col("_first") < F.col("_last")).select("content", "_first")
    later = candidates.join(first, "content").filter(place > F.col("_first"))
    gone = later.select(*DOC, F.explode(F.sequence("begin", "end")).alias("line"))
    return gone.groupBy(*DOC).agg(F.array_sort(F.collect_set("line")).alias("gone"))


def cleaned(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """doc (the whole row as a struct, so that no column name can clash), text with repeated runs deleted, lines before, lines deleted."""
    found = repeated_lines(docs, run_words)
    keyed = docs.select(F.struct("*").alias("doc")).select("doc", *keys_of(F.col("doc.doc_id"), F.col("doc.text")))
    same = keyed["_doc"].eqNullSafe(found["_doc"]) & keyed["_text"].eqNullSafe(found["_text"])
    rows = keyed.join(found, same, "left").select("doc", "gone")
    lines = F.split("doc.text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
    text = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    return rows.select(
        "doc",
        F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(text).alias("text"),
        F.coalesce(F.when(F.col("doc.text").isNotNull(), F.size(lines)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0)).cast("long").alias("n_deleted"),
    )


def digest(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """Per document: its lines, the lines deleted, and the text that stays."""
    rows = cleaned(docs.select("doc_id", "text"), run_words)
    return rows.select("doc.doc_id", "n_lines", "n_deleted", "text")


def deduplicated(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """The documents with repeated runs deleted; a document of which no word is left goes, unless it had none before."""
    rows = cleaned(docs, run_words)
    left = rows.filter((F.col("n_deleted") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.select(*(F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns))
