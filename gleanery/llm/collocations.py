"""Collocations: frequent phrases of two to LONGEST words, scored by how much more often they stand together than their parts suggest.

A text is lower-cased (A-Z), split at stops and line ends into pieces and those at spaces and tabs into words; nothing crosses a piece or a language.

1. Words are counted per language, and get 64-bit codes; the vocabulary itself is checked for two words with one code (then another salt is taken),
   so codes stand for words exactly. Words below the threshold part the pieces, as no candidate holds them.
2. Every word position is a suffix of at most LONGEST words. Suffixes are globally routed into buckets by their first word, those of a hot first word
   by the second, too; equal ones of a task are merged before they move. A bucket that turns out to hold more than BUCKET_ROWS suffixes is routed
   again by one more word, and so on, so neither a frequent opening nor the size of the corpus makes a bucket too large for a task.
3. Each bucket is sorted by multikey three-way quicksort on its suffix pointers, down to the longest phrase: the weight of an equal partition is the
   count of its opening; partitions lighter than the threshold are abandoned. Openings shorter than the routed words are summed over buckets.
4. Counts of parts, longer candidates and words are joined to the candidates, which are few: each has at least LEAST occurrences.

Defined results: null and empty texts have no words; a null language is `und`; repeated rows count each; of equally good cuts the first counts;
ties in rank go to the more frequent, then the smaller phrase in byte order. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.minhash import mixed64
from gleanery.llm.texts import stored
from gleanery.operators.lookup import lookup_join

LONGEST = 5
LEAST = 100
TOP = 2000
BUCKET_ROWS = 1 << 20
FANOUT = 1024
LEVELS = 12
SHARES = 64
FLUSH_WORDS = 1 << 20
CACHE_WORDS = 400_000
#: Frequent codes are sent to the tasks up to this number (16 MB).
KNOWN_CODES = 2 << 20
UNKNOWN_LANGUAGE = "und"
STOPS = b".,;:!?\n\x0b\f\r"
#: A byte that no UTF-8 text holds stands for a stop.
STOP = b"\xff"
_STOPPED = bytes.maketrans(STOPS, STOP * len(STOPS))
SEED = 42


def words_of(text: str) -> list[bytes]:
    """Words of a text, with STOP between its pieces."""
    return text.encode().lower().translate(_STOPPED).replace(STOP, b" " + STOP + b" ").split()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"), "text")


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n: a row for each word of each language."""
    layout = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def rows(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            found.pop(STOP, None)
            columns = [pa.array([lang] * len(found)), pa.array(list(found), pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64())]
            yield pa.record_batch(columns, schema=layout)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                counts.setdefault(lang, Counter()).update(words_of(text.as_py() or ""))
                if sum(map(len, counts.values())) > CACHE_WORDS:
                    yield from rows(counts)
                    counts = {}
        yield from rows(counts)

    partial = _texts(docs).mapInArrow(count, "lang string, word string, n long")
    return partial.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def coded(lang: Column, word: Column, salt: str) -> Column:
    return F.xxhash64(F.concat(F.lit(salt), lang, F.lit("\0"), word))


def vocabulary(docs: DataFrame) -> tuple[DataFrame, str]:
    """Word counts with a code per word (code, lang, word, n), and the salt under which no two words share a code."""
    counts = stored(word_counts(docs), "words")
    tries = 0
    while True:
        salt = "" if tries == 0 else f"{tries}:"
        words = counts.withColumn("code", coded(F.col("lang"), F.col("word"), salt))
        if words.groupBy("code").agg(F.count(F.lit(1)).alias("words")).filter("words > 1").isEmpty():
            return words, salt
        tries += 1


class Codes(dict):
    """Local number of each word of a language in a task; 0 for a stop and for words known to be infrequent."""

    def __init__(self, lang: str, salt: str, table: Table) -> None:
        self.opening, self.table = f"{salt}{lang}\0".encode(), table
        self[STOP] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = self.table.number(xxhash.xxh64_intdigest(self.opening + word, SEED))
        return number


class Routes:
    """Frequent codes in order, and the buckets of each: `first`, and how many from there on."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, unit: int, plain: int) -> None:
        order = np.argsort(codes)
        self.codes, counts = codes[order], counts[order]
        hot = counts > unit
        self.spread = np.where(hot, -(-counts // unit), 1)
        above = plain + np.cumsum(np.where(hot, self.spread, 0)) - self.spread
        self.first = np.where(hot, above, (mixed64(self.codes.view(np.uint64)) % np.uint64(plain)).astype(np.int64))


class Table:
    """What the numbers of words stand for, 0 being no word: places among the frequent codes where these are known, else codes."""

    def __init__(self, routes: Routes | None) -> None:
        self.routes = routes
        self.local = [0]

    def number(self, code: int) -> int:
        signed = code - (1 << 64) if code >> 63 else code
        if self.routes is None:
            self.local.append(signed)
            return len(self.local) - 1
        codes = self.routes.codes
        at = int(np.searchsorted(codes, signed))
        return at + 1 if at < len(codes) and codes[at] == signed else 0

    def symbols(self) -> np.ndarray:
        return np.array(self.local) if self.routes is None else np.arange(len(self.routes.codes) + 1, dtype=np.int32)

    def buckets(self, found: np.ndarray, plain: int) -> np.ndarray:
        """Where suffixes go: by the first word, those of a hot first word by the second, too."""
        if self.routes is None:
            return (mixed64(self.symbols().view(np.uint64)) % np.uint64(plain)).astype(np.int64)[found[0]]
        spread = self.routes.spread[found[0] - 1]
        return self.routes.first[found[0] - 1] + (mixed64(found[1].astype(np.uint64)) % spread.astype(np.uint64)).astype(np.int64)


def windows(numbers: np.ndarray) -> np.ndarray:
    """A row for each column of a suffix, a column for each suffix of at least two words; 0 from the suffix's end on."""
    padded = np.concatenate([numbers, np.zeros(LONGEST, dtype=numbers.dtype)])
    starts = np.flatnonzero((numbers > 0) & (padded[1 : len(numbers) + 1] > 0))
    found = np.zeros((LONGEST, len(starts)), dtype=np.int32)
    going = np.ones(len(starts), dtype=bool)
    for place in range(LONGEST):
        here = padded[starts + place]
        going &= here > 0
        found[place] = np.where(going, here, 0)
    return found


def dealt(found: np.ndarray, symbols: np.ndarray, words: int, fanout: int, level: int) -> np.ndarray:
    """One of `fanout` buckets for each suffix, by its first `words` words."""
    unsigned = symbols.astype(np.int64).view(np.uint64)
    route = np.full(found.shape[1], level, dtype=np.uint64)
    for column in found[:words]:
        route = mixed64(route * np.uint64(0x9E3779B97F4A7C15) + unsigned[column])
    return (route % np.uint64(fanout)).astype(np.int64)


def routed(found: np.ndarray, weights: np.ndarray, symbols: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """bucket, rows and packed suffixes, in the order of their words; equal suffixes are merged."""
    if not found.shape[1]:
        return
    order = np.lexsort((*found[::-1], bucket))
    found, weights, bucket = found[:, order], weights[order], bucket[order]
    new = np.append(True, bucket[1:] != bucket[:-1])
    starts = new.copy()
    for column in found:
        new[1:] |= column[1:] != column[:-1]
    heads = np.flatnonzero(new)
    found, weights, bucket = found[:, heads], np.add.reduceat(weights, heads), bucket[heads]
    bounds = np.append(np.flatnonzero(starts[heads]), len(heads))
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield int(bucket[begin]), end - begin, packed(found[:, begin:end], weights[begin:end], symbols)


_KINDS = {2: np.uint16, 4: np.int32, 8: np.int64}


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, first all lowest bytes: high bytes repeat and compress."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def packed(found: np.ndarray, weights: np.ndarray, symbols: np.ndarray) -> bytes:
    """Suffixes as compressed bytes: how many, of how many words, and the widths; the words, then words of the suffixes and weights."""
    used = np.unique(found)
    used = used[used > 0]
    numbers = np.searchsorted(used, found) + 1
    numbers[found == 0] = 0
    kinds = [symbols.dtype, np.uint16 if len(used) < 65535 else np.int32, np.uint16 if weights.max() < 65536 else np.int64]
    parts = [np.ascontiguousarray(part, dtype=kind) for part, kind in zip((symbols[used], numbers, weights), kinds, strict=True)]
    body = b"".join(map(planes, parts))
    head = np.array([found.shape[1], len(used), *[part.itemsize for part in parts], len(body)], dtype=np.int64)
    return head.tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def unpacked(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes, weights and symbols (the first stands for no word) of several packs, numbered together."""
    parts = []
    for blob in blobs:
        rows, words, *widths, size = np.frombuffer(blob, np.int64, 6).tolist()
        body, at, read = pa.decompress(blob[48:], size, codec="zstd", asbytes=True), 0, []
        for count, width in zip((words, LONGEST * rows, rows), widths, strict=True):
            bytes_of = np.frombuffer(body, np.uint8, count * width, at).reshape(width, -1).T
            read.append(np.ascontiguousarray(bytes_of).view(_KINDS[width]).ravel())
            at += count * width
        parts.append(read)
    every = np.unique(np.concatenate([symbols for symbols, _, _ in parts]))
    found = [np.append(0, np.searchsorted(every, symbols) + 1).astype(np.int32)[numbers].reshape(LONGEST, -1) for symbols, numbers, _ in parts]
    weights = np.concatenate([weights for *_, weights in parts], dtype=np.int64)
    return np.concatenate(found, axis=1), weights, np.concatenate([np.zeros(1, dtype=every.dtype), every])


_BLOB_LAYOUT = pa.schema([("bucket", pa.int64()), ("rows", pa.int64()), ("blob", pa.binary())])
_BLOBS = "bucket long, rows long, blob binary"


def _blob_batch(found: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    if rows := list(found):
        yield pa.record_batch([pa.array(column, kind) for column, kind in zip(zip(*rows), _BLOB_LAYOUT.types, strict=True)], schema=_BLOB_LAYOUT)


def suffixes(docs: DataFrame, salt: str, routes: Broadcast | None, plain: int) -> DataFrame:
    """bucket, rows, blob: the suffixes of all pieces, routed by their first words."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, by_lang = Table(None if routes is None else routes.value), {}
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                found = windows(np.concatenate(held))
                yield from _blob_batch(routed(found, np.ones(found.shape[1], dtype=np.int64), table.symbols(), table.buckets(found, plain)))

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                words = words_of(text.as_py() or "")
                if lang not in by_lang:
                    by_lang[lang] = Codes(lang, salt, table)
                words.append(STOP)
                held.append(np.fromiter(map(by_lang[lang].__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= FLUSH_WORDS or len(table.local) > CACHE_WORDS:
                    yield from flush()
                    held, size = [], 0
                    if sum(map(len, by_lang.values())) > CACHE_WORDS:
                        table, by_lang = Table(table.routes), {}
        yield from flush()

    return _texts(docs).mapInArrow(route, _BLOBS)


def multikey(found: np.ndarray, weights: np.ndarray, least: int, words: int) -> Iterator[tuple[np.ndarray, int]]:
    """Openings of two words and more with their weights, by three-way quicksort of suffix pointers.

    Openings of at least `words` words stand in no other bucket: lighter ones than `least` are abandoned.
    """
    todo = [(np.arange(found.shape[1]), 0)]
    while todo:
        rows, depth = todo.pop()
        floor = least if depth + 1 >= words else 1
        keys, heavy = found[depth][rows], weights[rows]
        pivot = np.sort(keys[:: max(1, len(keys) // 15)])
        pivot = pivot[len(pivot) // 2] or keys.max()
        if pivot == 0:  # all ended
            continue
        same = keys == pivot
        weight = int(heavy[same].sum())
        if weight >= floor:
            equal = rows[same]
            if depth:
                yield found[: depth + 1, equal[0]], weight
            if depth + 1 < LONGEST:
                todo.append((equal, depth + 1))
        if weight < heavy.sum():
            for side in ((keys < pivot) & (keys > 0), keys > pivot):
                if heavy[side].sum() >= floor:
                    todo.append((rows[side], depth))


def openings(blobs: DataFrame, routes: Broadcast | None, least: int, level: int, buckets: int) -> DataFrame:
    """codes, n: openings of the suffixes of each bucket. Buckets of more than BUCKET_ROWS suffixes are not sorted but dealt to
    the next level's buckets by one more word (bucket, rows, blob)."""
    layout = pa.schema([("codes", pa.list_(pa.int64())), ("n", pa.int64()), *_BLOB_LAYOUT])
    words, longer = min(2 + level, LONGEST), min(3 + level, LONGEST)
    most = BUCKET_ROWS if level + 1 < LEVELS else 1 << 62

    def counted(packs: list[bytes]) -> Iterator[pa.RecordBatch]:
        found, weights, codes = unpacked(packs)
        if routes is not None:
            codes = np.append(0, routes.value.codes)[codes]
        rows = [(codes[opening].tolist(), weight) for opening, weight in multikey(found, weights, least, words)]
        empty = [pa.nulls(len(rows), kind) for kind in _BLOB_LAYOUT.types]
        yield pa.record_batch([pa.array([r[0] for r in rows], layout.field(0).type), pa.array([r[1] for r in rows], pa.int64()), *empty], schema=layout)

    def passed(bucket: int, packs: list[bytes]) -> Iterator[pa.RecordBatch]:
        found, weights, symbols = unpacked(packs)
        deal = bucket * FANOUT % (1 << 52) + dealt(found, symbols, longer, FANOUT, level)
        for batch in _blob_batch(routed(found, weights, symbols, deal)):
            yield pa.record_batch([pa.nulls(batch.num_rows, layout.field(0).type), pa.nulls(batch.num_rows, pa.int64()), *batch.columns], schema=layout)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, packs, size, large = None, [], 0, False
        for batch in batches:
            for at, rows, blob in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if at != bucket:
                    if packs:
                        yield from passed(bucket, packs) if large else counted(packs)
                    bucket, packs, size, large = at, [], 0, False
                elif size + rows > most:
                    yield from passed(bucket, packs)
                    packs, size, large = [], 0, True
                packs.append(blob)
                size += rows
        if packs:
            yield from passed(bucket, packs) if large else counted(packs)

    dealt_out = blobs.select(*_BLOB_LAYOUT.names).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt_out.mapInArrow(sort, f"codes array<long>, n long, {_BLOBS}")


def frequent_phrases(docs: DataFrame, words: DataFrame, salt: str, least: int = LEAST) -> DataFrame:
    """codes, n of every phrase of one to LONGEST words that occurs at least `least` times; `words` is its vocabulary."""
    spark = docs.sparkSession
    often = words.filter(F.col("n") >= least)
    total, number = often.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    unit = max(BUCKET_ROWS // 2, -(-total // FANOUT))
    plain = max(1, -(-total // unit))
    routes = None
    if number <= KNOWN_CODES:
        known = often.select("code", "n").toArrow()
        routes = spark.sparkContext.broadcast(Routes(known.column(0).to_numpy(), known.column(1).to_numpy(), unit, plain))
    found = often.select(F.array("code").alias("codes"), "n")
    partial = None
    blobs = suffixes(docs, salt, routes, plain)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for level in range(LEVELS):
        result = stored(openings(blobs, routes, least, level, max(width, 2 * plain)), "openings")
        counted = result.filter(F.col("blob").isNull()).select("codes", "n")
        partial = counted if partial is None else partial.unionByName(counted)
        blobs = result.filter(F.col("blob").isNotNull())
        rows = blobs.agg(F.sum("rows")).first()[0]
        if rows is None:
            break
        plain = max(1, -(-rows // unit))
    summed = partial.groupBy("codes").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return found.unionByName(summed)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language of `docs` (lang, text)."""
    words, salt = vocabulary(docs)
    totals = words.groupBy("lang").agg(F.sum("n").alias("all"))
    often = stored(lookup_join(words.filter(F.col("n") >= least), totals, ["lang"], "inner").select("code", "lang", "word", "all"), "frequent")
    phrases = stored(frequent_phrases(docs, words, salt, least).withColumn("size", F.size("codes")), "phrases")

    inner = phrases.filter("size > 2").select(
        F.explode(F.array(F.expr("slice(codes, 1, size - 1)"), F.expr("slice(codes, 2, size - 1)"))).alias("codes"), F.col("n").alias("longer")
    )
    longest = inner.groupBy("codes").agg(F.max("longer").alias("longer"))
    kept = phrases.filter("size > 1").join(longest, "codes", "left").filter(F.col("longer").isNull() | (F.col("longer") < F.col("n")))
    first = kept.select("codes", F.col("n").alias("a"), F.col("codes")[0].alias("code"), "size")
    candidates = lookup_join(first, often.select("code", "lang", "all"), ["code"], "inner")
    cuts = candidates.select("codes", "lang", "a", F.col("all").alias("n"), "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.withColumns({"head": F.expr("slice(codes, 1, k)"), "tail": F.expr("slice(codes, k + 1, size - k)")})
    counts = phrases.select("codes", "n")
    heads, tails = (counts.select(F.col("codes").alias(side), F.col("n").alias(name)) for side, name in (("head", "l"), ("tail", "r")))
    scored = lookup_join(lookup_join(cuts, heads, ["head"], "inner"), tails, ["tail"], "inner")
    score = F.expr("(cast(1000 as decimal(38, 0)) * a * n) div (cast(l as decimal(38, 0)) * r)")
    lowest = scored.groupBy("codes", "lang", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    ranked = lowest.select("codes", "lang", "a", "n", "cut.score", "cut.l", "cut.r")
    order = [F.desc("score"), F.desc("a")]
    for keys in (["lang", F.pmod(F.xxhash64("codes"), F.lit(SHARES))], ["lang"]):  # no language passes whole through one task
        tied = F.rank().over(Window.partitionBy(*keys).orderBy(*order))
        ranked = ranked.withColumn("tied", tied).filter(F.col("tied") <= top)
    best = stored(ranked, "best")

    places = best.select("codes", F.posexplode("codes").alias("place", "code"))
    spelled = lookup_join(places, often.select("code", "word"), ["code"], "inner").groupBy("codes")
    phrase = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda one: one.word), " ")
    named = best.join(spelled.agg(phrase.alias("phrase")), "codes")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    return named.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
