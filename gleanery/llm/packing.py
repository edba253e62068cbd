"""Pack token pieces into sequences with a grouping genetic algorithm on islands.

Whole documents are tokenised; a document longer than a sequence is cut into full pieces and a rest. Full pieces fill a sequence
each. All others are dealt into shards of about SHARD pieces by a hash; a shard is one problem of the algorithm and small enough
for a task, the number of shards grows with the corpus.

A solution is a list of bins. Crossover takes whole well-filled bins of one parent into the other, removes the bins that now hold
duplicates, and puts the displaced pieces back by best fit, longest first. Mutation opens the emptiest bins and fills them anew, each with
the piece or pair of pieces that leaves least room; the first solutions are made so, too, but for one by best fit. Every shard evolves on
ISLANDS islands, each a row of its own; after an epoch the best solution of an island migrates to the next one. A shard that needs
no more bins than its tokens do is finished at once.

The bins that stay least filled in each shard are opened again, and their pieces are packed once more over all shards, until
one shard is left or their sequences do not get fewer by a GAIN-th: what is lost to the borders between shards is little in the end.

Defined results: a null text is empty and still has its end token; repeated rows are packed each; an empty table gives no rows;
rows without doc_id are packed like others. Reruns over the same files give the same sequences.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.texts import in_small_batches, kept_table, lean, stored

CAPACITY = 2048
END = 0
SHARD = 2048
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 10
POPULATION = 5
GAIN = 0.01
CACHE_WORDS = 400_000
TOGETHER = 256
CALL_WORDS = 16384
STOPS = ".,;:!?"
WORD_END = "</w>"
BATCH_BYTES = 4 << 20


def lists_of(ids: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """A column of id lists that lie one after the other."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype("<i4")), pa.array(ids.astype("<u4", copy=False)))


def ends_of(lists: pa.ListArray) -> np.ndarray:
    return np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)


class Tokens:
    """Token ids of texts, as little-endian 32-bit bytes.

    The tokenizer lower-cases, drops white space and joins nothing across it, nor a stop with the letter or digit before it: a text
    is the sum of its blank-separated chunks, a chunk the sum of a word and its stop. Texts, chunks and ids stay Arrow columns: only
    words that are new become Python objects, each tokenised once, and a text's ids are taken by index. The first CACHE_WORDS
    words are kept, which are the frequent ones. Words of letters only are tokenised many at a time, CALL_WORDS in one call of the
    tokenizer, whose results take some hundred times the bytes of the ids.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # tokens that end a word
        self.closing[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.words = pa.array([], pa.string())
        self.ids = lists_of(np.array([], dtype="<u4"), np.array([], dtype=np.int64))
        self.stop_ids = np.array([self.alone([stop])[0] for stop in STOPS], dtype="<u4").ravel()

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text of a string column without nulls, end token not included."""
        upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < len(texts):
            before = int(upto[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, before + BATCH_BYTES, side="right")))
            yield from self.batch(texts.slice(begin, end - begin))
            pa.default_memory_pool().release_unused()
            begin = end

    def batch(self, texts: pa.Array) -> Iterator[bytes]:
        # upper-case letters in the name of a special token keep it from being one
        lowered = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(lowered)
        chunks = split.flatten().dictionary_encode()
        taken = self.of_chunks(chunks.dictionary).take(chunks.indices)
        data = taken.flatten().to_numpy(zero_copy_only=False)
        chunk_ends = np.concatenate([[0], ends_of(taken)])
        begin = 0
        for end in chunk_ends[ends_of(split)].tolist():
            yield data[begin:end].tobytes()
            begin = end

    def of_chunks(self, chunks: pa.StringArray) -> pa.ListArray:
        """Ids of different chunks: those of the word, then the stop's."""
        stopped = pc.match_substring_regex(chunks, rf"[0-9A-Za-z][{STOPS}]\z")
        bare = pc.if_else(stopped, pc.utf8_slice_codeunits(chunks, 0, -1), chunks).dictionary_encode()
        found = self.of_words(bare.dictionary).take(bare.indices)
        mark = stopped.to_numpy(zero_copy_only=False)
        ends = ends_of(found) + np.cumsum(mark)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, dtype="<u4")
        own = np.ones(len(ids), dtype=bool)
        own[ends[mark] - 1] = False
        ids[own] = found.flatten().to_numpy(zero_copy_only=False)
        last = pc.utf8_slice_codeunits(chunks.filter(stopped), -1)
        ids[~own] = self.stop_ids[pc.index_in(last, value_set=pa.array(list(STOPS))).to_numpy(zero_copy_only=False).astype(np.int64)]
        return lists_of(ids, ends)

    def of_words(self, words: pa.StringArray) -> pa.ListArray:
        """Ids of different words."""
        place = pc.index_in(words, value_set=self.words)
        new = place.is_null()
        fresh = words.filter(new)
        parts = [self.tokenised(fresh.slice(at, CALL_WORDS)) for at in range(0, len(fresh), CALL_WORDS)]
        ids = pa.concat_arrays(parts) if parts else self.ids.slice(0, 0)
        missing = new.to_numpy(zero_copy_only=False)
        at = pc.fill_null(place, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at[missing] = len(self.words) + np.arange(len(fresh))
        found = pa.concat_arrays([self.ids, ids]).take(pa.array(at))
        room = min(CACHE_WORDS - len(self.words), len(fresh))
        if room > 0:
            self.words = pa.concat_arrays([self.words, fresh.slice(0, room)])
            self.ids = pa.concat_arrays([self.ids, ids.slice(0, room)])
        return found

    def tokenised(self, words: pa.StringArray) -> pa.ListArray:
        letters = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        plain, rest = np.flatnonzero(letters), [np.flatnonzero(~letters)]
        groups = [plain[at : at + TOGETHER] for at in range(0, len(plain), TOGETHER)]
        joined = [" ".join(words.take(pa.array(group)).to_pylist()) for group in groups]
        order, ids, lengths = [], [], []
        for group, one in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            own = np.array(one.ids, dtype="<u4")
            ends = np.flatnonzero(self.closing[own]) + 1
            if len(ends) != len(group):  # a letter that the tokenizer does not take for one
                rest.append(group)
                continue
            order.append(group)
            ids.append(own[: ends[-1]])
            lengths.append(np.diff(ends, prepend=0))
        left = np.concatenate(rest)
        for own in self.alone(words.take(pa.array(left)).to_pylist()):
            ids.append(own)
            lengths.append(np.array([len(own)]))
        place = np.empty(len(words), dtype=np.int64)
        place[np.concatenate([*order, left])] = np.arange(len(words))
        nothing = np.array([], dtype="<u4")
        found = lists_of(np.concatenate([nothing, *ids]), np.cumsum(np.concatenate([nothing.astype(np.int64), *lengths])))
        return found.take(pa.array(place))

    def alone(self, words: list[str]) -> list[np.ndarray]:
        return [np.array(one.ids, dtype="<u4") for one in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]


def tokens_for(path: str) -> Tokens:
    """One table of chunks per Python worker, which Spark uses for many tasks."""
    return kept_table(path, Tokens)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, the ids of every piece of every document."""
    layout = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    layout += [("ids", pa.list_(pa.int32()))] if with_ids else []
    end = np.array([END], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_for(path)
        for batch in batches:
            rows: list[list] = [[] for _ in layout]
            texts = pc.fill_null(batch.column("text"), "")
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.encode(texts), strict=True):
                ids += end
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    values = [doc_id, number, at // 4, len(part) // 4, zlib.crc32(part)]
                    values += [np.frombuffer(part, "<i4")] if with_ids else []
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
            yield pa.record_batch([pa.array(c, kind) for c, (_, kind) in zip(rows, layout, strict=True)], names=[name for name, _ in layout])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    texts = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(lean(cut, path), schema)


Bins = list[list[int]]


def best_fit(items: list[int], lengths: list[int], bins: Bins, capacity: int) -> Bins:
    """Puts the items, longest first, each into the fullest bin it fits in; the bins are changed."""
    room = sorted((capacity - sum(lengths[i] for i in own), b) for b, own in enumerate(bins))
    for item in sorted(items, key=lambda i: -lengths[i]):
        need = lengths[item]
        at = bisect.bisect_left(room, (need, -1))
        if at == len(room):
            bins.append([item])
            bisect.insort(room, (capacity - need, len(bins) - 1))
        else:
            left, b = room.pop(at)
            bins[b].append(item)
            bisect.insort(room, (left - need, b))
    return bins


def fitness(bins: Bins, lengths: list[int]) -> tuple[int, int]:
    """Fewer bins are better, then fuller ones."""
    return len(bins), -sum(sum(lengths[i] for i in own) ** 2 for own in bins)


def crossover(one: Bins, other: Bins, lengths: list[int], capacity: int, rng: np.random.Generator) -> Bins:
    filled = sorted(range(len(other)), key=lambda b: -sum(lengths[i] for i in other[b]))
    best = filled[: max(1, len(filled) // 2)]
    injected = [other[b] for b in rng.choice(best, size=max(1, len(best) // 2), replace=False)]
    taken = {i for own in injected for i in own}
    stay, displaced = [], []
    for own in one:
        if taken.isdisjoint(own):
            stay.append(list(own))
        else:
            displaced += [i for i in own if i not in taken]
    return best_fit(displaced, lengths, stay + [list(own) for own in injected], capacity)


def completing(free: np.ndarray, room: int) -> list[int]:
    """Places of the one or two of the ascending lengths that fill the room best; none if nothing fits."""
    single = int(np.searchsorted(free, room, side="right")) - 1
    if single < 0:
        return []
    partner = np.minimum(np.searchsorted(free, room - free, side="right"), np.arange(len(free))) - 1
    sums = np.where(partner >= 0, free + free[partner], 0)
    pair = int(np.argmax(sums))
    return [pair, int(partner[pair])] if sums[pair] > free[single] else [single]


def filled_by_subsets(items: list[int], lengths: list[int], bins: Bins, capacity: int, rng: np.random.Generator | None = None) -> Bins:
    """Opens bins for the items, each with the longest one left (one of the longest eight, if a generator is given); the bins are changed."""
    order = np.array(sorted(items, key=lambda i: lengths[i]), dtype=np.int64)
    free = np.array([lengths[i] for i in order.tolist()], dtype=np.int64)
    while len(free):
        own, room = [], capacity
        some = [len(free) - 1 - (int(rng.integers(min(8, len(free)))) if rng is not None else 0)]
        while some:
            own += order[some].tolist()
            room -= int(free[some].sum())
            order, free = np.delete(order, some), np.delete(free, some)
            some = completing(free, room) if len(free) else []
        bins.append(own)
    return bins


def mutated(bins: Bins, lengths: list[int], capacity: int, rng: np.random.Generator) -> Bins:
    """Opens the emptiest bins and some others, up to half of all, and fills new bins with their items."""
    room = np.array([capacity - sum(lengths[i] for i in own) for own in bins])
    count = int(rng.integers(2, max(3, len(bins) // 2 + 1)))
    opened = {*np.argsort(-room, kind="stable")[: max(1, count // 2)].tolist(), *rng.choice(len(bins), size=min(len(bins), count // 2), replace=False).tolist()}
    items = [i for b in opened for i in bins[b]]
    return filled_by_subsets(items, lengths, [list(own) for b, own in enumerate(bins) if b not in opened], capacity, rng)


def evolved(lengths: list[int], population: list[Bins], capacity: int, seed: int) -> list[Bins]:
    """The population after an epoch, best first."""
    rng = np.random.default_rng(seed)
    least = -(-sum(lengths) // capacity)
    everything = list(range(len(lengths)))
    if not population:
        population = [best_fit(everything, lengths, [], capacity)]
    while len(population) < POPULATION and min(map(len, population)) > least:
        population.append(filled_by_subsets(everything, lengths, [], capacity, rng if len(population) > 1 else None))
    population.sort(key=lambda bins: fitness(bins, lengths))
    for _ in range(GENERATIONS):
        if len(population[0]) <= least:
            break
        one, other = rng.choice(len(population), size=2, replace=len(population) < 2)
        children = [
            crossover(population[one], population[other], lengths, capacity, rng),
            crossover(population[0], population[one], lengths, capacity, rng),
            mutated(population[0], lengths, capacity, rng),
        ]
        population = sorted([*population, *children], key=lambda bins: fitness(bins, lengths))[:POPULATION]
    return population


def as_places(bins: Bins, count: int) -> np.ndarray:
    places = np.empty(count, dtype=np.int32)
    for b, own in enumerate(bins):
        places[own] = b
    return places


def as_bins(places: np.ndarray) -> Bins:
    bins: Bins = [[] for _ in range(int(places.max()) + 1 if len(places) else 0)]
    for i, b in enumerate(places.tolist()):
        bins[b].append(i)
    return bins


STATE = "shard long, island int, uids array<long>, lengths array<int>, places array<array<int>>, bins int"


def epoch(state: DataFrame, capacity: int, number: int) -> DataFrame:
    """One epoch on every island of every shard; `places` holds a population, best first."""

    @lean
    def evolve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            places, bins = [], []
            for row in frame.itertuples():
                known = [as_bins(np.asarray(one)) for one in row.places]
                found = evolved([int(x) for x in row.lengths], known, capacity, hash((row.shard, row.island, number)) & 0xFFFFFFFF)
                places.append([as_places(one, len(row.lengths)) for one in found])
                bins.append(len(found[0]))
            yield frame.assign(places=places, bins=bins)

    return state.mapInPandas(evolve, STATE)


def migrated(state: DataFrame) -> DataFrame:
    """Every island also gets the best solution of the island before it."""
    guests = state.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("places")[0].alias("guest"))
    return state.join(guests, ["shard", "island"]).select(
        "shard", "island", "uids", "lengths", F.concat(F.array("guest"), "places").alias("places"), "bins"
    )


def packed_shards(items: DataFrame, count: int, capacity: int, level: int) -> DataFrame:
    """uid, length, sequence_id, filled for all items (uid, length), packed in about count / SHARD shards."""
    shards = max(1, -(-count // SHARD))
    dealt = items.groupBy(F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(shards)).alias("shard"))
    rows = dealt.agg(F.array_sort(F.collect_list(F.struct("uid", "length"))).alias("_items"))
    state = rows.select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.col("_items.uid").alias("uids"),
        F.col("_items.length").cast("array<int>").alias("lengths"),
        F.array().cast("array<array<int>>").alias("places"),
        F.lit(0).alias("bins"),
    )
    for number in range(EPOCHS):
        state = stored(epoch(state if number == 0 else migrated(state), capacity, number), "islands")
    best = state.groupBy("shard").agg(F.min_by(F.struct("uids", "lengths", F.col("places")[0].alias("best")), F.struct("bins", "island")).alias("s"))
    placed = best.select("shard", F.explode(F.arrays_zip("s.uids", "s.lengths", "s.best")).alias("i"))
    bins = placed.select("shard", F.col("i.uids").alias("uid"), F.col("i.lengths").alias("length"), F.col("i.best").alias("bin"))
    own = bins.groupBy("shard", "bin").agg(F.min("uid").alias("sequence_id"), F.sum("length").alias("filled"))
    return bins.join(own, ["shard", "bin"]).select("uid", "length", "sequence_id", "filled")


def packed(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """uid, sequence_id, offset for all items (uid, length <= capacity)."""
    full = items.filter(F.col("length") >= capacity).select("uid", "length", F.col("uid").alias("sequence_id"))
    rest = items.filter(F.col("length") < capacity)
    done, count, before, level = [full], rest.count(), None, 0
    is_open = F.col("filled") < capacity * 15 // 16
    one = (F.col("uid") == F.col("sequence_id")).cast("long")
    while True:
        found = stored(packed_shards(rest, count, capacity, level), "packed")
        sequences, pooled, opened = found.agg(F.sum(one), F.count_if(is_open), F.sum(F.when(is_open, one))).first()
        if before is not None and sequences > before[1]:
            done.append(before[0])
            break
        # of each shard's worth of tokens the emptiest bins go on: those with more room than the average shard leaves
        if pooled == 0 or count <= SHARD or (before is not None and sequences > (1 - GAIN) * before[1]):
            done.append(found.select("uid", "length", "sequence_id"))
            break
        done.append(found.filter(~is_open).select("uid", "length", "sequence_id"))
        again = found.filter(is_open).select("uid", "length", "sequence_id")
        rest, count, before, level = again.select("uid", "length"), pooled, (again, opened), level + 1
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    groups = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("uid", "length"))).alias("_items"))
    ends = F.aggregate(
        "_items",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<uid:bigint,offset:bigint>>").alias("out")),
        lambda state, item: F.struct(
            (state["at"] + item["length"]).alias("at"),
            F.concat(state["out"], F.array(F.struct(item["uid"].alias("uid"), state["at"].alias("offset")))).alias("out"),
        ),
    )
    return groups.select("sequence_id", F.explode(ends["out"]).alias("o")).select("o.uid", "sequence_id", "o.offset")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence and place there."""
    found = pieces(docs, path, capacity, with_ids).withColumn("uid", F.monotonically_increasing_id())
    found = stored(found, "pieces")
    places = packed(found.select("uid", "length"), capacity)
    return found.join(places, "uid").drop("uid")
