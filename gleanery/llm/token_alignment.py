"""Align the tokens of two tokenizers over the same bytes, all documents of a batch in lockstep.

A is a byte-level BPE tokenizer and reads the text behind a space, B a piece tokenizer with byte fallback that puts the space itself. Tokens
that overlap in bytes are linked; offsets where tokens of both end are cuts, which part the tokens into groups.

One NumPy state vector holds a pointer into A and one into B for every document of a batch. Each step emits a link per document and a cut where
both tokens end, advances the pointer whose token ends first (both at a cut), and compacts documents that are done. A document of more than LANE
bytes enters the vector several times, from cuts about LANE bytes apart, so that one very long text does not keep the others' batch waiting.

How often ids are linked corpus-wide is counted from each document's distinct id pairs. The counts come back by a join: those of at most HEAVY
most frequent pairs by broadcast, which spares hot pairs the shuffle; the pairs below that count shuffle.

Tokenising: a text is the sum of its chunks (words with the spaces and line feeds before them), and each new chunk is tokenised once. Texts for which
that need not hold (other blanks than these, chunks that are not given back byte for byte) are tokenised whole.

Defined results: a text that is null, empty, or that a tokenizer does not give back byte for byte (U+2581 becomes a space in B) has no tokens: zeros
and an empty digest. Strings of special tokens are plain text. Repeated rows, rows without doc_id and rows that share one count each. An empty
table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.texts import stored

LANE = 4096
POOL_BYTES = 2 << 20
HEAVY = 500_000
CACHE_CHUNKS = 600_000
LONGEST_CHUNK = 64
TOGETHER = 256
BLANK = "▁"
#: A chunk is a run of spaces and line feeds with what follows. Byte-level tokenizers part a text before such a run; no piece joins a
#: line feed to anything, nor a space to what stands before it (checked when a model is loaded).
CHUNKS = re.compile(r"[ \n]+[^ \n]*").findall
OTHER_BLANK = re.compile(r"[^\S \n]").search


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + place): byte for place, byte in enumerate(others)}


class ByteTokens:
    """Tokenizer A, from a tokenizer file with byte-level letters."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes_of[number] = bytes(letters[c] for c in token) if set(token) <= letters.keys() else token.encode()
        self.joins_across = False

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [one.ids for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceTokens:
    """Tokenizer B, from a sentence piece model; texts begin with the space that the model adds, or with a line feed."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(BLANK, " ").encode() for i, piece in enumerate(pieces)
        ]
        self.blank = self.model.piece_to_id(BLANK)
        self.joins_across = any(re.search(f"[^{BLANK}]{BLANK}|\n", piece) for piece in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        encoded = self.model.encode([text.removeprefix(" ") for text in texts], num_threads=1)
        # the model adds no space to an empty text, and one too many to a line feed
        return [[self.blank] if text == " " else ids if text.startswith(" ") else ids[1:] for text, ids in zip(texts, encoded, strict=True)]


class Known(dict):
    """Numbers of chunks that stay, and those of the present pool beyond them."""

    def __init__(self) -> None:
        self.passing: dict[str, int] = {}

    def __missing__(self, chunk: str) -> int:
        return self.passing[chunk]


class Tokens:
    """Ids of both tokenizers for many texts at a time; each new chunk is tokenised once, and the first CACHE_CHUNKS chunks stay."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.sides = ByteTokens(path_a), PieceTokens(path_b)
        self.length = [np.array([len(one) for one in side.bytes_of], dtype=np.int64) for side in self.sides]
        self.whole_only = any(side.joins_across for side in self.sides)
        self.known = Known()
        #: per side the ids of all kept chunks one after the other, and how many ids each chunk has
        self.kept = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in self.sides]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For both sides the ids of all texts, and the first place of each text (and the end); a text without faithful tokens has none."""
        parts = [[text] if self.whole_only or OTHER_BLANK(text) else CHUNKS(text) for text in texts]
        tables = self.learn(set().union(*parts).difference(self.known), self.kept)
        numbers = [np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks)) for chunks in parts]
        again = [i for i, one in enumerate(numbers) if (one < 0).any()]
        tables = self.learn({texts[i] for i in again}.difference(self.known.passing), tables)
        for i in again:
            number = self.known[texts[i]]
            numbers[i] = np.full(min(1, number + 1), number, dtype=np.int64)
        ends = np.cumsum([0, *map(len, numbers)])
        every = np.concatenate(numbers) if numbers else np.zeros(0, dtype=np.int64)
        found = []
        for flat, counts in tables:
            begins = np.cumsum(counts) - counts
            times = counts[every]
            upto = np.append(0, np.cumsum(times))
            places = np.repeat(begins[every] - upto[:-1], times) + np.arange(upto[-1])
            found.append((flat[places], upto[ends]))
        self.known.passing = {}
        return found

    def learn(self, fresh: set[str], tables: list) -> list:
        """The tables with the fresh chunks behind them; as many as may stay are kept for good."""
        keeps = tables is self.kept
        room = CACHE_CHUNKS - len(self.known) if keeps else 0
        first = len(tables[0][1])
        good: list[str] = []
        rows = [([flat], [counts]) for flat, counts in tables]
        for chunks, parts in self.tokenised(sorted(fresh, key=len)):  # the shortest first: they stay, being the likeliest to come again
            if parts is None:
                self.known.passing[chunks[0]] = -1
                continue
            good += chunks
            for (flat, counts), (ids, sizes) in zip(rows, parts, strict=True):
                flat.append(ids)
                counts.append(sizes)
        grown = [(np.concatenate(flat), np.concatenate(counts)) for flat, counts in rows]
        staying = bisect.bisect_right(good, LONGEST_CHUNK, hi=max(0, min(room, len(good))), key=len)
        self.known.update(zip(good[:staying], range(first, first + staying), strict=True))
        self.known.passing.update(zip(good[staying:], range(first + staying, first + len(good)), strict=True))
        if keeps:
            last = first + staying
            self.kept = [(flat[: counts[:last].sum()], counts[:last]) for flat, counts in grown]
        return grown

    def tokenised(self, chunks: list[str]) -> Iterator[tuple[list[str], list[tuple[np.ndarray, np.ndarray]] | None]]:
        """Groups of chunks, joined to one text, with their ids and how many belong to each chunk, by side; shortest chunks first.

        A chunk that a side does not give back byte for byte comes alone, without ids.
        """
        groups = [chunks[at : at + TOGETHER] for at in range(0, len(chunks), TOGETHER)]
        groups = [part for group in groups for part in ([[one] for one in group] if OTHER_BLANK("".join(group)) else [group])]
        encoded = [side.encode(["".join(group) for group in groups]) for side in self.sides]
        for group, *both in zip(groups, *encoded, strict=True):
            ends = np.cumsum([len(chunk.encode()) for chunk in group])
            data = "".join(group).encode()
            parts = [self.parted(side, ids, ends, data) for side, ids in enumerate(both)]
            if None not in parts:
                yield group, parts
            elif len(group) == 1:
                yield group, None
            else:
                for chunk in group:
                    yield from self.tokenised([chunk])

    def parted(self, side: int, ids: list[int], ends: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids, and how many lie before each of the byte offsets; None unless tokens end there and give the bytes back."""
        if b"".join(map(self.sides[side].bytes_of.__getitem__, ids)) != data:
            return None
        found = np.array(ids, dtype=np.int64)
        upto = np.cumsum(self.length[side][found])
        at = np.searchsorted(upto, ends)
        return (found, np.diff(at + 1, prepend=0)) if (upto[at] == ends).all() else None


_LOADED: dict[tuple[str, str], Tokens] = {}


def loaded(path_a: str, path_b: str) -> Tokens:
    """One table of chunks per Python worker, which Spark uses for many tasks."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Tokens(path_a, path_b)
    return _LOADED[path_a, path_b]


def widths(path_a: str, path_b: str) -> list[int]:
    """How many ids each side has."""
    return [len(side.bytes_of) for side in loaded(path_a, path_b).sides]


class Pool:
    """Tokens of some documents, one after the other; `ends` are byte offsets in the concatenation of their texts."""

    def __init__(self, texts: list[str | None], tokens: Tokens) -> None:
        self.count = len(texts)
        usable = [i for i, text in enumerate(texts) if text and BLANK not in text]
        found = tokens.encode([" " + texts[i] for i in usable])
        (self.ids_a, self.first_a), (self.ids_b, self.first_b) = ((ids, self.spread(first, usable)) for ids, first in found)
        self.ends_a, self.ends_b = (np.cumsum(length[ids]) for length, (ids, _) in zip(tokens.length, found, strict=True))

    def spread(self, first: np.ndarray, usable: list[int]) -> np.ndarray:
        """First places of all documents from those of the usable ones."""
        sizes = np.zeros(self.count + 1, dtype=np.int64)
        sizes[np.array(usable, dtype=np.int64) + 1] = np.diff(first)
        return np.cumsum(sizes)

    def lanes(self) -> tuple[np.ndarray, np.ndarray]:
        """Pointers to start from: every document's first tokens, and the tokens behind a cut about every LANE bytes of a long one."""
        starts = np.flatnonzero(np.diff(self.first_a))
        a, b = self.first_a[starts].tolist(), self.first_b[starts].tolist()
        last = self.ends_a[self.first_a[starts + 1] - 1] if len(starts) else []
        begin = 0
        for end in list(map(int, last)):
            for target in range(begin + LANE, end - LANE, LANE):
                i, j = np.searchsorted(self.ends_a, target), np.searchsorted(self.ends_b, target)
                _, x, y = np.intersect1d(self.ends_a[i : i + 64], self.ends_b[j : j + 64], assume_unique=True, return_indices=True)
                if len(x) and self.ends_a[i + x[0]] < end:
                    a.append(int(i + x[0]) + 1)
                    b.append(int(j + y[0]) + 1)
            begin = end
        order = np.unique(np.array(a, dtype=np.int64), return_index=True)[1]
        return np.array(a, dtype=np.int64)[order], np.array(b, dtype=np.int64)[order]

    def align(self) -> None:
        """link_a, link_b: token places of every link; cut_a, cut_b: marks of the tokens that end at a cut."""
        a, b = self.lanes()
        stop = np.append(a[1:], len(self.ids_a))
        self.cut_a, self.cut_b = np.zeros(len(self.ids_a), dtype=bool), np.zeros(len(self.ids_b), dtype=bool)
        links_a, links_b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        while len(a):
            links_a.append(a)
            links_b.append(b)
            end_a, end_b = self.ends_a[a], self.ends_b[b]
            here = end_a == end_b
            self.cut_a[a[here]] = True
            self.cut_b[b[here]] = True
            a = a + (end_a <= end_b)
            b = b + (end_b <= end_a)
            going = a < stop
            if not going.all():
                a, b, stop = a[going], b[going], stop[going]
        self.link_a, self.link_b = np.concatenate(links_a), np.concatenate(links_b)

    def in_order(self) -> None:
        """Links as they stand in the texts."""
        order = np.argsort(self.link_a + self.link_b, kind="stable")
        self.link_a, self.link_b = self.link_a[order], self.link_b[order]

    def documents(self) -> np.ndarray:
        """The document of every A token."""
        return np.repeat(np.arange(self.count), np.diff(self.first_a))

    def group_texts(self, letters: np.ndarray, width_a: int, width_b: int) -> list[bytes]:
        """For every document its groups: A ids, a bar, B ids; groups parted by semicolons."""
        group_a, group_b = (np.cumsum(cut) - cut for cut in (self.cut_a, self.cut_b))
        groups = int(self.cut_a.sum())
        upto_a = np.cumsum(np.bincount(group_a, minlength=groups))
        upto_b = np.cumsum(np.bincount(group_b, minlength=groups))
        merged = np.empty(len(group_a) + len(group_b), dtype=np.int64)
        merged[np.arange(len(group_a)) + np.append(0, upto_b)[group_a]] = self.ids_a + width_a * self.cut_a
        merged[np.arange(len(group_b)) + np.append(upto_a, 0)[group_b]] = 2 * width_a + self.ids_b + width_b * self.cut_b
        written = letters[merged].tobytes()  # padded with zero bytes
        bounds = ((self.first_a + self.first_b) * letters.itemsize).tolist()
        return [written[begin:end].translate(None, b"\0")[:-1] for begin, end in zip(bounds, bounds[1:], strict=False)]


def id_letters(width_a: int, width_b: int) -> np.ndarray:
    """The written form of every id with what follows it: A inside and at the end of a group, then B likewise."""
    marked = ((width_a, b","), (width_a, b"|"), (width_b, b","), (width_b, b";"))
    return np.array([str(number).encode() + mark for width, mark in marked for number in range(width)])


def pools(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[tuple[pa.RecordBatch, Pool]]:
    """Slices of about POOL_BYTES of text with their aligned tokens."""
    tokens = loaded(path_a, path_b)
    for batch in batches:
        begin, size, texts = 0, 0, []
        for at, value in enumerate(batch.column("text")):
            text = value.as_py()
            texts.append(text)
            size += len(text) if text else 0
            if size >= POOL_BYTES or at + 1 == batch.num_rows:
                pool = Pool(texts, tokens)
                pool.align()
                yield batch.slice(begin, len(texts)), pool
                begin, size, texts = at + 1, 0, []


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, a_ids, b_ids, links (places of linked tokens) and cuts (places of the tokens that end at a cut) of every row."""
    pair = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    ids = pa.list_(pa.int32())
    layout = pa.schema([("doc_id", pa.int64()), ("a_ids", ids), ("b_ids", ids), ("links", pair), ("cuts", pair)])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, pool in pools(batches, path_a, path_b):
            pool.in_order()
            of = pool.documents()
            cut_a, cut_b = np.flatnonzero(pool.cut_a), np.flatnonzero(pool.cut_b)

            def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))

            def pairs(a: np.ndarray, b: np.ndarray) -> pa.Array:
                bounds = np.searchsorted(of[a], np.arange(pool.count + 1))
                local = [pa.array(x - first[of[a]], pa.int32()) for x, first in ((a, pool.first_a), (b, pool.first_b))]
                return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(local, ["a", "b"]))

            columns = [lists(pool.ids_a, pool.first_a), lists(pool.ids_b, pool.first_b), pairs(pool.link_a, pool.link_b), pairs(cut_a, cut_b)]
            yield pa.record_batch([rows.column("doc_id"), *columns], schema=layout)

    span = "array<struct<a:int,b:int>>"
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return named.mapInArrow(align, f"doc_id long, a_ids array<int>, b_ids array<int>, links {span}, cuts {span}")


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of `docs`: row (a number of its own), doc_id, counts, digest of the groups, and the distinct linked id pairs
    (code: A id times the width of B, plus B id) with how many links of the document hold them."""
    width_a, width_b = widths(path_a, path_b)
    code, code_type = ("int", pa.int32()) if width_a * width_b < 1 << 31 else ("long", pa.int64())
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    layout = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), *[(name, pa.int64()) for name in counts], ("groups_sha256", pa.string()),
         ("codes", pa.list_(code_type)), ("times", pa.list_(pa.int32()))]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, letters = TaskContext.get().partitionId() << 33, id_letters(width_a, width_b)
        for rows, pool in pools(batches, path_a, path_b):
            of = pool.documents()
            groups = np.bincount(of[pool.cut_a], minlength=pool.count)
            of_link = of[pool.link_a]
            links = np.bincount(of_link, minlength=pool.count)
            keys = of_link * (width_a * width_b) + pool.ids_a[pool.link_a] * width_b + pool.ids_b[pool.link_b]
            keys, times = np.unique(keys, return_counts=True)
            owner, codes = np.divmod(keys, width_a * width_b)
            bounds = pa.array(np.searchsorted(owner, np.arange(pool.count + 1)), pa.int32())
            digests = [hashlib.sha256(text).hexdigest() if text else "" for text in pool.group_texts(letters, width_a, width_b)]
            columns = [
                pa.array(np.arange(row, row + pool.count)), rows.column("doc_id"), pa.array(np.diff(pool.first_a)),
                pa.array(np.diff(pool.first_b)), pa.array(groups), pa.array(links), pa.array(digests),
                pa.ListArray.from_arrays(bounds, pa.array(codes, code_type)),
                pa.ListArray.from_arrays(bounds, pa.array(times, pa.int32())),
            ]
            row += pool.count
            yield pa.record_batch(columns, schema=layout)

    schema = f"row long, doc_id long, {', '.join(f'{name} long' for name in counts)}, groups_sha256 string, codes array<{code}>, times array<int>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(digest, schema)


def pair_counts(links: DataFrame, width_b: int) -> DataFrame:
    """code, n (links corpus-wide) and best (no other A id is linked more often with the B id) of every id pair."""
    counts = links.groupBy("code").agg(F.sum("times").alias("n")).withColumn("b", F.col("code") % width_b)
    counts = stored(counts, "pairs")
    highest = counts.groupBy("b").agg(F.max("n").alias("most"))  # at most a row for each id of B
    return counts.join(F.broadcast(highest), "b").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent_from(pairs: DataFrame, heavy: int) -> int:
    """The least power of two that at most `heavy` pairs reach; 1 if these are all."""
    sizes = pairs.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count(F.lit(1)).alias("pairs")).collect()  # 64 rows at most
    least, total = 62, 0
    for power, count in sorted(((r.power, r.pairs) for r in sizes), reverse=True):
        total += count
        if total > heavy:
            return 1 << least
        least = power
    return 1


def digest(docs: DataFrame, path_a: str, path_b: str, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of `docs` (doc_id, text)."""
    rows = stored(aligned(docs, path_a, path_b), "alignments")
    links = rows.select("row", F.explode(F.arrays_zip("codes", "times")).alias("pair")).select(
        "row", F.col("pair.codes").alias("code"), F.col("pair.times").alias("times")
    )
    pairs = stored(pair_counts(links, widths(path_a, path_b)[1]), "counts")
    least = frequent_from(pairs, heavy)
    frequent = F.broadcast(pairs.filter(F.col("n") >= least))
    known = links.join(frequent, "code")
    if least > 1:
        rare = links.join(frequent.select("code"), "code", "left_anti").join(pairs.filter(F.col("n") < least).hint("merge"), "code")
        known = known.unionByName(rare)
    totals = known.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times").cast("long")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    zero = F.lit(0).cast("long")
    return rows.drop("codes", "times").join(totals, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
