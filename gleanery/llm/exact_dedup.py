"""Exact duplicates by owners that are Patricia tries.

Texts are equal when they are identical once every run of ASCII blanks is one space. 1. Every task inserts the whole texts of its own rows
into a compressed radix trie of byte strings, whose terminal nodes keep the smallest identifier and the number of rows, so a group of
copies of any size leaves a task as one class. 2. The classes go to owners, partitioned by length and content hash; an owner inserts the
classes' full byte strings into a trie of its own, so equality rests on the bytes and never on the hash. 3. Rows learn their owner by class.

Memory is bounded by bytes, not rows. A trie that holds more than TRIE_BYTES spills its heaviest subtree. On the row side the subtree's
terminals leave as finished classes and the subtree begins anew. An owner leaves a mark at the subtree's root: the terminals, and all later strings that
come to the mark, are written for the next round, so equal strings are decided in the same round. The branch node above a
spilled subtree keeps another branch, so every round decides something. Owners are as many as the bytes need.

Defined results: a null text is empty, empty texts are equal. Rows that share a doc_id and a text stay or go together. Rows without doc_id
never own a group that has another row; a group without any doc_id has a null keep_id and all its rows stay. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.texts import stored

TRIE_BYTES = 48 << 20
OWNER_BYTES = 16 << 20
#: What a node takes besides its label.
NODE_BYTES = 400
#: Runs of blanks that are anything but one space.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*+|\x20[\x20\x09-\x0D]++"
BATCH_BYTES = 8 << 20

_CLASSES = "size long, hash long, text binary, least long, rows long, classes array<long>"
_CLASS_LAYOUT = pa.schema(
    [
        ("size", pa.int64()), ("hash", pa.int64()), ("text", pa.binary()), ("least", pa.int64()), ("rows", pa.int64()),
        ("classes", pa.list_(pa.int64())),
    ]
)


class Terminal:
    """A whole string's entry: its smallest identifier (None if none is known), its rows, its classes."""

    __slots__ = ("size", "hash", "least", "rows", "classes")

    def __init__(self, size: int, content: int) -> None:
        self.size, self.hash = size, content
        self.least: int | None = None
        self.rows = 0
        self.classes: list[int] = []

    def add(self, least: int | None, rows: int) -> None:
        self.rows += rows
        if least is not None and (self.least is None or least < self.least):
            self.least = least


class Node:
    """A label and what follows it; `spilled` marks the root of a subtree that left."""

    __slots__ = ("label", "children", "terminal", "spilled")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.children: dict[int, Node] = {}
        self.terminal: Terminal | None = None
        self.spilled = False


def common(one: bytes, other: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(one), len(other))
    while low < high:
        middle = (low + high + 1) // 2
        if one[low:middle] == other[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed radix trie of byte strings."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.bytes = 0

    def terminal(self, text: bytes, size: int, content: int) -> Terminal | None:
        """The entry of a string, made if it is new; None where the string belongs to a subtree that was spilled."""
        node, at = self.root, 0
        while True:
            if node.spilled:
                return None
            if at == len(text):
                break
            child = node.children.get(text[at])
            if child is None:
                child = Node(text[at:])
                node.children[text[at]] = child
                self.bytes += len(child.label) + NODE_BYTES
                node = child
                break
            if text.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            shared = common(child.label, text[at : at + len(child.label)])
            upper = Node(child.label[:shared])
            child.label = child.label[shared:]
            upper.children[child.label[0]] = child
            node.children[text[at]] = upper
            self.bytes += NODE_BYTES
            node, at = upper, at + shared
        if node.terminal is None:
            node.terminal = Terminal(size, content)
            self.bytes += NODE_BYTES
        return node.terminal

    def spill(self, mark: bool) -> list[tuple[bytes, Terminal]]:
        """Take out the heaviest open subtree below the first node where open ways part; with `mark` its root stays as a closed door."""
        node, path = self.root, []
        while True:
            ways = {key: child for key, child in node.children.items() if not child.spilled}
            if len(ways) != 1 or node.terminal is not None:
                break
            (node,) = ways.values()
            path.append(node.label)
        if not ways:  # one string alone, however long
            return []
        weights = {key: self.weight(child) for key, child in ways.items()}
        key = max(weights, key=weights.get)
        child = node.children.pop(key)
        self.bytes -= weights[key]
        if mark:
            door = Node(child.label)
            door.spilled = True
            node.children[key] = door
            self.bytes += len(door.label) + NODE_BYTES
        return list(self.entries(child, b"".join(path)))

    @staticmethod
    def weight(node: Node) -> int:
        total, todo = 0, [node]
        while todo:
            one = todo.pop()
            total += len(one.label) + NODE_BYTES * (2 if one.terminal else 1)
            todo += one.children.values()
        return total

    @staticmethod
    def entries(node: Node, prefix: bytes = b"") -> Iterator[tuple[bytes, Terminal]]:
        todo = [(node, prefix)]
        while todo:
            one, before = todo.pop()
            whole = before + one.label
            if one.terminal is not None:
                yield whole, one.terminal
            todo += [(child, whole) for child in one.children.values()]


def _class_batches(entries: Iterator[tuple[bytes, Terminal]]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for text, one in entries:
        held.append({"size": one.size, "hash": one.hash, "text": text, "least": one.least, "rows": one.rows, "classes": one.classes})
        size += len(text) + NODE_BYTES
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=_CLASS_LAYOUT)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_CLASS_LAYOUT)


def normalised(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, size, hash and the text's bytes after blanks were evened out."""
    even = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), RUNS, " ").alias("text")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), even)
    return texts.select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"), F.octet_length("text").cast("long").alias("size"),
        F.xxhash64("text").alias("hash"), F.encode("text", "UTF-8").alias("text"),
    )


def local_classes(texts: DataFrame, limit: int = TRIE_BYTES) -> DataFrame:
    """Rows of two kinds: every document with the class it fell into (kind 0), every class of a task with its text (kind 1)."""
    layout = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("text_sha256", pa.string()), ("class", pa.int64()), *_CLASS_LAYOUT])
    names = _CLASS_LAYOUT.names

    def classes_of(entries: list[tuple[bytes, Terminal]]) -> Iterator[pa.RecordBatch]:
        for batch in _class_batches(iter(entries)):
            empty = [pa.nulls(batch.num_rows, layout.field(name).type) for name in ("doc_id", "text_sha256", "class")]
            kind = pa.array([1] * batch.num_rows, pa.int32())
            yield pa.record_batch([kind, *empty, *[batch.column(name) for name in names]], schema=layout)

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, number = Trie(), TaskContext.get().partitionId() << 33
        for batch in batches:
            found = []
            ids, sizes, hashes = (batch.column(name).to_pylist() for name in ("doc_id", "size", "hash"))
            for doc_id, size, content, text in zip(ids, sizes, hashes, batch.column("text"), strict=True):
                one = trie.terminal(text.as_py(), size, content)
                if not one.classes:
                    one.classes.append(number)
                    number += 1
                one.add(doc_id, 1)
                found.append(one.classes[0])
                while trie.bytes > limit and (gone := trie.spill(mark=False)):
                    yield from classes_of(gone)
            rest = [pa.nulls(batch.num_rows, layout.field(name).type) for name in names]
            kind = pa.array([0] * batch.num_rows, pa.int32())
            columns = [kind, batch.column("doc_id"), batch.column("text_sha256"), pa.array(found, pa.int64()), *rest]
            yield pa.record_batch(columns, schema=layout)
        yield from classes_of(list(Trie.entries(trie.root)))

    schema = f"kind int, doc_id long, text_sha256 string, class long, {_CLASSES}"
    return texts.mapInArrow(insert, schema)


def owned(classes: DataFrame, owners: int, limit: int = TRIE_BYTES) -> DataFrame:
    """One round of owners over classes: `owner` rows (class, least, rows), and the terminals that were spilled (text not null)."""
    fields = [("class", pa.int64()), ("owner_least", pa.int64()), ("owner_rows", pa.int64()), *_CLASS_LAYOUT]
    layout = pa.schema(fields)
    names = _CLASS_LAYOUT.names

    def spilled(entries: Iterator[tuple[bytes, Terminal]]) -> Iterator[pa.RecordBatch]:
        for batch in _class_batches(entries):
            empty = [pa.nulls(batch.num_rows, pa.int64())] * 3
            yield pa.record_batch([*empty, *[batch.column(name) for name in names]], schema=layout)

    def decided(entries: Iterator[tuple[bytes, Terminal]]) -> Iterator[pa.RecordBatch]:
        ids, least, rows = [], [], []
        for _, one in entries:
            ids += one.classes
            least += [one.least] * len(one.classes)
            rows += [one.rows] * len(one.classes)
        rest = [pa.nulls(len(ids), layout.field(name).type) for name in names]
        columns = [pa.array(ids, pa.int64()), pa.array(least, pa.int64()), pa.array(rows, pa.int64()), *rest]
        yield pa.record_batch(columns, schema=layout)

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("size", "hash", "least", "rows", "classes")]
            late = []
            for size, content, least, rows, ids, text in zip(*columns, batch.column("text"), strict=True):
                value = text.as_py()
                one = trie.terminal(value, size, content)
                if one is None:  # behind a closed door
                    one = Terminal(size, content)
                    late.append((value, one))
                one.add(least, rows)
                one.classes += ids
                while trie.bytes > limit and (gone := trie.spill(mark=True)):
                    yield from spilled(iter(gone))
            yield from spilled(iter(late))
        yield from decided(Trie.entries(trie.root))

    schema = f"class long, owner_least long, owner_rows long, {_CLASSES}"
    return classes.repartition(owners, "size", "hash").mapInArrow(insert, schema)


def duplicates(docs: DataFrame, limit: int = TRIE_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of `docs` (doc_id, text)."""
    spark = docs.sparkSession
    least_owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = stored(local_classes(normalised(docs), limit), "classes")
    classes = both.filter("kind = 1").select(*_CLASS_LAYOUT.names)
    owners: DataFrame | None = None
    while True:
        total = classes.agg(F.sum(F.col("size") + NODE_BYTES)).first()[0] or 0
        number = max(least_owners, -(-total // OWNER_BYTES))
        # a split of more bytes than an owner should hold comes from hot hashes only, which the next round splits again
        result = stored(owned(classes, int(number), limit), "owners")
        found = result.filter(F.col("class").isNotNull()).select("class", "owner_least", "owner_rows")
        owners = found if owners is None else owners.unionByName(found)
        classes = result.filter(F.col("class").isNull()).select(*_CLASS_LAYOUT.names)
        if classes.isEmpty():
            break
    rows = both.filter("kind = 0").select("doc_id", "text_sha256", "class").join(owners, "class")
    keep = F.col("owner_least")
    return rows.select(
        "doc_id", keep.alias("keep_id"), F.col("owner_rows").alias("group_size"),
        (keep.isNull() | F.coalesce(F.col("doc_id") == keep, F.lit(False))).alias("kept"), "text_sha256",
    )


def one_of_each(docs: DataFrame, limit: int = TRIE_BYTES) -> DataFrame:
    """The first row of every group of equal texts by doc_id; columns unchanged."""
    marks = duplicates(docs, limit).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone"), "text_sha256")
    even = F.regexp_replace(F.coalesce(F.col("doc.text"), F.lit("")), RUNS, " ")
    wrapped = docs.select(F.struct("*").alias("doc"))  # no name can clash
    keyed = wrapped.withColumns({"_gone": F.col("doc.doc_id").cast("long"), "text_sha256": F.sha2(even, 256)})
    same = keyed["_gone"].eqNullSafe(marks["_gone"]) & (keyed["text_sha256"] == marks["text_sha256"])
    return keyed.join(marks, same, "left_anti").select("doc.*")
