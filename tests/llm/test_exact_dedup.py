"""Exact dedup against a plain dictionary of texts."""

import hashlib
import random
import re

import pytest

from gleanery.llm import exact_dedup
from gleanery.llm.exact_dedup import Trie


def plain(rows):
    groups = {}
    for doc_id, text in rows:
        even = re.sub("[\x20\x09-\x0d]+", " ", text or "")
        groups.setdefault(even, []).append(doc_id)
    found = []
    for even, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        digest = hashlib.sha256(even.encode()).hexdigest()
        found += [(i, keep, len(ids), keep is None or i == keep, digest) for i in ids]
    return sorted(found, key=str)


def made(count, seed=7):
    """Texts that are prefixes and extensions of each other, copies and blank variants of copies."""
    draw = random.Random(seed)
    heads = ["", " ", "a", "ab", "ab c", "é", "ab\n\tc", "ab  c", None, "ab c" * 2000, "ab c" * 2000 + "!", "日本 語"]
    rows = [(i, draw.choice(heads)) for i in range(count // 2)]
    rows += [(i, "ab" * draw.randint(0, 12) + draw.choice(["", " x", "\tx", "y"])) for i in range(count // 2, count)]
    return rows + [(None, "ab"), (None, "only without id"), (None, "only without id"), (3, "second text of an id"), (3, "ab")]


@pytest.mark.parametrize("limit", [exact_dedup.TRIE_BYTES, 6_000])
def test_groups_as_a_dictionary_finds_them(spark, limit):
    rows = made(600)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted((tuple(r) for r in exact_dedup.duplicates(docs, limit).collect()), key=str) == plain(rows)


def test_no_rows_and_clashing_columns(spark):
    assert exact_dedup.duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = spark.createDataFrame(
        [(2, "x y", 1, "a"), (1, "x  y", 2, "b"), (None, "x\ny", 3, "c"), (None, "z", 4, "d")], "doc_id int, text string, class int, _gone string"
    )
    left = exact_dedup.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(r["_gone"] for r in left.collect()) == ["b", "d"]


def test_equality_rests_on_bytes_not_on_the_hash(spark):
    rows = [(1, 3, 9, b"abc", 5, 1, [1]), (2, 3, 9, b"abd", 6, 1, [2]), (3, 3, 9, b"abc", 4, 2, [3])]
    classes = spark.createDataFrame([r[1:] for r in rows], exact_dedup._CLASSES)
    found = {r["class"]: (r.owner_least, r.owner_rows) for r in exact_dedup.owned(classes, 3).collect()}
    assert found == {1: (4, 3), 2: (6, 1), 3: (4, 3)}


def test_spilled_subtrees_keep_every_string():
    draw = random.Random(3)
    trie, gone, closed = Trie(), [], 0
    texts = ["".join(draw.choice("ab") for _ in range(draw.randint(0, 9))).encode() for _ in range(800)]
    for i, text in enumerate(texts):
        one = trie.terminal(text, len(text), 0)
        if one is None:
            closed += 1
            continue
        one.add(i, 1)
        while trie.bytes > 9_000 and (more := trie.spill(mark=True)):
            gone += more
    rest = list(Trie.entries(trie.root))
    assert gone and rest and closed
    assert sum(one.rows for _, one in gone + rest) + closed == len(texts)
    for text, one in gone + rest:
        assert one.least == texts.index(text)
    assert not {text for text, _ in gone} & {text for text, _ in rest}
