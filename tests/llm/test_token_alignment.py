"""Token alignment against a plain version that tokenises whole texts and compares all byte ranges."""

import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.llm import token_alignment
from gleanery.llm.token_alignment import Pool, loaded
from gleanery.llm.workload import BYTE_TOKENIZER, PIECE_TOKENIZER, QUERIES, tokenizer_path

PATHS = tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER)


def plain_tokens(text):
    """(id, bytes) of both tokenizers, None where their bytes are not the text's."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not plain_tokens.__dict__:
        plain_tokens.a = Tokenizer.from_file(PATHS[0])
        plain_tokens.a.encode_special_tokens = True
        plain_tokens.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    letters = token_alignment.byte_letters()
    one = plain_tokens.a.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(letters[c] for c in t)) for i, t in zip(one.ids, one.tokens, strict=True)]
    b = []
    for i in plain_tokens.b.encode(text):
        piece = plain_tokens.b.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") and len(piece) == 6 else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    good = all(b"".join(data for _, data in side) == whole for side in (a, b))
    return (a, b) if good and text else None


def spans(tokens):
    at, found = 0, []
    for number, data in tokens:
        found.append((number, at, at + len(data)))
        at += len(data)
    return found


def plain_alignment(text):
    found = plain_tokens(text) if text else None
    if found is None:
        return [], [], [], ""
    a, b = map(spans, found)
    links = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]]
    cuts = sorted({x[2] for x in a} & {y[2] for y in b})
    groups, begin = [], 0
    for cut in cuts:
        sides = [",".join(str(n) for n, s, e in side if begin <= s and e <= cut) for side in (a, b)]
        groups.append("|".join(sides))
        begin = cut
    return [n for n, _, _ in a], [n for n, _, _ in b], links, ";".join(groups)


def plain_digest(rows):
    found = [(doc_id, *plain_alignment(text)) for doc_id, text in rows]
    counts = Counter((a[i], b[j]) for _, a, b, links, _ in found for i, j in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    result = []
    for doc_id, a, b, links, groups in found:
        pairs = [(a[i], b[j]) for i, j in links]
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        best = sum(counts[p] == most[p[1]] for p in pairs)
        result.append((doc_id, len(a), len(b), groups.count(";") + 1 if groups else 0, len(links), best, sum(counts[p] for p in pairs), digest))
    return sorted(result, key=str)


TEXTS = [
    None, "", " ", "  ", "a", "a ", " a", "hello world", "Hello,  world!\n\nNext\tline \r\n", "\nnext", "<|endoftext|><s>x</s><unk>",
    "a ▁ b", "▁", "日本語のテキスト naïve café", "\U0001f469‍\U0001f680 ͸ \U0001ffff", "\x00\x01", "don't we'll 12345 ...", "x" * 3000,
    "word " * 6000, "hello world", "<0x41> A", "a b　c", "   indented\n      more", "\U00031350x", "é",
]


def test_digest_against_plain_version(spark):
    rows = [(i, text) for i, text in enumerate(TEXTS)] + [(None, "hello there"), (3, "a world")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    want = plain_digest(rows[:18] + rows[19:])
    few = docs.filter("text is null or length(text) < 20000")
    for heavy in (token_alignment.HEAVY, 20):
        assert sorted((tuple(r) for r in token_alignment.digest(few, *PATHS, heavy=heavy).collect()), key=str) == want


def test_whole_documents_against_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    links = {}
    for r in token_alignment.alignments(docs, *PATHS).collect():
        links[r.doc_id] = (r.a_ids, r.b_ids, [tuple(x) for x in r.links], [tuple(x) for x in r.cuts])
    ours = {r.doc_id: r for r in QUERIES["op13_token_alignment"](spark, sf_dir).collect()}
    assert len(ours) == len(rows)
    for doc_id, text in rows:
        a, b = map(spans, plain_tokens(text))
        found = links[doc_id]
        assert (found[0], found[1]) == ([n for n, _, _ in a], [n for n, _, _ in b])
        ends_a, ends_b = {e: i for i, (_, _, e) in enumerate(a)}, {e: i for i, (_, _, e) in enumerate(b)}
        assert found[3] == [(ends_a[e], ends_b[e]) for e in sorted(ends_a.keys() & ends_b.keys())]
        assert len(found[2]) == len(a) + len(b) - len(found[3]) == ours[doc_id].n_links
        assert all(a[i][1] < b[j][2] and b[j][1] < a[i][2] for i, j in found[2])
        assert len(set(found[2])) == len(found[2]) and found[2] == sorted(found[2])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab' \n\t\r12.,éß日 ▁̀\U0001f600<s>|'llre"), max_size=40), min_size=1, max_size=6))
def test_chunks_add_up_to_the_text(texts):
    found = loaded(*PATHS).encode([" " + t for t in texts])
    for i, text in enumerate(texts):
        want = plain_tokens(text) if text else None
        want = want or ([], [])
        for side, (ids, first) in enumerate(found):
            if text:
                assert ids[first[i] : first[i + 1]].tolist() == [n for n, _ in want[side]]


@pytest.mark.parametrize("lane", [16, 1 << 30])
def test_lanes_change_nothing(monkeypatch, lane):
    monkeypatch.setattr(token_alignment, "LANE", lane)
    texts = ["some words, and more words " * 40, None, "x", "日本語 " * 100]
    pool = Pool(texts, loaded(*PATHS))
    pool.align()
    pool.in_order()
    at = 0
    for text in texts:
        want = plain_alignment(text)[2] if text else []
        found = list(zip(pool.link_a[at : at + len(want)].tolist(), pool.link_b[at : at + len(want)].tolist(), strict=True))
        if want:
            assert [(i - found[0][0], j - found[0][1]) for i, j in found] == want
        at += len(want)
    assert at == len(pool.link_a)


def test_chunks_beyond_the_kept_ones(monkeypatch):
    monkeypatch.setattr(token_alignment, "CACHE_CHUNKS", 3)
    tokens = token_alignment.Tokens(*PATHS)
    for texts in (["one two three four", "five\tsix", "two"], ["four five", "", "one  two"], ["four", "six seven"]):
        found = tokens.encode([" " + t for t in texts])
        for side, (ids, first) in enumerate(found):
            for i, text in enumerate(texts):
                if text:
                    assert ids[first[i] : first[i + 1]].tolist() == [n for n, _ in plain_tokens(text)[side]]
    assert len(tokens.known) == 3 == len(tokens.kept[0][1])


def test_no_rows(spark):
    assert token_alignment.digest(spark.createDataFrame([], "doc_id long, text string, row string"), *PATHS).collect() == []


def test_a_repeated_row_counts_twice(spark):
    docs = spark.createDataFrame([(1, "ab"), (1, "ab")], "doc_id long, text string")
    one, other = token_alignment.digest(docs, *PATHS).collect()
    assert one == other and one.count_sum == 2 * one.n_links == 2 * one.n_best


def test_only_hot_pairs_are_broadcast(spark):
    pairs = spark.createDataFrame([(i, 1 << (i % 5)) for i in range(50)], "code int, n long")
    assert token_alignment.frequent_from(pairs, 50) == 1
    assert token_alignment.frequent_from(pairs, 20) == 8
    assert token_alignment.frequent_from(pairs.filter(F.col("n") == 16), 3) == 1 << 62
