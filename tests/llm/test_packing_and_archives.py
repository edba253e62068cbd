"""Packing, web archives and the pipeline: exact round trips and awkward rows."""

import hashlib
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from brute import AWKWARD_SCHEMA, awkward_documents, near_components, without_repeats, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanery.llm import packing, web_archives
from gleanery.llm.workload import tokenizer_path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402


def check_packing(rows):
    """Sequences without gaps, not longer than allowed; the number of sequences and its lower bound."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(by), -(-sum(r.length for r in rows) // packing.CAPACITY)


def test_pieces_hold_the_tokenizers_ids(spark):
    docs = spark.createDataFrame(awkward_documents(), AWKWARD_SCHEMA)
    texts = [
        "It's I'LL don't 3.14 x²½ ①",
        "ÀÉ é é ﬁ Straße İ",
        "<|endoftext|> a<|startoftext|>b",
        "  wide　blank \x1c\x1d 😀👍🏽",
        "tab\tline\nfeed\x0b\x0c\r",
        "a" * 5000,
    ]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(more)
    rows = packing.pack(docs, tokenizer_path(), with_ids=True).collect()
    plain = Tokenizer.from_file(tokenizer_path())
    wanted, found = [], []
    for r in docs.collect():
        ids = np.array([*plain.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            wanted.append((str(r.doc_id), piece, at, len(part), zlib.crc32(part.tobytes()), part.tolist()))
    for r in rows:
        found.append((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, list(r.ids)))
    assert sorted(found) == sorted(wanted)
    sequences, least = check_packing(rows)
    assert sequences <= least + 1
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0


def test_packing_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 256)
    rng = np.random.default_rng(2)
    lengths = [int(x) for x in rng.integers(1, 2049, 3000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    rows = packing.packed(items).join(items, "uid").collect()
    assert sorted(r.uid for r in rows) == list(range(3000))
    sequences, least = check_packing(rows)
    assert sequences <= 1.03 * least
    assert {tuple(r) for r in packing.packed(items).collect()} == {(r.uid, r.sequence_id, r.offset) for r in rows}


def test_genetic_operators_keep_all_items():
    rng = np.random.default_rng(4)
    lengths = [int(x) for x in rng.integers(200, 1400, 120)]
    population = packing.evolved(lengths, [], 2048, 1)
    for bins in (*population, packing.crossover(population[0], population[-1], lengths, 2048, rng), packing.mutated(population[0], lengths, 2048, rng)):
        assert sorted(i for own in bins for i in own) == list(range(120))
        assert all(sum(lengths[i] for i in own) <= 2048 for own in bins)
    again = packing.evolved(lengths, population, 2048, 2)
    assert packing.fitness(again[0], lengths) <= packing.fitness(population[0], lengths)


def test_genetic_algorithm_beats_best_fit():
    lengths = [int(x) for x in np.random.default_rng(6).integers(520, 821, 512)]
    least = -(-sum(lengths) // 2048)
    assert len(packing.best_fit(list(range(512)), lengths, [], 2048)) > 1.05 * least
    best = packing.evolved(lengths, [], 2048, 1)[0]
    assert sorted(i for own in best for i in own) == list(range(512))
    assert len(best) <= 1.03 * least


def test_leftovers_are_packed_again_until_nothing_is_gained(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 32)
    lengths = [int(x) for x in np.random.default_rng(7).integers(520, 821, 1500)]
    items = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    rows = packing.packed(items).join(items, "uid").collect()
    assert sorted(r.uid for r in rows) == list(range(1500))
    sequences, least = check_packing(rows)
    assert sequences <= 1.06 * least
    alike = spark.range(300).select(F.col("id").alias("uid"), F.lit(1100).cast("long").alias("length"))  # no two fit together
    assert packing.packed(alike).select("sequence_id").distinct().count() == 300
    assert packing.packed(alike.limit(0)).count() == 0


# --- archives


PAGES = "page_id long, url string, html string, digest string, size int"


def page_rows():
    big = "<p>" + "copy " * 40 + "é😀</p>"
    pages = [(i, f"http://a/{i}", f"page {i} " * (i * 30), "x", 1) for i in range(1, 40)]
    pages += [(50, "http://b", big, "x", 1), (45, "http://c\r\nX: y", big, None, 1), (60, None, big, "x", None), (60, None, big, "x", None)]
    pages += [(70, "u", "short", "x", 1), (71, "u", "short", "x", 1), (72, "u", None, "x", 1), (73, "u", "", "x", 1)]
    pages += [(None, "u", "no id " * 50, "x", 1), (None, "u", big, "x", 1), (80, "u", "z" * 3_000_000, "x", 1), (81, "u", "\r\n\r\n" * 60, "x", 1)]
    return pages


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(web_archives, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(web_archives, "CHUNKS_PER_ARCHIVE", 3)
    pages = spark.createDataFrame(page_rows(), PAGES)
    web_archives.write_archives(pages, f"{tmp_path}/warc")
    rows = web_archives.read_archives(spark, f"{tmp_path}/warc", payloads=True).collect()
    assert len(list(Path(tmp_path / "warc").glob("part-*"))) > 4
    assert all(r.verified for r in rows)
    least = {}
    for i, _, html, *_ in page_rows():
        if i is not None and html and len(html.encode()) >= 100:
            least[html] = min(i, least.get(html, i))
    wanted = []
    for i, url, html, *_ in page_rows():
        data = (html or "").encode()
        first = least.get(html) if html is not None and least.get(html) != i else None
        kind = "response" if first is None else "revisit"
        url = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
        wanted.append((str(i), len(data), hashlib.sha256(data).hexdigest(), kind, str(first), str(url), data if first is None else b"-"))
    found = [
        (str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to), str(r.url), b"-" if r.payload is None else bytes(r.payload))
        for r in rows
    ]
    assert sorted(found) == sorted(wanted)


def test_damaged_archives_are_noticed():
    members = [web_archives.record(i, "u", b"payload" * 100, hashlib.sha256(b"payload" * 100).hexdigest(), None) for i in range(3)]
    read = lambda data: [web_archives.read_record(*m) for m in web_archives.members_of(memoryview(data)) if m[0]]
    assert [r["verified"] for r in read(b"".join(members))] == [True] * 3
    assert [r["verified"] for r in read(b"".join(members)[:-40])] == [True, True, False]
    wrong = web_archives.record(1, "u", b"payload", hashlib.sha256(b"other").hexdigest(), None)
    assert [r["verified"] for r in read(wrong + members[0])] == [False, True]
    unpacked = zlib.decompress(members[0], 31)
    assert unpacked.startswith(b"WARC/1.1\r\n") and unpacked.endswith(b"\r\n\r\n")


def test_archives_of_an_empty_table(spark, tmp_path):
    web_archives.write_archives(spark.createDataFrame([], PAGES), f"{tmp_path}/none")
    assert web_archives.read_archives(spark, f"{tmp_path}/none").count() == 0


# --- pipeline


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage over the smallest tables."""
    folder, top = "/root/testdata/sf0.001", tmp_path_factory.mktemp("stages")
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    found.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
        found.append(docs)
    return found


def test_pipeline_stages_against_brute_force(spark, stages):
    start, clean, lines, single, mixed, packed = stages
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "minhash", "mixing", "packing"]
    assert all(s.columns == start.columns for s in stages[:5])
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    toxic = labels.filter("toxic = 1").count()  # a dozen labels teach the chain little
    assert clean.join(labels, "doc_id").filter("toxic = 1").count() <= toxic / 2
    assert clean.join(labels, "doc_id").filter("toxic = 0").count() == start.join(labels, "doc_id").filter("toxic = 0").count()
    texts = sorted((r.doc_id, r.text) for r in clean.collect())
    left = {i: t for (i, old), t in zip(texts, without_repeats(texts), strict=True) if t == old or words(t)}
    solid = lambda text: [x for x in text.split("\n") if words(x)]
    assert {r.doc_id: solid(r.text) for r in lines.collect()} == {i: solid(t) for i, t in left.items()}
    own = {r.doc_id: r.text for r in lines.collect()}
    components, _ = near_components(own, 5)
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, c in components.items() if i == c)
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in single.collect()}
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    pieces = {r.doc_id: r.n for r in packed.filter("piece = 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert pieces == counts
    sequences, least = check_packing(packed.collect())
    assert sequences <= least + 2


def test_pipeline_on_awkward_rows(spark, tmp_path):
    docs = spark.createDataFrame(awkward_documents(), AWKWARD_SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    for name, rows in (("some", docs), ("none", docs.limit(0))):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        result = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert bool(result) == (name == "some")
