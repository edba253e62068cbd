"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from gleanery.llm import collocations
from gleanery.llm.oracles import OP11


def plain(rows, least, top):
    counts = {}
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\f\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            for size in range(1, 6):
                for at in range(len(words) - size + 1):
                    counts.setdefault(lang or "und", Counter())[tuple(words[at : at + size])] += 1
    result = []
    for lang, found in counts.items():
        n = sum(f for words, f in found.items() if len(words) == 1)
        candidates = {words: f for words, f in found.items() if len(words) > 1 and f >= least}
        scored = []
        for words, a in candidates.items():
            inside = [
                o for o, f in candidates.items()
                if len(o) > len(words) and f >= a and any(o[i : i + len(words)] == words for i in range(len(o)))
            ]
            if inside:
                continue
            cuts = [(1000 * a * n // (found[words[:k]] * found[words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(words).encode(), found[words[:k]], found[words[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(result)


def made(count, seed=5):
    draw = random.Random(seed)
    words = ["a", "B", "the", "of", "é", "x-y", "日本", "Z", "q", "A"]
    stops = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!", "\r"]
    rows = []
    for _ in range(count):
        text = "".join(draw.choice(words[: draw.randint(2, 10)]) + draw.choice(stops) for _ in range(draw.randint(0, 30)))
        rows.append((draw.choice(["en", "de", None, "und"]), draw.choice([text, text, text, None, "the of a B " * 9, ""])))
    return rows


@pytest.mark.parametrize("setting", ["plain", "small buckets", "no known codes", "small flushes"])
def test_against_a_plain_count(spark, monkeypatch, setting):
    if setting == "small buckets":
        monkeypatch.setattr(collocations, "BUCKET_ROWS", 12)
        monkeypatch.setattr(collocations, "FANOUT", 3)
    if setting == "no known codes":
        monkeypatch.setattr(collocations, "KNOWN_CODES", 0)
    rows = made(160)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    for least, top in ((3, 15),) if setting != "plain" else ((2, 50), (9, 1000)):
        found = collocations.collocations(docs, least, top).collect()
        assert sorted(tuple(r) for r in found) == plain(rows, least, top)


def test_whole_documents_against_the_counterpart(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = connection.sql(OP11)
    found = collocations.collocations(docs)
    assert sorted(tuple(r) for r in found.select(*want.columns).collect()) == sorted(want.fetchall())
    assert found.count() > 0


def test_empty_tables_and_texts(spark):
    empty = spark.createDataFrame([], "lang string, text string, code long, n int")
    assert collocations.collocations(empty).collect() == []
    blank = spark.createDataFrame([(None, None), ("en", ""), ("en", " .,!\n")], "lang string, text string")
    assert collocations.collocations(blank, 1).collect() == []


def test_words_of_one_code_are_told_apart(spark, monkeypatch):
    real = collocations.coded
    monkeypatch.setattr(collocations, "coded", lambda lang, word, salt: F.lit(7).cast("long") if salt == "" else real(lang, word, salt))
    words, salt = collocations.vocabulary(spark.createDataFrame([("en", "a b"), ("de", "a")], "lang string, text string"))
    assert salt == "1:" and words.select("code").distinct().count() == 3


def test_scores_beyond_64_bits(spark):
    rows = spark.createDataFrame([(10**13, 10**14, 10**13, 10**13)], "a long, n long, l long, r long")
    score = F.expr("(cast(1000 as decimal(38, 0)) * a * n) div (cast(l as decimal(38, 0)) * r)")
    assert rows.select(score).first()[0] == 10**4
