"""What the operators' tasks leave in the worker they ran in."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gleanery.llm import minhash, packing, toxicity
from gleanery.llm.texts import ARROW_LIMIT
from gleanery.llm.workload import tokenizer_path


def test_tasks_give_their_memory_back(spark):
    """The workers hold little after packing and sketching texts of many different words."""
    words = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(399)), lambda i: F.hex(F.xxhash64("id", i))), " ")
    docs = spark.range(3200).repartition(8).select(F.col("id").alias("doc_id"), words.alias("text"))
    packing.pieces(docs, tokenizer_path()).agg(F.sum("length")).first()
    minhash.sketched(docs, 5).agg(F.sum("n")).first()

    def held(batches):
        for _ in batches:
            pass
        sizes = open("/proc/self/smaps_rollup").read()
        mb = sum(map(int, re.findall(r"\nAnonymous:\s+(\d+)", sizes))) // 1024
        yield pa.RecordBatch.from_pydict({"mb": [mb]}, schema=pa.schema([("mb", pa.int64())]))

    sizes = [row.mb for row in spark.range(8).repartition(8).mapInArrow(held, "mb long").collect()]
    assert max(sizes) < 290  # 195 to 197; 369 to 372 where tasks keep what their allocators hold


def test_a_worker_keeps_the_table_of_its_last_task_only(spark):
    """Nothing of packing's table of words is left in workers that sketched afterwards."""
    words = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(399)), lambda i: F.hex(F.xxhash64("id", i))), " ")
    docs = spark.range(3200).repartition(8).select(F.col("id").alias("doc_id"), words.alias("text"))

    def held(batches):
        for _ in batches:
            pass
        sizes = open("/proc/self/smaps_rollup").read()
        mb = sum(map(int, re.findall(r"\nAnonymous:\s+(\d+)", sizes))) // 1024
        yield pa.RecordBatch.from_pydict({"mb": [mb]}, schema=pa.schema([("mb", pa.int64())]))

    def largest():
        return max(row.mb for row in spark.range(8).repartition(8).mapInArrow(held, "mb long").collect())

    packing.pieces(docs, tokenizer_path()).agg(F.sum("length")).first()
    packed = largest()
    minhash.sketched(docs, 5).agg(F.sum("n")).first()
    assert largest() < packed - 15


def test_new_words_are_tokenised_in_calls_of_bounded_size():
    """However many words of a batch are new; their ids are those of the words one by one."""
    tokens = packing.Tokens(tokenizer_path())
    whole, sizes = tokens.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, add_special_tokens):
            sizes.append(sum(len(text.split()) for text in texts))
            return whole.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    tokens.tokenizer = Counting()
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}{'' if i % 3 else i}x" for i in range(50_000)]
    (found,) = tokens.encode(pa.array([" ".join(words)]))
    assert found == b"".join(np.array(one.ids, dtype="<u4").tobytes() for one in whole.encode_batch_fast(words, add_special_tokens=False))
    assert 0 < max(sizes) <= 16_384


def largest_batch(docs):
    """Bytes of the largest batch of texts that a worker gets at once."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]}, schema=pa.schema([("size", pa.int64())]))

    return docs.select("text").mapInArrow(sizes, "size long").agg(F.max("size")).first()[0]


def test_workers_get_few_megabytes_at_once(spark):
    """Packing, MinHash and toxicity each bound what a worker is sent, however much text a task reads; a limit of the session's own holds."""
    runs = {
        "packing": lambda docs: packing.pieces(docs, tokenizer_path()),
        "minhash": lambda docs: minhash.sketched(docs, 5),
        "toxicity": lambda docs: toxicity.scored(docs, toxicity.Chain({}, [])),
    }
    for name, run in runs.items():
        for own in (None, "9m"):
            session = spark.newSession()
            if own:
                session.conf.set(ARROW_LIMIT, own)
            docs = session.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 10_000).alias("text"))  # 20 MB
            run(docs)
            size = largest_batch(docs)
            assert 1 << 20 < size < 3 << 20 if own is None else 7 << 20 < size < 10 << 20, (name, own, size)


def test_words_beyond_those_kept_have_their_columns(monkeypatch):
    """The table of words stops growing, what it returns stays the same."""
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 3)
    known = toxicity.Columns({"abc*": 0, "abcd": 1, "hate": 2})
    words = ["abcd", "hate", "x", "abcx", "hate", "abcd", "abcx"]
    assert [known[word] for word in words] == [(1, 0), (2,), (), (0,), (2,), (1, 0), (0,)]
    assert list(known) == words[:3]
