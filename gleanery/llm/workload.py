"""Registered queries of the training-data operators and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import collision_search, collocations, exact_dedup, line_dedup, minhash, mixing, packing, personal_data, pq_dedup, secret_scan, token_alignment, toxicity, web_archives
from gleanery.llm.oracles import OP2, OP3, OP4, OP6, OP8, OP10, OP11, OP12
from gleanery.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """The public tokenizer's file; every machine of a cluster has the package that brings it."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.digest(spark, folder)


def op2_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.digest(spark.read.parquet(f"{folder}/documents.parquet"))


def op3_pq_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return pq_dedup.linked(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(spark.read.parquet(f"{folder}/documents.parquet"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digest(spark.read.parquet(f"{folder}/documents.parquet"))


def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Two-word shingles, as the query's contract says; the operator's own default is five."""
    return minhash.digest(spark.read.parquet(f"{folder}/documents.parquet"), width=2)


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(spark.read.parquet(f"{folder}/documents.parquet"), tokenizer_path())


def op8_web_archives(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch_path(spark, "archives")
    web_archives.write_archives(spark.read.parquet(f"{folder}/pages.parquet"), archives)
    return web_archives.read_archives(spark, archives)


def op9_collision_search(spark: SparkSession, folder: str) -> DataFrame:
    """Every 20th vec_id against all other rows, as the query's contract says."""
    embeddings = spark.read.parquet(f"{folder}/embeddings.parquet")
    return collision_search.search(embeddings, embeddings.filter(F.col("vec_id") % 20 == 0))


def op10_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.digest(spark.read.parquet(f"{folder}/documents.parquet"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(spark.read.parquet(f"{folder}/documents.parquet"))


def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.duplicates(spark.read.parquet(f"{folder}/documents.parquet"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return token_alignment.digest(docs, tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER))


QUERIES["op1_toxicity"] = op1_toxicity
QUERIES["op2_personal_data"] = op2_personal_data
ORACLES["op2_personal_data"] = OP2
QUERIES["op3_pq_dedup"] = op3_pq_dedup
ORACLES["op3_pq_dedup"] = OP3
QUERIES["op4_line_dedup"] = op4_line_dedup
ORACLES["op4_line_dedup"] = OP4
QUERIES["op5_secret_scan"] = op5_secret_scan
QUERIES["op6_minhash"] = op6_minhash
ORACLES["op6_minhash"] = OP6
QUERIES["op7_packing"] = op7_packing
QUERIES["op8_web_archives"] = op8_web_archives
ORACLES["op8_web_archives"] = OP8
QUERIES["op9_collision_search"] = op9_collision_search
QUERIES["op10_mix_sources"] = op10_mix_sources
ORACLES["op10_mix_sources"] = OP10
QUERIES["op11_collocations"] = op11_collocations
ORACLES["op11_collocations"] = OP11
QUERIES["op12_exact_dedup"] = op12_exact_dedup
ORACLES["op12_exact_dedup"] = OP12
QUERIES["op13_token_alignment"] = op13_token_alignment
