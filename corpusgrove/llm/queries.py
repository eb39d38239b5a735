"""Registered queries of the operators, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusgrove.llm import ans_tokens, block_mix, byte_bpe, chat_tree, gear_chunks, hard_negatives, hilbert_ann, license_scan, line_crf, minhash_star, simhash_leaks, suffix_levels, whitening
from corpusgrove.storage import scratch_path

TOKENIZER = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query
def op1_chat_tree(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    path = tokenizer_path("byte_bpe_50k.json")
    return chat_tree.digests(chat_tree.build(rows.unionByName(probe), path), path)


@query
def op2_line_quality(spark, sf):
    return line_crf.quality(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


@query
def op3_license_scan(spark, sf):
    return license_scan.scan(documents(spark, sf))


@query
def op4_hilbert_neighbours(spark, sf):
    return hilbert_ann.nearest_neighbours(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query
def op5_near_duplicates(spark, sf):
    return minhash_star.near_duplicates(documents(spark, sf))


@query
def op6_gear_chunks(spark, sf):
    return gear_chunks.without_copies(documents(spark, sf))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op7_token_blocks(spark, sf):
    path = scratch_path(spark, "tokens")
    ans_tokens.write_tokens(documents(spark, sf), path, tokenizer_path())
    return ans_tokens.document_digests(spark, path)


@query
def op8_benchmark_leaks(spark, sf):
    return simhash_leaks.find_leaks(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


@query
def op9_mix_sources(spark, sf):
    return block_mix.taken_words(block_mix.mix_sources(documents(spark, sf)))


@query
def op10_suffix_levels(spark, sf):
    return suffix_levels.without_repeats(documents(spark, sf))


@query
def op11_whitened_vectors(spark, sf):
    return whitening.whiten(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query
def op12_hard_negatives(spark, sf):
    return hard_negatives.mine(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query
def op13_byte_bpe(spark, sf):
    import public_tokenizers

    return byte_bpe.round_trips(documents(spark, sf), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
