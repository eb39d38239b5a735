"""The corpus pipeline: documents in, blocks of token ids out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns they got.

Defined results: null, empty and wordless texts do not pass the quality stage;
rows that repeat a doc_id are one document to the near-dedup stage, which keeps
one of them, and rows with a null doc_id are documents of their own; an empty
table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusgrove.llm import ans_tokens, block_mix, line_crf, minhash_star, simhash_leaks
from corpusgrove.llm.queries import tokenizer_path
from corpusgrove.storage import materialize, scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model takes for good."""
    return line_crf.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return minhash_star.first_of_groups(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return simhash_leaks.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: cut to the taken blocks, repeated as often.

    The block size follows the smallest target, and every source with words has a block.
    """
    return block_mix.mixed_documents(docs, block_mix.mix_sources(docs, block_words=None, least_slots=1))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token blocks of the documents, and what the files say of each."""
    path = scratch_path(spark, "tokens")
    ans_tokens.write_tokens(docs, path, tokenizer_path())
    return ans_tokens.document_digests(spark, path)


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("mix_sources", mix),
    ("token_blocks", tokens),
]

# learned scores, hashed draws and a tokenizer: not for SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
