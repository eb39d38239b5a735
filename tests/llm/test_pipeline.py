"""The pipeline's stages in order, and the registration of queries."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from corpusgrove.llm import ans_tokens, line_crf, minhash_star, simhash_leaks

from .test_ans_tokens import naive as naive_tokens
from .test_minhash_star import naive as naive_groups
from .test_simhash_leaks import naive as naive_leaks

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_every_stage_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "minhash_near_dedup", "benchmark_decontamination", "mix_sources", "token_blocks"]
    labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))

    good = stages["quality_classifier"](spark, docs, SF).cache()
    want = {r["doc_id"] for r in line_crf.quality(docs, labels).where("predicted = 1").collect()}
    assert good.columns == docs.columns and {i for i, _ in rows_of(good)} == want

    single = stages["minhash_near_dedup"](spark, good, SF).cache()
    assert single.columns == docs.columns
    assert sorted(i for i, _ in rows_of(single)) == sorted(i for i, _, _, kept in naive_groups(rows_of(good)) if kept)

    clean = stages["benchmark_decontamination"](spark, single, SF).cache()
    leaks = {d for d, *_ in naive_leaks(rows_of(single), [(r["item_id"], r["text"]) for r in benchmark.collect()])}
    assert clean.columns == docs.columns and {i for i, _ in rows_of(clean)} == {i for i, _ in rows_of(single)} - leaks

    mixed = stages["mix_sources"](spark, clean, SF).cache()
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert {i for i, _ in rows_of(mixed)} <= {i for i, _ in rows_of(clean)}

    tokens = stages["token_blocks"](spark, mixed, SF)
    assert sorted([tuple(r) for r in tokens.collect()], key=lambda r: r[1]) == naive_tokens(rows_of(mixed))


def test_registered_run_gives_token_rows(spark):
    out = entry.queries()["pipeline"](spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
