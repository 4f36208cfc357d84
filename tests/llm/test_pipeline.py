"""The pipeline, stage by stage, and every query next to its SQL."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import compare, sql_connection
from tallytide.llm import decontaminate, mixing, neardup, pii, quality
from tallytide.llm import queries as corpus

from .conftest import DOCS, messy_rows, sentence
from .test_operators import brute_components, shingles

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="benchmark tables are not here")


@pytest.mark.parametrize("name", list(corpus.queries()))
def test_query(spark, name):
    result = compare(spark, FOLDER, name, sql_connection(FOLDER))
    assert result.startswith("match") or result.startswith("rows only (") and "(0)" not in result, result


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontamination", "pii", "mixing"]
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, FOLDER).persist()
    scored = quality.score(docs, quality.train(docs, labels))
    assert sorted(r[0] for r in good.select("doc_id").collect()) == sorted(
        r[0] for r in scored.filter("score >= 0.7").select("doc_id").collect())
    single = stages["near_dedup"](spark, good, FOLDER).persist()
    assert single.count() == neardup.near_duplicates(good, percent=corpus_pipeline.NEAR_PERCENT).filter("kept").count()
    assert neardup.near_duplicates(single, percent=corpus_pipeline.NEAR_PERCENT).filter("not kept").count() == 0
    clean = stages["decontamination"](spark, single, FOLDER).persist()
    assert decontaminate.report(decontaminate.decontaminate(clean, items)).filter("contaminated").count() == 0
    private = stages["pii"](spark, clean, FOLDER).persist()
    assert private.columns == docs.columns and private.count() == clean.count()
    assert pii.report(pii.find_pii(private)).filter("spans <> ''").count() == 0
    assert private.filter(F.length("text") != F.col("n_chars")).count() == 0
    mixed = stages["mixing"](spark, private, FOLDER)
    assert mixed.agg(F.sum("taken")).first()[0] == mixing.mix_plan(private).agg(F.sum("taken")).first()[0]
    ran = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, ran.select("doc_id", "taken").collect())) == sorted(map(tuple, mixed.select("doc_id", "taken").collect()))


def test_stages_on_messy_rows(spark, messy, no_docs, tmp_path):
    for docs, rows in ((messy, len(messy_rows())), (no_docs, 0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns and out.count() <= rows, name
        corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count()


def test_near_dedup_stage_takes_pairs_from_080_on(spark):
    rng = random.Random(8)
    texts = [sentence(rng, 120) for _ in range(6)]
    for words, changed in ((texts[0].split(), (60,)), (texts[1].split(), (30, 90)), (texts[2].split(), (20, 60, 100))):
        for at in changed:
            words[at] = "altered"
        texts.append(" ".join(words))
    like = [len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for a, b in zip(texts[:3], texts[6:])]
    assert like[0] > 0.85 and 0.8 < like[1] < 0.85 and like[2] < 0.8
    rows = [(i, t, "en", "s1", len(t), *["x"] * 6) for i, t in enumerate(texts)]
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, spark.createDataFrame(rows, DOCS).repartition(3), FOLDER)
    kept = sorted(r[0] for r in got.select("doc_id").collect())
    assert kept == sorted(key for key, _, _, stays in brute_components(list(enumerate(texts)), percent=80) if stays)
    assert kept == [0, 1, 2, 3, 4, 5, 8]
