"""The pipeline's stages on planted cases, and every operator on empty tables and odd columns."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from pagequarry.llm import decontamination, language, lm_scoring, minhash, mixing, pii, preferences, quality, rendering, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and result over the smallest tables."""
    docs, seen = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER).cache()
        seen[name] = (docs, result)
        docs = result
    return seen


def test_all_but_the_last_stage_keep_the_columns(stages):
    names = list(stages)
    for name in names[:-1]:
        assert stages[name][1].columns == stages[name][0].columns
    assert stages[names[-1]][1].columns[-2:] == ["mix_rate", "mix_copies"]


def test_decisions_take_effect(stages, spark):
    docs, kept = stages["near_duplicates"]
    expected = {r.doc_id for r in minhash.near_duplicates(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == expected and kept.count() == len(expected)
    docs, kept = stages["benchmark_overlaps"]
    leaked = decontamination.overlaps(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).select("doc_id").distinct()
    assert kept.count() == docs.count() - leaked.count() and kept.join(leaked, "doc_id").count() == 0
    docs, kept = stages["personal_data"]
    assert kept.count() == docs.count() and not [r for r in kept.collect() if pii.base_spans(r.text)]
    assert stages["mix"][1].filter("mix_copies < 1").count() == 0


def test_run_equals_the_stages(spark, stages):
    whole = corpus_pipeline.run(spark, FOLDER)
    last = stages["mix"][1]
    assert whole.exceptAll(last).count() == last.exceptAll(whole).count() == 0


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, hashes int, host string, id int"


def odd_rows():
    text = "one two three four five six seven eight nine ten"
    row = lambda doc_id, words, lang="en", source="s": (doc_id, words, lang, source, 1, "x", 1, "h", 2)
    return [row(1, text), row(1, text), row(2, None), row(3, ""), row(None, text), row(5, "a" * 200_000), row(6, "b c " * 100_000, None, None), row(None, None, None, None)]


@pytest.mark.parametrize("rows", [odd_rows(), []], ids=["odd", "empty"])
def test_operators_take_odd_and_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0, "x"), (6, 0, 0, "y"), (None, None, None, None)][: len(rows)], "doc_id bigint, quality int, toxic int, text string")
    items = spark.createDataFrame([(1, "one two three four five six"), (None, None)][: len(rows)], "item_id bigint, text string")
    per_row = [
        language.identify(docs, language.learn(docs)), minhash.near_duplicates(docs), quality.judge(docs), pii.find(docs, pii.learn(docs)),
        toxicity.score(docs, toxicity.learn(docs, labels)), mixing.mixing_rates(docs, labels), lm_scoring.score(docs, lm_scoring.learn(docs, labels)),
        pii.redacted(docs, pii.learn(docs)),
    ]
    assert [df.count() for df in per_row] == [len(rows)] * len(per_row)
    found = {r.doc_id for r in decontamination.overlaps(docs, items).collect()}
    assert found == ({1} if rows else set())
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"), "text")
    assert rendering.visible_texts(pages).count() == len(rows)
    turns = docs.select(F.col("doc_id").alias("conv_id"), F.lit(0).cast("bigint").alias("turn"), F.lit("assistant").alias("role"), "text", "id")
    assert preferences.preference_pairs(*preferences.neighbour_pairs(turns)).count() == len({r[0] for r in rows} - {None})
    for clean in (language.identified(docs), minhash.deduplicated(docs), decontamination.decontaminated(docs, items)):
        assert clean.columns == docs.columns and clean.count() <= len(rows)
    assert mixing.mixed(docs, labels).columns == [*docs.columns, "mix_rate", "mix_copies"]
