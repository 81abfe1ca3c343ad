"""Registered queries of this subpackage, each a thin call of its operator, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.llm import sql
from pagequarry.session import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id", "labels": "doc_id", "benchmark": "item_id"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A whole table, spread over the cores when it has fewer partitions."""
    return spread(spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet"), KEYS[name])


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


@query(sql.NEAR_DUPLICATES)
def op6_minmax_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.minhash import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


@query()
def op5_codeword_language(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.language import held_out, identify, learn

    documents = table(spark, folder, "documents")
    return identify(documents, learn(documents, ~held_out()))


@query()
def op1_ftrl_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.toxicity import held_out, learn, score

    documents = table(spark, folder, "documents")
    return score(documents, learn(documents, table(spark, folder, "labels"), ~held_out()))


@query(sql.QUALITY)
def op3_host_quality(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.quality import judge

    return judge(table(spark, folder, "documents"))


@query()
def op8_boosted_pii(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.pii import find, learn

    documents = table(spark, folder, "documents")
    return find(documents, learn(documents))


@query(sql.OVERLAPS)
def op9_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.decontamination import overlaps

    return overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(sql.LOSS_DIFFERENCE)
def op10_loss_difference(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.lm_scoring import learn, score

    documents = table(spark, folder, "documents")
    good = table(spark, folder, "labels").filter("quality = 1")
    return score(documents, learn(documents, good)).withColumn("difference", F.round("difference", 6))


@query(sql.LOSS_DIFFERENCE_EVERY_WORD)
def op10_loss_difference_every_word(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.lm_scoring import score_by_every_word

    good = table(spark, folder, "labels").filter("quality = 1")
    return score_by_every_word(table(spark, folder, "documents"), good).withColumn("difference", F.round("difference", 6))


@query()
def op2_soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.mixing import mixing_rates

    return mixing_rates(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(sql.PREFERENCES)
def op4_preference_pairs(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.preferences import neighbour_pairs, preference_pairs

    return preference_pairs(*neighbour_pairs(table(spark, folder, "conversations")))


@query()
def op7_layout_text(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.rendering import visible_texts

    return visible_texts(table(spark, folder, "pages"))


@query()
def op11_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.bpe import round_trip

    coded = round_trip(table(spark, folder, "documents").select("doc_id", "text"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(sql.DIVERGENCES)
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.audit import divergences

    return divergences(table(spark, folder, "documents"))


@query()
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    from pagequarry.llm.manifest import manifest

    return manifest(table(spark, folder, "documents")).drop("lang")
