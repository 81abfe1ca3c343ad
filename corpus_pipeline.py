"""From raw documents to a training mix, stage by stage, each stage written before the next reads it.

The first four stages return the columns they were given, on the rows they keep:
an unclear language, all but one of a group of near duplicates, and overlaps
with the benchmark go; personal data is replaced in the text. The last stage
adds each row's rate and number of copies in the mix. Rows whose doc_id is null
pass the stages that go by doc_id; a null or empty text has no language and goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagequarry.llm.decontamination import decontaminated
from pagequarry.llm.language import identified
from pagequarry.llm.minhash import deduplicated
from pagequarry.llm.mixing import mixed
from pagequarry.llm.pii import learn, redacted
from pagequarry.session import materialise


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear stay (operator 5)."""
    return identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (operator 6)."""
    return deduplicated(docs)


def benchmark_overlaps(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark stay (operator 9)."""
    return decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind (operator 8)."""
    return redacted(docs, learn(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates and copies that bring the domains to their target weights (operator 2)."""
    return mixed(docs, _table(spark, sf_dir, "labels"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_overlaps", benchmark_overlaps),
    ("personal_data", personal_data),
    ("mix", mix),
]

# Learned models decide in several stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
