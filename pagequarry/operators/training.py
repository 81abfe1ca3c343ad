"""Question and answer pairs from documents, in resumable runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.text import explode_rows
from pagequarry.operators.prompts import fill_template
from pagequarry.operators.skew import hot_keys, salted_join
from pagequarry.session import materialise

QUESTION_TEMPLATE = (
    "Text: {document}\nPropose one or two questions that this text answers. Reply with a JSON array of strings only."
)
PAIR_TEMPLATE = "Using the text\n\n{document}\n\nanswer this question:\n\n{question}"


def question_prompt(document: Column) -> Column:
    return fill_template(QUESTION_TEMPLATE, document=document)


def answer_prompt(document: Column, question: Column) -> Column:
    return fill_template(PAIR_TEMPLATE, document=document, question=question)


def parse_questions(reply: Column) -> Column:
    """Strings of a JSON array; null for anything else."""
    return F.from_json(reply, "array<string>")


def question_rows(df: DataFrame, doc_id: str, questions: Column) -> DataFrame:
    """``doc_id, question_no, question``, one row per question."""
    rows = explode_rows(df.select(F.col(doc_id).alias("doc_id"), questions.alias("asked")), F.col("asked"), "no", "question")
    return rows.select("doc_id", F.col("no").cast("bigint").alias("question_no"), "question")


def with_documents(questions: DataFrame, documents: DataFrame, id: str, spread_by: str) -> DataFrame:
    """Inner join of questions to their documents, also when one document has most questions.

    The questions are written first, as they are read several times and may
    come from a model.
    """
    questions = materialise(questions, "questions")
    counts = questions.groupBy("doc_id").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    lookup = documents.withColumnRenamed(id, "doc_id")
    return salted_join(questions, lookup, "doc_id", hot_keys(counts, "doc_id", "n", total), spread_by)


def pending(work: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``work`` without a result yet, whatever run was interrupted."""
    return work.join(done.select(*keys).distinct(), list(keys), "left_anti")


def in_batches(df: DataFrame, key: str, batches: int) -> DataFrame:
    """A stable batch number per key, for runs that handle one batch at a time."""
    return df.withColumn("batch", F.pmod(F.xxhash64(key), F.lit(batches)))
