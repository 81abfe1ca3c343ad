"""Training pairs: questions from documents, then answers, each run resumable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.functions.text import strip
from pagequarry.operators.models import TextModel, call_model, try_model
from pagequarry.operators.prompts import generated_text
from pagequarry.operators.training import (
    QUESTION_TEMPLATE,
    answer_prompt,
    parse_questions,
    pending,
    question_prompt,
    question_rows,
    with_documents,
)
from pagequarry.sources.tables import append_run, list_numbers


def new_questions(documents: DataFrame, doc_id: str, text: str, model: TextModel) -> DataFrame:
    """``doc_id, question_no, question`` the model proposes; documents with a malformed reply give none."""
    replied = documents.select(doc_id, call_model(question_prompt(F.col(text)), model).alias("reply"))
    return question_rows(replied, doc_id, parse_questions(F.col("reply")))


def _unfinished(work: DataFrame, folder: str, run: int, *keys: str) -> DataFrame:
    """Rows of ``work`` that no run but ``run`` has finished without an error."""
    spark = work.sparkSession
    if not list_numbers(spark, folder, "run="):
        return work
    return pending(work, spark.read.parquet(folder).filter((F.col("run") != run) & F.col("error").isNull()), *keys)


def ask_documents(documents: DataFrame, folder: str, run: int, model: TextModel) -> None:
    """Ask about the documents (doc_id, text) without a reply in ``folder``; adds ``doc_id, reply, error`` as ``run``.

    Every document asked is recorded, so one without usable questions is not asked again; one that failed is.
    """
    todo = _unfinished(documents, folder, run, "doc_id")
    outcome = todo.select("doc_id", try_model(question_prompt(F.col("text")), model).alias("outcome"))
    append_run(outcome.select("doc_id", "outcome.reply", "outcome.error"), folder, run)


def asked_questions(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, question_no, question`` of all replies in ``folder``."""
    replies = spark.read.parquet(folder).filter("error IS NULL")
    return question_rows(replies, "doc_id", parse_questions(F.col("reply")))


def new_answers(questions: DataFrame, documents: DataFrame, folder: str, run: int, model: TextModel) -> None:
    """Answer the questions without an answer in ``folder`` and add them as ``run``.

    ``documents`` has ``doc_id, text``. The model repeats its prompt before the
    answer. A prompt that fails gets a row with its ``error`` and stays pending.
    """
    questions = _unfinished(questions, folder, run, "doc_id", "question_no")
    joined = with_documents(questions, documents, "doc_id", spread_by="question_no")
    prompted = joined.withColumn("prompt", answer_prompt(F.col("text"), F.col("question")))
    replied = prompted.withColumn("outcome", try_model(F.col("prompt"), model))
    answer = strip(generated_text(F.lit("text-generation"), F.col("outcome.reply"), F.col("prompt")))
    append_run(replied.select("doc_id", "question_no", "question", answer.alias("answer"), "outcome.error"), folder, run)


def define_sql_functions(spark: SparkSession) -> None:
    """Temporary SQL functions for prompts and replies."""
    before, after = (part.replace("\n", "\\n").replace("'", "\\'") for part in QUESTION_TEMPLATE.split("{document}"))
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION question_prompt_of(document STRING) RETURNS STRING
        RETURN concat('{before}', document, '{after}')""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION json_strings(reply STRING) RETURNS ARRAY<STRING>
        RETURN from_json(reply, 'array<string>')""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION questions_of(reply STRING) RETURNS ARRAY<STRING>
        RETURN json_strings(trim(reply))""")
