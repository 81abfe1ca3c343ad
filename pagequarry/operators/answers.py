"""Search results with metadata, thresholds and whole answers for many questions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.operators.models import Embedder, TextModel, call_model, embed
from pagequarry.functions.text import line_breaks_to_html, strip
from pagequarry.operators.prompts import (
    ANSWER_TEMPLATE,
    answer_html,
    chat_messages,
    cut_at_stop,
    fill_template,
    final_answer,
    generated_text,
    response_text,
)
from pagequarry.operators.ranking import Dense, Scoring, nearest
from pagequarry.operators.skew import hot_keys, salted_join
from pagequarry.session import materialise

RELEVANCE_THRESHOLD = 0.66
MAX_BROADCAST_HITS = 100_000


def attach_columns(hits: DataFrame, documents: DataFrame, id: str, *columns: str) -> DataFrame:
    """``hits`` with columns of their documents, the score last.

    The hits are written first, so their number is known: up to
    ``MAX_BROADCAST_HITS`` they travel to the documents, which then are not
    shuffled; more are joined with popular documents spread.
    """
    hits = materialise(hits, "hits")
    lookup = documents.select(F.col(id).alias("id"), *columns)
    total = hits.count()
    if total <= MAX_BROADCAST_HITS:
        joined = lookup.join(F.broadcast(hits), "id")
    else:
        counts = hits.groupBy("id").agg(F.count("*").alias("n"))
        joined = salted_join(hits, lookup, "id", hot_keys(counts, "id", "n", total), spread_by="qid")
    return joined.select("qid", "rank", "id", *columns, "score")


def apply_threshold(questions: DataFrame, hits: DataFrame, threshold: float = RELEVANCE_THRESHOLD) -> DataFrame:
    """Every question with its hits above ``threshold``; one without any keeps a row of nulls."""
    return questions.join(hits.filter(F.col("score") > threshold), "qid", "left")


def best_hit(hits: DataFrame, threshold: float = RELEVANCE_THRESHOLD) -> DataFrame:
    """First hit of each question if it is above ``threshold``."""
    return hits.filter((F.col("rank") == 1) & (F.col("score") > threshold))


def embed_questions(questions: DataFrame, text: str, embedder: Embedder) -> DataFrame:
    return questions.select("qid", embed(F.coalesce(text, F.lit("")), embedder).alias("vector"))


def as_questions(spark: SparkSession, asked: DataFrame | Iterable[str]) -> DataFrame:
    """``qid, question``: those columns of a DataFrame, or numbered strings in the order given.

    Of rows with several fields the first one is the question.
    """
    if isinstance(asked, DataFrame):
        return asked.select("qid", "question")
    rows = [asked] if isinstance(asked, str) else asked.itertuples(index=False) if hasattr(asked, "itertuples") else asked
    numbered = [(qid, str(row if isinstance(row, str) else next(iter(row)))) for qid, row in enumerate(rows)]
    return spark.createDataFrame(numbered, "qid bigint, question string")


def answer_questions(
    questions: DataFrame,
    index: DataFrame,
    documents: DataFrame,
    embedder: Embedder,
    model: TextModel,
    scoring: Scoring = Dense("cosine"),
    threshold: float = RELEVANCE_THRESHOLD,
    where: Column | None = None,
    id: str = "id",
    content: str = "content",
    url: str = "url",
    history: str | None = None,
) -> DataFrame:
    """``qid, answer, prompt`` for ``questions (qid, question)``, any number at once.

    The best document above ``threshold`` is added to the prompt and linked in
    the answer; without one the model is asked on its own. ``history`` names a
    column of ``questions`` with the messages before a follow-up question.
    """
    asked = materialise(embed_questions(questions, "question", embedder), "questions")
    hits = nearest(asked, index, 1, scoring, where=where)
    found = attach_columns(best_hit(hits, threshold), documents, id, content, url)
    joined = questions.join(found.select("qid", content, url), "qid", "left")
    messages = chat_messages(F.col("question"), F.col(content), history=None if history is None else F.col(history))
    prompts = joined.select("qid", url, F.to_json(messages).alias("prompt"))
    replied = prompts.withColumn("response", call_model(F.col("prompt"), model))
    return replied.select("qid", final_answer(response_text(F.col("response")), F.col(url)).alias("answer"), "prompt")


def answer_from_contexts(
    questions: DataFrame,
    index: DataFrame,
    documents: DataFrame,
    embedder: Embedder,
    model: TextModel,
    k: int = 2,
    scoring: Scoring = Dense("cosine"),
    template: str = ANSWER_TEMPLATE,
    separator: str = "\n\n",
    stops: tuple[str, ...] = (),
    where: Column | None = None,
    id: str = "id",
    content: str = "content",
) -> DataFrame:
    """``qid, answer, sources, fragment``: answers of a completion model over the best ``k`` documents.

    The model repeats its prompt, which is cut off; ``fragment`` shows
    question, answer and sources as HTML. Questions without any hit are asked
    over an empty context.
    """
    asked = materialise(embed_questions(questions, "question", embedder), "questions")
    found = attach_columns(nearest(asked, index, k, scoring, where=where), documents, id, content)
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.col(content).alias("text"))))
    grouped = found.groupBy("qid").agg(F.transform(ordered, lambda hit: hit["text"]).alias("sources"))
    joined = questions.join(grouped, "qid", "left").withColumn(
        "sources", F.coalesce("sources", F.array().cast("array<string>"))
    )
    context = F.array_join("sources", separator)
    prompted = joined.withColumn("prompt", fill_template(template, context=context, question=F.col("question")))
    replied = prompted.withColumn("output", call_model(F.col("prompt"), model))
    text = generated_text(F.lit("text-generation"), F.col("output"), F.col("prompt"))
    answered = replied.withColumn("answer", strip(cut_at_stop(text, stops) if stops else text))
    fragment = answer_html(F.col("question"), line_breaks_to_html(F.col("answer")), F.col("sources"))
    return answered.select("qid", "answer", "sources", fragment.alias("fragment"))
