"""Prompts, chat messages, histories and the clean-up of model output."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.text import line_breaks_to_html

ANSWER_TEMPLATE = (
    "Answer from the excerpts below and point to the ones you relied on. "
    "When they do not contain the answer, reply that it is unknown.\n\n{context}\n\nQuestion: {question}\nAnswer:"
)
SYSTEM_TEXT = "You help readers of a document collection. Decline questions outside its subjects."
PASSAGE_INTRO = "\n\nThis passage may be useful:\n\n"
USER_TEMPLATE = "Reply in detail to the question, or say that you cannot.\n\nQuestion: {question}"


def stuffed_context(hits: DataFrame, text: str, separator: str = "\n\n") -> DataFrame:
    """``qid, context``: texts of each question's hits in rank order; a group has at most k rows."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.col(text).alias("text"))))
    return hits.groupBy("qid").agg(F.array_join(F.transform(ordered, lambda h: h["text"]), separator).alias("context"))


def fill_template(template: str, **values: Column) -> Column:
    """Put columns into ``{name}`` slots; braces inside the values are left alone."""
    slots = "|".join(re.escape(name) for name in values)
    pieces = re.split(rf"\{{({slots})\}}", template)
    return F.concat(
        *[values[piece].cast("string") if number % 2 else F.lit(piece) for number, piece in enumerate(pieces)]
    )


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat_messages(
    question: Column,
    passage: Column,
    system_text: str = SYSTEM_TEXT,
    passage_intro: str = PASSAGE_INTRO,
    user_template: str = USER_TEMPLATE,
    history: Column | None = None,
) -> Column:
    """System and user message; the passage joins the system message when there is one.

    ``history``, an array of messages ``role, content``, comes between the two.
    """
    system = F.concat(F.lit(system_text), F.when(passage.isNotNull(), F.concat(F.lit(passage_intro), passage)).otherwise(""))
    user = message("user", fill_template(user_template, question=question))
    if history is None:
        return F.array(message("system", system), user)
    earlier = F.coalesce(history, F.array().cast("array<struct<role:string,content:string>>"))
    return F.concat(F.array(message("system", system)), earlier, F.array(user))


def response_text(response: Column) -> Column:
    """Answer inside a chat response JSON."""
    return F.get_json_object(response, "$.candidates[0].message.content")


def final_answer(answer: Column, url: Column, label: str = "open the page") -> Column:
    """Answer with a link when a passage was used, ready for HTML."""
    link = F.concat(F.lit('\nMore on this: <a href="'), url, F.lit(f'">{label}</a>'))
    return line_breaks_to_html(F.concat(answer, F.when(url.isNotNull(), link).otherwise("")))


def answer_html(question: Column, answer: Column, sources: Column) -> Column:
    """Question, answer and source passages as one HTML fragment."""
    passages = F.transform(sources, lambda s: F.concat(F.lit("<li>"), s, F.lit("</li>")))
    return F.concat(
        F.lit('<section><h4>'), question, F.lit("</h4><p>"), answer, F.lit("</p><ul>"),
        F.array_join(passages, ""), F.lit("</ul></section>"),
    )


def generated_text(task: Column, output: Column, prompt: Column) -> Column:
    """What the model added, by task; an unknown task fails the job.

    ``text-generation`` repeats the prompt, which is cut off;
    ``text2text-generation`` and ``summarization`` return the text alone.
    """
    return (
        F.when(task == "text-generation", F.substr(output, F.length(prompt) + 1))
        .when(task.isin("text2text-generation", "summarization"), output)
        .otherwise(F.raise_error(F.concat(F.lit("unknown task: "), F.coalesce(task, F.lit("none")))).cast("string"))
    )


def cut_at_stop(text: Column, stops: Sequence[str]) -> Column:
    """Text before the first stop sequence."""
    pattern = "|".join(re.escape(stop) for stop in stops)
    return F.element_at(F.split(text, pattern, 2), 1)


# ---- conversations ----

PART_TURNS = 1000


@dataclass(frozen=True)
class TurnLayout:
    """Markers of a chat model's prompt."""

    # The published markers of the Llama 2 chat prompt.
    turn_open: str = "<s>[INST] "
    system_open: str = "<<SYS>>\n"
    system_close: str = "\n<</SYS>>\n\n"
    turn_close: str = " [/INST] "
    answer_close: str = " </s>"


def _parts(turns: DataFrame, part_turns: int) -> DataFrame:
    """Turns grouped into parts of at most ``part_turns``, each knowing the role before it.

    The last turn of a part also travels to the next one, where it only tells
    its role.
    """
    part = F.floor(F.col("turn") / part_turns)
    is_last = F.col("turn") % part_turns == part_turns - 1
    placed = turns.withColumn("part", F.explode(F.when(is_last, F.array(part, part + 1)).otherwise(F.array(part))))
    entry = F.struct("turn", "role", "text", (F.col("part") != part).alias("carried"))
    return (
        placed.groupBy("conv_id", "part")
        .agg(F.array_sort(F.collect_list(entry)).alias("turns"))
        .filter(F.exists("turns", lambda t: ~t["carried"]))
    )


def _joined(parts: DataFrame, text: Column, name: str, separator: str = "") -> DataFrame:
    """``conv_id`` and the texts of its parts, in order, as one."""
    pieces = parts.select("conv_id", "part", text.alias("piece"))
    ordered = F.array_sort(F.collect_list(F.struct("part", "piece"))).alias("pieces")
    return pieces.groupBy("conv_id").agg(ordered).select("conv_id", F.array_join("pieces.piece", separator).alias(name))


def conversation_prompts(turns: DataFrame, layout: TurnLayout = TurnLayout(), part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, prompt``: conversations ``conv_id, turn, role, text`` as model prompts.

    A system turn opens the block of the user turn after it. Turns are joined
    in parts of ``part_turns``, the parts then to one prompt, so that a long
    conversation is laid out by many tasks.
    """

    def piece(turn: Column, before: Column) -> Column:
        user = F.concat(
            F.when(F.coalesce(before == "system", F.lit(False)), "").otherwise(layout.turn_open),
            turn["text"],
            F.lit(layout.turn_close),
        )
        system = F.concat(F.lit(layout.turn_open + layout.system_open), turn["text"], F.lit(layout.system_close))
        answer = F.concat(turn["text"], F.lit(layout.answer_close))
        return (
            F.when(turn["carried"], "").when(turn["role"] == "user", user).when(turn["role"] == "system", system).otherwise(answer)
        )

    turns_column = F.col("turns")
    pieces = F.transform(turns_column, lambda t, i: piece(t, F.get(turns_column, i - 1)["role"]))
    return _joined(_parts(turns, part_turns), F.array_join(pieces, ""), "prompt")


def conversation_history(turns: DataFrame, separator: str = "\n", part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, history``: lines ``role: text`` in order, for follow-up questions."""
    line = F.struct("turn", F.concat_ws(": ", "role", "text").alias("line"))
    parts = (
        turns.withColumn("part", F.floor(F.col("turn") / part_turns))
        .groupBy("conv_id", "part")
        .agg(F.array_sort(F.collect_list(line)).alias("lines"))
    )
    return _joined(parts, F.array_join("lines.line", separator), "history", separator)
