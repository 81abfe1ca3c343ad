"""Registered queries: prompts, answers and training pairs."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from pagequarry.operators import prompts, training
from pagequarry.operators.index import IndexStore
from pagequarry.operators.answers import answer_from_contexts, answer_questions, attach_columns
from pagequarry.operators.models import (
    call_model,
    hashed_words,
    stub_chat_model,
    stub_question_model,
    stub_text_model,
)
from pagequarry.plans import sql
from pagequarry.plans.registry import query, table, texts
from pagequarry.plans.search_queries import _QUESTION_RANKING, asked, document_index, keyword_hits, _keyword_hits
from pagequarry.plans.pages import pages_to_chunks
from pagequarry.plans.text_queries import _PAGE_CHUNKS, CHUNK_LIMITS
from pagequarry.plans.training import ask_documents, asked_questions, new_answers, new_questions
from pagequarry.session import materialise, new_folder
from pagequarry.sources import tables


def _context_sql(tail: str) -> str:
    return _keyword_hits(2, f"""
    , contexts AS (
        SELECT qid, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context
        FROM hits JOIN documents ON doc_id = id GROUP BY qid)
    {tail}""")


def contexts(spark, folder):
    hits = attach_columns(keyword_hits(spark, folder, 2), table(spark, folder, "documents"), "doc_id", "text")
    return prompts.stuffed_context(hits, "text")


@query(_context_sql("SELECT qid, context FROM contexts"))
def stuffed_contexts(spark, folder):
    return contexts(spark, folder)


@query(_context_sql(f"""
    SELECT qid, {sql.filled(prompts.ANSWER_TEMPLATE, context='context', question='text')} AS prompt
    FROM contexts JOIN benchmark ON item_id = qid"""))
def filled_prompts(spark, folder):
    joined = contexts(spark, folder).join(asked(spark, folder), "qid")
    prompt = prompts.fill_template(prompts.ANSWER_TEMPLATE, context=F.col("context"), question=F.col("question"))
    return joined.select("qid", prompt.alias("prompt"))


def _messages_sql(question: str, passage: str) -> str:
    system = f"{sql.quoted(prompts.SYSTEM_TEXT)} || coalesce({sql.quoted(prompts.PASSAGE_INTRO)} || {passage}, '')"
    user = sql.filled(prompts.USER_TEMPLATE, question=question)
    return (
        f"CAST(to_json([{{'role': 'system', 'content': {system}}}, {{'role': 'user', 'content': {user}}}]) AS VARCHAR)"
    )


@query(f"SELECT doc_id, {_messages_sql('source', 'CASE WHEN n_chars > 500 THEN text END')} AS messages FROM documents")
def chat_messages(spark, folder):
    """Messages as JSON; documents of up to 500 characters count as no passage."""
    passage = F.when(F.col("n_chars") > 500, F.col("text"))
    messages = prompts.chat_messages(F.col("source"), passage)
    return texts(spark, folder, "documents").select("doc_id", F.to_json(messages).alias("messages"))


@query("""
    SELECT doc_id, replace('Reply' || chr(10) || md5(text)
           || CASE WHEN lang = 'en' THEN chr(10) || 'More on this: <a href="' || source || '">open the page</a>' ELSE '' END,
           chr(10), '<br/>') AS answer
    FROM documents""")
def final_answers(spark, folder):
    """Answer read from the response JSON, linked and made ready for HTML."""
    documents = texts(spark, folder, "documents")
    response = call_model(F.col("text"), stub_chat_model())
    url = F.when(F.col("lang") == "en", F.col("source"))
    return documents.withColumn("response", response).select(
        "doc_id", prompts.final_answer(prompts.response_text(F.col("response")), url).alias("answer")
    )


@query("""
    SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN 'Reply ' || md5(text) ELSE text || 'Reply ' || md5(text) END AS generated
    FROM documents""")
def generated_texts(spark, folder):
    """Output by task: completion models repeat their prompt."""
    documents = texts(spark, folder, "documents").withColumn("output", call_model(F.col("text"), stub_text_model()))
    task = (
        F.when(F.col("lang").isin("en", "fr"), "text-generation")
        .when(F.col("lang") == "de", "summarization")
        .otherwise("text2text-generation")
    )
    return documents.select("doc_id", prompts.generated_text(task, F.col("output"), F.col("text")).alias("generated"))


@query(r"SELECT doc_id, string_split_regex(text, '\. |\n\n| the ')[1] AS text FROM documents")
def stop_sequences(spark, folder):
    cut = prompts.cut_at_stop(F.col("text"), [". ", "\n\n", " the "])
    return texts(spark, folder, "documents").select("doc_id", cut.alias("text"))


@query("""
    WITH turns AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations)
    SELECT conv_id, string_agg(CASE role
        WHEN 'system' THEN '<s>[INST] <<SYS>>' || chr(10) || text || chr(10) || '<</SYS>>' || chr(10) || chr(10)
        WHEN 'user' THEN CASE WHEN before = 'system' THEN '' ELSE '<s>[INST] ' END || text || ' [/INST] '
        ELSE text || ' </s>' END, '' ORDER BY turn) AS prompt
    FROM turns GROUP BY 1""")
def conversation_prompts(spark, folder):
    """Conversations in a chat model's layout, laid out four turns at a time."""
    return prompts.conversation_prompts(table(spark, folder, "conversations"), part_turns=4)


@query("""
    SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS history
    FROM conversations GROUP BY 1""")
def conversation_history(spark, folder):
    return prompts.conversation_history(table(spark, folder, "conversations"))


@query("SELECT conv_id, turn, text || 'Reply ' || md5(text) AS reply FROM conversations")
def model_replies(spark, folder):
    turns = table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", call_model(F.col("text"), stub_text_model()).alias("reply"))


_LINKED = """replace('Reply' || chr(10) || md5(prompt)
           || coalesce(chr(10) || 'More on this: <a href="' || url || '">open the page</a>', ''), chr(10), '<br/>')"""


@query(f"""{_QUESTION_RANKING},
    found AS (SELECT qid, text AS content, 'doc/' || doc_id AS url FROM hits JOIN documents ON doc_id = id
              WHERE rank = 1 AND score > 0.66),
    prompted AS (
        SELECT item_id AS qid, url, {_messages_sql('text', 'content')} AS prompt
        FROM benchmark LEFT JOIN found ON item_id = qid)
    SELECT qid, prompt, {_LINKED} AS answer FROM prompted""")
def answered_questions(spark, folder):
    """All questions at once: search, threshold, prompt, model, answer."""
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"), F.concat(F.lit("doc/"), "doc_id").alias("url")
    )
    return answer_questions(
        asked(spark, folder), document_index(spark, folder), documents, hashed_words(64), stub_chat_model()
    )


@query(f"""
    WITH chunks AS ({_PAGE_CHUNKS}), {sql.hashed_vectors('d', 'chunks', 'id', 'content')},
    {sql.hashed_vectors('q', 'benchmark', 'item_id', 'text')}, {sql.cosine_ranking('hits', 'q', 'd')},
    found AS (SELECT qid, content, url FROM hits JOIN chunks USING (id) WHERE rank = 1 AND score > 0.3),
    prompted AS (
        SELECT item_id AS qid, url, {_messages_sql('text', 'content')} AS prompt
        FROM benchmark LEFT JOIN found ON item_id = qid)
    SELECT qid, prompt, {_LINKED} AS answer FROM prompted""")
def answers_from_pages(spark, folder):
    """Pages to chunks, to a stored index, to answers that link their page."""
    chunks = materialise(pages_to_chunks(texts(spark, folder, "pages"), **CHUNK_LIMITS), "chunks")
    store = IndexStore(spark, new_folder(spark, "page-index"))
    store.build(chunks, "id", "content", hashed_words(64), "hashed-64")
    return answer_questions(
        asked(spark, folder), store.load("hashed-64"), chunks, hashed_words(64), stub_chat_model(), threshold=0.3
    )


@query("""
    WITH numbered AS (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS final FROM conversations),
    earlier AS (
        SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS history
        FROM numbered WHERE turn < final GROUP BY 1)
    SELECT n.conv_id AS qid, CAST(to_json(list_concat(list_concat([{'role': 'system', 'content': """ + sql.quoted(prompts.SYSTEM_TEXT) + """}],
               coalesce(history, [])), [{'role': 'user', 'content': """ + sql.filled(prompts.USER_TEMPLATE, question="n.text") + """}])) AS VARCHAR) AS messages
    FROM numbered n LEFT JOIN earlier e ON e.conv_id = n.conv_id WHERE turn = final""")
def follow_up_messages(spark, folder):
    """The last turn of each conversation asked again, after the turns before it."""
    turns = table(spark, folder, "conversations")
    entry = F.struct("turn", "role", F.col("text").alias("content"))
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    history = F.transform(F.slice("turns", 1, F.size("turns") - 1), lambda t: F.struct(t["role"], t["content"]))
    question = F.element_at("turns", -1)["content"]
    messages = prompts.chat_messages(question, F.lit(None).cast("string"), history=history)
    return grouped.select(F.col("conv_id").alias("qid"), F.to_json(messages).alias("messages"))


@query(f"""{_QUESTION_RANKING},
    top AS (SELECT qid, rank, text AS content FROM hits JOIN documents ON doc_id = id WHERE rank <= 2),
    grouped AS (
        SELECT qid, string_agg(content, chr(10) || chr(10) ORDER BY rank) AS context,
               string_agg('<li>' || content || '</li>', '' ORDER BY rank) AS items FROM top GROUP BY qid),
    answered AS (
        SELECT item_id AS qid, text, items,
               'Reply ' || md5({sql.filled(prompts.ANSWER_TEMPLATE, context='context', question='text')}) AS answer
        FROM grouped JOIN benchmark ON item_id = qid)
    SELECT qid, answer, '<section><h4>' || text || '</h4><p>' || answer || '</p><ul>' || items || '</ul></section>' AS fragment
    FROM answered""")
def html_answers(spark, folder):
    """Two best documents as context, completion model, answer with its sources as HTML."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    answered = answer_from_contexts(
        asked(spark, folder), document_index(spark, folder), documents, hashed_words(64), stub_text_model()
    )
    return answered.select("qid", "answer", "fragment")


# ---- training pairs ----

_PROMPT = sql.filled(training.QUESTION_TEMPLATE, document="text")
_QUESTIONS = f"""
    prompts AS (SELECT doc_id, text, md5({_PROMPT}) AS h FROM documents),
    replies AS (
        SELECT doc_id, text, CASE WHEN h < '4' THEN NULL
               WHEN h < 'a' THEN ['What is ' || substr(h, 2, 4) || '?']
               ELSE ['What is ' || substr(h, 2, 4) || '?', 'Why ' || substr(h, 6, 4) || '?'] END AS asked
        FROM prompts),
    questions AS (
        SELECT doc_id, text, unnest(range(len(asked))) AS question_no, unnest(asked) AS question FROM replies)"""


@query(f"SELECT doc_id, {_PROMPT} AS prompt FROM documents")
def question_prompts(spark, folder):
    return texts(spark, folder, "documents").select("doc_id", training.question_prompt(F.col("text")).alias("prompt"))


@query(f"WITH {_QUESTIONS} SELECT doc_id, len(asked)::BIGINT AS questions, asked[1] AS first_question FROM replies")
def parsed_questions(spark, folder):
    """Model replies as arrays; null where the reply is no JSON array."""
    documents = texts(spark, folder, "documents")
    reply = call_model(training.question_prompt(F.col("text")), stub_question_model())
    parsed = documents.select("doc_id", reply.alias("reply")).withColumn("asked", training.parse_questions(F.col("reply")))
    count = F.when(F.col("asked").isNotNull(), F.size("asked").cast("bigint"))
    return parsed.select("doc_id", count.alias("questions"), F.get("asked", F.lit(0)).alias("first_question"))


@query(f"WITH {_QUESTIONS} SELECT doc_id, question_no, question FROM questions")
def question_rows(spark, folder):
    return new_questions(texts(spark, folder, "documents"), "doc_id", "text", stub_question_model())


_PAIR = sql.filled(training.PAIR_TEMPLATE, document="text", question="question")


@query("""
    SELECT conv_id AS doc_id, turn, c.text AS question, d.text AS document
    FROM conversations c JOIN documents d ON d.doc_id = c.conv_id""")
def questions_with_documents(spark, folder):
    """Inner join on the document key; conversation numbers stand for documents."""
    questions = table(spark, folder, "conversations").select(
        F.col("conv_id").alias("doc_id"), "turn", F.col("text").alias("question")
    )
    documents = table(spark, folder, "documents").select("doc_id", F.col("text").alias("document"))
    return training.with_documents(questions, documents, "doc_id", spread_by="turn")


@query(f"WITH {_QUESTIONS} SELECT doc_id, question_no, {_PAIR} AS prompt FROM questions")
def answer_prompts(spark, folder):
    documents = texts(spark, folder, "documents")
    asked_rows = new_questions(documents, "doc_id", "text", stub_question_model())
    joined = training.with_documents(asked_rows, documents.select("doc_id", "text"), "doc_id", spread_by="question_no")
    return joined.select("doc_id", "question_no", training.answer_prompt(F.col("text"), F.col("question")).alias("prompt"))


@query("SELECT conv_id, turn, CASE role WHEN 'user' THEN 1 ELSE 2 END AS run FROM conversations")
def pending_work(spark, folder):
    """A second run takes exactly what the first one left."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    path = new_folder(spark, "answered")
    tables.append_run(turns.filter(F.col("role") == "user").drop("role"), path, 1)
    left = training.pending(turns, spark.read.parquet(path), "conv_id", "turn")
    tables.append_run(left.drop("role"), path, 2)
    return spark.read.parquet(path)


@query("SELECT conv_id, turn, role FROM conversations ORDER BY conv_id, turn LIMIT 10 OFFSET 20")
def question_page(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    return tables.page_of_rows(turns, "conv_id", "turn", offset=20)


@query(f"""
    WITH {_QUESTIONS}
    SELECT doc_id, question_no, question, 'Reply ' || md5({_PAIR}) AS answer FROM questions""")
def training_pairs(spark, folder):
    """Documents to questions to answers; asking is done in two runs, no document twice."""
    documents = texts(spark, folder, "documents").select("doc_id", "text", "lang")
    replies, answers = new_folder(spark, "replies"), new_folder(spark, "answers")
    ask_documents(documents.filter(F.col("lang") == "en"), replies, 1, stub_question_model())
    ask_documents(documents, replies, 2, stub_question_model())
    new_answers(asked_questions(spark, replies), documents.select("doc_id", "text"), answers, 1, stub_text_model())
    return spark.read.parquet(answers).select("doc_id", "question_no", "question", "answer")


def failing_text_model():
    """The stand-in completion model, failing at prompts whose MD5 starts below 8."""

    def factory():
        answer = stub_text_model()()

        def run(batch):
            if any(hashlib.md5(prompt.encode()).hexdigest()[0] < "8" for prompt in batch):
                raise RuntimeError("no reply")
            return answer(batch)

        return run

    return factory


@query(f"""
    WITH {_QUESTIONS},
    paired AS (SELECT doc_id, question_no, question, md5({_PAIR}) AS h FROM questions),
    runs AS (SELECT *, unnest(CASE WHEN h < '8' THEN [1, 2] ELSE [1] END)::INTEGER AS run FROM paired)
    SELECT doc_id, question_no, question, run, CASE WHEN h >= '8' OR run = 2 THEN 'Reply ' || h END AS answer,
           CASE WHEN h < '8' AND run = 1 THEN 'RuntimeError: no reply' END AS error
    FROM runs""")
def answers_after_errors(spark, folder):
    """Some prompts fail in the first run; the second takes only those."""
    documents = texts(spark, folder, "documents").select("doc_id", "text")
    replies, answers = new_folder(spark, "replies"), new_folder(spark, "answers")
    ask_documents(documents, replies, 1, stub_question_model())
    questions = asked_questions(spark, replies)
    for run, model in ((1, failing_text_model()), (2, stub_text_model())):
        new_answers(questions, documents, answers, run, model)
    return spark.read.parquet(answers).select("doc_id", "question_no", "question", "run", "answer", "error")


@query(f"""
    WITH {_QUESTIONS}
    SELECT doc_id, prompt, asked[1] AS first_question, len(asked)::BIGINT AS questions FROM (
        SELECT doc_id, {_PROMPT} AS prompt, CASE lang WHEN 'en' THEN ['lang', lang] END AS asked FROM documents)""")
def sql_functions(spark, folder):
    """Functions defined in SQL: one returns an array and calls another."""
    from pagequarry.plans.training import define_sql_functions

    define_sql_functions(spark)
    table(spark, folder, "documents").createOrReplaceTempView("sql_function_documents")
    return spark.sql("""
        SELECT doc_id, question_prompt_of(text) AS prompt, questions_of(reply)[0] AS first_question,
               CAST(size(questions_of(reply)) AS BIGINT) AS questions
        FROM (SELECT doc_id, text, CASE lang WHEN 'en' THEN concat('["lang", "', lang, '"]') ELSE lang END AS reply
              FROM sql_function_documents)""")
