import json

import pytest
from pyspark.sql import functions as F

from pagequarry.operators import prompts, training
from pagequarry.operators.models import call_model, stub_question_model, try_model
from pagequarry.plans.training import ask_documents, asked_questions, define_sql_functions, new_answers, new_questions


def test_template_does_not_expand_values(spark):
    df = spark.createDataFrame([("see {question}", "why {context}?")], "c string, q string")
    filled = prompts.fill_template("{context}|{question}|{other}", context=F.col("c"), question=F.col("q"))
    assert df.select(filled.alias("p")).first().p == "see {question}|why {context}?|{other}"


def test_messages(spark):
    df = spark.createDataFrame([("q?", 'page "x"'), ("r?", None)], "q string, d string")
    made = df.select(F.to_json(prompts.chat_messages(F.col("q"), F.col("d"))).alias("m")).collect()
    first, second = (json.loads(r.m) for r in made)
    assert [m["role"] for m in first] == ["system", "user"]
    assert first[0]["content"].endswith('page "x"') and second[0]["content"] == prompts.SYSTEM_TEXT
    assert second[1]["content"].endswith("r?")


def test_context_in_rank_order(spark):
    hits = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "qid int, rank int, text string")
    assert sorted(map(tuple, prompts.stuffed_context(hits, "text", "|").collect())) == [(1, "a|b"), (2, "c")]


def test_generated_text(spark):
    rows = [("text-generation", "p", "p tail"), ("summarization", "p", "p tail"), ("text2text-generation", "p", "x")]
    df = spark.createDataFrame(rows, "task string, p string, o string")
    made = prompts.generated_text(F.col("task"), F.col("o"), F.col("p")).alias("g")
    assert [r.g for r in df.select(made).collect()] == [" tail", "p tail", "x"]
    with pytest.raises(Exception, match="unknown task"):
        df.withColumn("task", F.lit("other")).select(made).collect()


def test_stop_sequences(spark):
    df = spark.createDataFrame([("a. b ### c",), ("no stop",), ("###",)], "t string")
    cut = df.select(prompts.cut_at_stop(F.col("t"), ["###", ". "]).alias("t"))
    assert [r.t for r in cut.collect()] == ["a", "no stop", ""]


def test_final_answer_and_fragment(spark):
    df = spark.createDataFrame([("a\nb", "u"), ("c", None)], "a string, u string")
    answers = [r.r for r in df.select(prompts.final_answer(F.col("a"), F.col("u")).alias("r")).collect()]
    assert answers == ['a<br/>b<br/>More on this: <a href="u">open the page</a>', "c"]
    fragment = df.select(prompts.answer_html(F.lit("q"), F.col("a"), F.array(F.lit("s1"), F.lit("s2"))).alias("h")).first().h
    assert fragment.index("q") < fragment.index("a\nb") < fragment.index("s1") < fragment.index("s2")


TURNS = [
    (1, 0, "system", "S"), (1, 1, "user", "U1"), (1, 2, "assistant", "A1"), (1, 3, "user", "U2"),
    (2, 0, "user", "V1"), (2, 1, "assistant", "B1"),
]
WHOLE = {1: "<s>[INST] <<SYS>>\nS\n<</SYS>>\n\nU1 [/INST] A1 </s><s>[INST] U2 [/INST] ", 2: "<s>[INST] V1 [/INST] B1 </s>"}


@pytest.mark.parametrize("part_turns", [1, 2, 3, 1000])
def test_conversations_do_not_depend_on_part_size(spark, part_turns):
    df = spark.createDataFrame(TURNS, "conv_id bigint, turn bigint, role string, text string")
    laid_out = prompts.conversation_prompts(df, part_turns=part_turns).collect()
    assert len(laid_out) == 2 and {r.conv_id: r.prompt for r in laid_out} == WHOLE
    history = prompts.conversation_history(df, part_turns=part_turns).orderBy("conv_id").collect()
    assert [r.history for r in history] == ["system: S\nuser: U1\nassistant: A1\nuser: U2", "user: V1\nassistant: B1"]


def test_a_long_conversation_is_one_prompt(spark):
    turns = spark.range(1500).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "cast(id AS string) AS text")
    expected = "".join(f"<s>[INST] {i} [/INST] " if i % 2 == 0 else f"{i} </s>" for i in range(1500))
    assert [tuple(r) for r in prompts.conversation_prompts(turns).collect()] == [(1, expected)]


def test_a_failing_prompt_leaves_the_others_their_replies(spark):
    def model():
        def run(batch):
            if "bad" in batch:
                raise KeyError("bad")
            return [text + "!" for text in batch]

        return run

    df = spark.createDataFrame([("a",), ("bad",), (None,), ("c",)], "t string").coalesce(1)
    rows = df.select("t", try_model(F.col("t"), model).alias("o")).select("t", "o.*").collect()
    assert {r.t: (r.reply, r.error) for r in rows} == {
        "a": ("a!", None), "bad": (None, "KeyError: 'bad'"), None: (None, None), "c": ("c!", None)
    }
    short = spark.createDataFrame([("a",), ("b",)], "t string").coalesce(1)
    outcomes = short.select(try_model(F.col("t"), lambda: lambda batch: []).alias("o")).select("o.*").collect()
    assert all(r.reply is None and r.error == "ValueError: 0 replies to 1 prompts" for r in outcomes)


def test_documents_without_usable_questions_are_asked_once(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id bigint, text string")
    folder = str(tmp_path / "replies")
    ask_documents(docs.filter("doc_id < 12"), folder, 1, lambda: lambda batch: ["no questions"] * len(batch))
    ask_documents(docs, folder, 2, stub_question_model())
    runs = {r.run: r.n for r in spark.read.parquet(folder).groupBy("run").agg(F.count("*").alias("n")).collect()}
    assert runs == {1: 12, 2: 8} and asked_questions(spark, folder).filter("doc_id < 12").isEmpty()


def test_parse_questions(spark):
    df = spark.createDataFrame([('["a", "b"]',), ("text",), ('"a"',), ("[]",), (None,)], "r string")
    parsed = df.select(training.parse_questions(F.col("r")).alias("q"))
    assert [r.q for r in parsed.collect()] == [["a", "b"], None, None, [], None]


def test_model_is_built_once_per_task_and_nulls_are_not_sent(spark):
    def model():
        built = []

        def run(batch):
            built.append(1)
            assert None not in batch
            return [f"{text}:{len(built)}" for text in batch]

        return run

    df = spark.createDataFrame([("a",), (None,), ("b",)], "t string").coalesce(1)
    assert [r.r for r in df.select(call_model(F.col("t"), model).alias("r")).collect()] == ["a:1", None, "b:1"]


def test_training_runs_resume(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(30)], "doc_id bigint, text string")
    questions = new_questions(docs, "doc_id", "text", stub_question_model()).cache()
    folder = str(tmp_path / "answers")

    def model():
        def run(prompts):
            with open(tmp_path / "asked", "a") as log:
                log.write("x" * len(prompts))
            return [p + " answer" for p in prompts]

        return run

    def asked():
        return len((tmp_path / "asked").read_text())

    half = questions.filter("doc_id < 15")
    new_answers(half, docs, folder, 1, model)
    new_answers(questions, docs, folder, 2, model)
    rows = spark.read.parquet(folder)
    assert rows.count() == questions.count() and rows.filter("run = 1").count() == half.count()
    assert {r.answer for r in rows.collect()} == {"answer"} and asked() == questions.count()
    batches = training.in_batches(questions, "doc_id", 4)
    assert batches.filter("batch < 0 OR batch > 3").isEmpty()
    new_answers(questions, docs, folder, 2, model)
    assert spark.read.parquet(folder).count() == questions.count()


def test_sql_functions(spark):
    define_sql_functions(spark)
    row = spark.sql("SELECT question_prompt_of('X') p, questions_of(' [\"a\"] ') q, questions_of('x') n").first()
    assert row.p == training.QUESTION_TEMPLATE.replace("{document}", "X") and row.q == ["a"] and row.n is None
