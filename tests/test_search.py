import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.operators import ranking, terms
from pagequarry.operators.answers import answer_questions, apply_threshold, attach_columns, best_hit
from pagequarry.operators.models import embed, hashed_words, stub_chat_model
from pagequarry.operators.skew import hot_keys, salted_join
from pagequarry.operators.terms import KeywordIndex


def frame(spark, vectors, name):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], f"{name} bigint, vector array<float>")


def brute(questions, vectors, k, metric, digits=6):
    out = []
    for qid, q in enumerate(questions.astype(np.float32).astype(float)):
        scored = []
        for i, v in enumerate(vectors.astype(np.float32).astype(float)):
            if metric == "l2":
                s = 1 / (1 + ((q - v) ** 2).sum())
            else:
                s = q @ v / (np.sqrt(q @ q * (v @ v)) if metric == "cosine" else 1)
            scored.append((-round(s, digits), i))
        out += [(qid, n, i) for n, (_, i) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.fixture(scope="module")
def data():
    random = np.random.default_rng(7)
    vectors = random.normal(size=(300, 8))
    vectors[100:200] = vectors[100]  # a third of the rows are copies
    return random.normal(size=(23, 8)), vectors


def hits_of(df):
    return sorted((r.qid, r["rank"], r.id) for r in df.collect())


@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
def test_exact_in_both_ways(spark, data, metric):
    questions, vectors = data
    q, index = frame(spark, questions, "qid"), frame(spark, vectors, "id").repartition(3)
    expected = brute(questions, vectors, 5, metric)
    scoring = ranking.Dense(metric, values_per_block=500)
    assert hits_of(ranking.nearest(q, index, 5, scoring)) == expected
    blocks = ranking.nearest(q, index, 5, scoring, max_questions=10, question_block=7, index_block=40)
    assert hits_of(blocks) == expected


def test_fewer_candidates_than_k_and_none(spark, data):
    questions, vectors = data
    q, index = frame(spark, questions[:2], "qid"), frame(spark, vectors[:3], "id")
    assert ranking.nearest(q, index, 5).count() == 6
    assert ranking.nearest(q, index.filter("id < 0"), 5).count() == 0
    assert ranking.nearest(q.filter("qid < 0"), index, 5).count() == 0


def test_filter_comes_before_ranking(spark, data):
    questions, vectors = data
    q, index = frame(spark, questions, "qid"), frame(spark, vectors, "id")
    hits = ranking.nearest(q, index, 2, where=F.col("id") >= 290)
    assert hits.count() == 46 and hits.filter("id < 290").isEmpty()


def test_vectors_of_different_length_are_refused(spark):
    q = frame(spark, [[1, 0]], "qid")
    mixed = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "id bigint, vector array<float>").coalesce(1)
    with pytest.raises(Exception, match="differ in length"):
        ranking.nearest(q, mixed, 1).collect()


def test_string_ids(spark):
    q = spark.createDataFrame([("q", [1.0, 0.0])], "qid string, vector array<float>")
    index = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0])], "id string, vector array<float>")
    assert hits_of(ranking.nearest(q, index, 2)) == [("q", 1, "a"), ("q", 2, "b")]


def test_approximate_search(spark):
    random = np.random.default_rng(3)
    centres = random.normal(size=(6, 8)) * 10
    vectors = np.concatenate([c + random.normal(size=(60, 8)) * 0.1 for c in centres])
    questions = vectors[::20] + 0.01
    q, index = frame(spark, questions, "qid"), frame(spark, vectors, "id")
    centroids = ranking.train_centroids(index, 6)
    cells = ranking.assign_cells(index, centroids).cache()
    exact = set(brute(questions, vectors, 3, "l2"))
    everything = ranking.approximate_nearest(q, cells, centroids, 3, probes=6, question_block=5, index_block=25)
    assert set(hits_of(everything)) == exact
    near = set(hits_of(ranking.approximate_nearest(q, cells, centroids, 3, probes=1)))
    recall, scanned = len(near & exact) / len(exact), cells.groupBy("cell").count().agg(F.max("count")).first()[0] / 360
    assert recall >= 0.95 and scanned <= 0.5


@pytest.mark.parametrize("broadcast_terms", [0, 1000])
def test_keyword_search_against_brute_force(spark, monkeypatch, broadcast_terms):
    monkeypatch.setattr("pagequarry.operators.terms.MAX_BROADCAST_TERMS", broadcast_terms)
    texts = ["red fox", "red red dog", "blue dog", "the cat", "red fox", "", "green"]
    asked = ["red dog", "blue cat unknown", "nothing shared"]
    docs = spark.createDataFrame(list(enumerate(texts)), "d bigint, t string")
    questions = spark.createDataFrame(list(enumerate(asked)), "q bigint, t string")
    n = len(texts)
    df = {w: sum(w in t.split() for t in texts) for t in texts for w in t.split()}

    def vector(text):
        weights = {w: text.split().count(w) * np.log((n + 1) / (df.get(w, 0) + 1)) for w in set(text.split())}
        norm = np.sqrt(sum(x * x for x in weights.values()))
        return {w: x / norm for w, x in weights.items()} if norm else {}

    expected = []
    for qid, question in enumerate(asked):
        q = vector(question)
        scores = [(-round(sum(x * vector(t).get(w, 0) for w, x in q.items()), 6), i) for i, t in enumerate(texts)]
        expected += [(qid, r, i) for r, (s, i) in enumerate(sorted(s for s in scores if s[0] < 0)[:3], 1)]
    index = KeywordIndex.build(docs, "d", "t")
    assert hits_of(index.search(questions, "q", "t", 3)) == expected
    assert hits_of(index.search(questions, "q", "t", 3, max_questions=1)) == expected


def test_threshold_keeps_every_question(spark):
    questions = spark.createDataFrame([(1,), (2,), (3,)], "qid bigint")
    hits = spark.createDataFrame([(1, 1, 10, 0.9), (1, 2, 11, 0.7), (2, 1, 12, 0.66)], "qid bigint, rank bigint, id bigint, score double")
    kept = apply_threshold(questions, hits).orderBy("qid", "rank").collect()
    assert [(r.qid, r.id) for r in kept] == [(1, 10), (1, 11), (2, None), (3, None)]
    assert [r.id for r in best_hit(hits).collect()] == [10]


def test_attached_columns_by_both_joins(spark, monkeypatch):
    hits = spark.createDataFrame([(q, 1, 7 if q else 8, 0.5) for q in range(50)], "qid bigint, rank bigint, id bigint, score double")
    docs = spark.createDataFrame([(7, "x"), (8, "y"), (9, "z")], "d bigint, url string")
    small = sorted(map(tuple, attach_columns(hits, docs, "d", "url").collect()))
    monkeypatch.setattr("pagequarry.operators.answers.MAX_BROADCAST_HITS", 0)
    large = attach_columns(hits, docs, "d", "url")
    assert large.columns == ["qid", "rank", "id", "url", "score"]
    assert sorted(map(tuple, large.collect())) == small and len(small) == 50


def test_salted_join_equals_plain_join(spark):
    facts = spark.range(1000).select("id", F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.range(1, 60).select((F.col("id") - 1).alias("k"), F.col("id").alias("v"))
    counts = facts.groupBy("k").agg(F.count("*").alias("n"))
    hot = hot_keys(counts, "k", "n", 1000, share=0.3)
    assert [r.k for r in hot.collect()] == [0]
    for how in ("inner", "left"):
        joined = salted_join(facts, lookup, "k", hot, "id", salts=8, how=how).select("k", "id", "v")
        plain = facts.join(lookup, "k", how).select("k", "id", "v")
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_answers(spark):
    docs = spark.createDataFrame(
        [(1, "billing usage of workspaces", "u1"), (2, "cooking pasta at home", "u2")], "id bigint, content string, url string"
    )
    index = docs.select("id", embed(F.col("content"), hashed_words(256)).alias("vector"))
    questions = spark.createDataFrame([(1, "billing usage of workspaces?"), (2, "quantum")], "qid bigint, question string")
    rows = {r.qid: r for r in answer_questions(questions, index, docs, hashed_words(256), stub_chat_model()).collect()}
    assert '<a href="u1">' in rows[1].answer and "billing usage of workspaces\\n" not in rows[1].answer
    assert "billing usage" in rows[1].prompt and "\n" not in rows[1].answer
    assert "href" not in rows[2].answer and "pasta" not in rows[2].prompt


def test_follow_up_questions_carry_their_history(spark):
    docs = spark.createDataFrame([(1, "red fox", "u")], "id bigint, content string, url string")
    index = docs.select("id", embed(F.col("content"), hashed_words(64)).alias("vector"))
    questions = spark.createDataFrame(
        [(1, "and the fox?", [("user", "hello"), ("assistant", "hi")]), (2, "what?", None)],
        "qid bigint, question string, earlier array<struct<role string, content string>>",
    )
    found = answer_questions(questions, index, docs, hashed_words(64), stub_chat_model(), history="earlier").collect()
    roles = {r.qid: [m["role"] for m in json.loads(r.prompt)] for r in found}
    assert roles == {1: ["system", "user", "assistant", "user"], 2: ["system", "user"]}


@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
def test_recall_on_long_vectors(spark, metric):
    random = np.random.default_rng(11)
    vectors = random.integers(0, 256, (400, 32)).astype(float)
    q, index = frame(spark, vectors[:20], "qid"), frame(spark, vectors, "id")
    exact = brute(vectors[:20], vectors, 10, metric, digits=15)
    for limit in (4096, 1):
        hits = ranking.nearest(q, index, 10, ranking.Dense(metric), max_questions=limit, question_block=7, index_block=90)
        assert set(hits_of(hits)) == set(exact)


def test_score_ties_go_to_the_lower_id(spark):
    q = frame(spark, [[1, 0]], "qid")
    index = frame(spark, [[0, 1]] + [[1, 0]] * 50, "id").repartition(4)
    assert hits_of(ranking.nearest(q, index, 3)) == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]


def test_questions_in_every_form(spark):
    import pandas as pd

    from pagequarry.operators.answers import as_questions

    forms = ["a", ["a"], pd.DataFrame({"q": ["a"], "x": ["b"]}), np.array([["a", "b"]])]
    for form in forms:
        assert [tuple(r) for r in as_questions(spark, form).collect()] == [(0, "a")]


def test_answers_from_contexts(spark):
    from pagequarry.operators.answers import answer_from_contexts

    docs = spark.createDataFrame([(1, "red fox"), (2, "red dog"), (3, "blue sky")], "id bigint, content string")
    index = docs.select("id", embed(F.col("content"), hashed_words(256)).alias("vector"))
    questions = spark.createDataFrame([(1, "red fox")], "qid bigint, question string")

    def model():
        return lambda prompts: [p + f" {p.count('red')} reds\nEND more" for p in prompts]

    row = answer_from_contexts(questions, index, docs, hashed_words(256), model, stops=("END",)).first()
    assert row.sources == ["red fox", "red dog"] and row.answer == "3 reds"
    nothing = answer_from_contexts(questions, index.filter("id < 0"), docs, hashed_words(256), model).first()
    assert nothing.sources == [] and nothing.answer.startswith("1 reds")


@pytest.mark.parametrize("max_broadcast", [0, 1000])
def test_rows_that_share_an_id_have_vectors_of_their_own(spark, max_broadcast):
    rows = [(1, "red fox"), (1, "red red dog"), (1, "red fox"), (None, "blue dog"), (None, "red cat"), (2, ""), (3, None), (4, "the fox")]
    bags = terms.bag_of_words(spark.createDataFrame(rows, "d bigint, t string"), "d", "t")
    vectors = terms.tfidf_vectors(bags, terms.Vocabulary.of(bags, max_broadcast)).collect()
    found = sorted((r.id or 0, sorted(t.term for t in r.vector)) for r in vectors)
    assert found == sorted((d or 0, sorted(set(t.split()))) for d, t in rows if t)
    assert all(abs(sum(t.weight**2 for t in r.vector) - 1) < 1e-9 for r in vectors)
