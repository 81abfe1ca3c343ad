"""Question blocks taken in turn: exact, the index never shuffled."""

import numpy as np
import pytest

from pagequarry.operators import ranking


def frame(spark, vectors, name):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], f"{name} bigint, vector array<float>")


def brute(questions, vectors, k, metric):
    out = []
    for qid, q in enumerate(questions.astype(np.float32).astype(float)):
        scored = []
        for i, v in enumerate(vectors.astype(np.float32).astype(float)):
            s = 1 / (1 + ((q - v) ** 2).sum()) if metric == "l2" else q @ v / np.sqrt(q @ q * (v @ v))
            scored.append((-round(s, 6), i))
        out += [(qid, n, i) for n, (_, i) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_blocks_in_turn_are_exact(spark, metric):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(250, 6))
    vectors[50:120] = vectors[50]  # many equal scores
    questions = rng.normal(size=(41, 6))
    index, asked = frame(spark, vectors, "id"), frame(spark, questions, "qid")
    found = ranking.nearest_in_turn(asked, index, 3, ranking.Dense(metric), block_rows=7, block_values=10_000)
    assert sorted((r.qid, r.rank, r.id) for r in found.collect()) == brute(questions, vectors, 3, metric)
    through = ranking.nearest(asked, index, 3, ranking.Dense(metric), max_questions=5, question_block=9)
    assert sorted(map(tuple, through.collect())) == sorted(map(tuple, found.collect()))


def test_the_index_is_never_shuffled(spark):
    rng = np.random.default_rng(4)
    index, asked = frame(spark, rng.normal(size=(80, 4)), "id"), frame(spark, rng.normal(size=(30, 4)), "qid")
    plan = ranking.nearest_in_turn(asked, index, 2, block_rows=4)._jdf.queryExecution().executedPlan().toString()
    # One exchange only: the ranking of the hits by question.
    assert plan.count("Exchange") - plan.count("ReusedExchange") <= 1 + plan.count("BroadcastExchange")
    assert "hashpartitioning(qid" in plan and "hashpartitioning(id" not in plan


def test_empty_questions_and_index(spark):
    empty = spark.createDataFrame([], "qid bigint, vector array<float>")
    index = frame(spark, np.ones((3, 2)), "id")
    assert ranking.nearest_in_turn(empty, index, 2).count() == 0
    assert ranking.nearest_in_turn(frame(spark, np.ones((3, 2)), "qid"), index.limit(0), 2).count() == 0
