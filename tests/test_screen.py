"""Single precision rules pairs out and decides none; passes and cells do not multiply with small blocks."""

import numpy as np
import pytest

from pagequarry.operators import ranking


def frame(spark, vectors, name):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], f"{name} bigint, vector array<float>")


def brute(questions, vectors, k, metric):
    q, v = (np.asarray(x, np.float32).astype(float) for x in (questions, vectors))
    if metric == "l2":
        scores = 1 / (1 + ((q[:, None, :] - v[None, :, :]) ** 2).sum(axis=2))
    else:
        scores = np.einsum("id,jd->ij", q, v)
        if metric == "cosine":
            scores = scores / np.sqrt((q**2).sum(axis=1)[:, None] * (v**2).sum(axis=1)[None, :])
    scores = ranking.significant(scores)
    return sorted((i, n, j) for i, row in enumerate(scores) for n, j in enumerate(sorted(range(len(v)), key=lambda j: (-row[j], j))[:k], 1))


@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
def test_differences_below_single_precision_decide(spark, metric):
    rng = np.random.default_rng(6)
    # Far from the origin the keys of all pairs are equal in single precision.
    vectors = 3000 + np.round(rng.normal(size=(700, 5)) * 64) / 1024
    vectors[40:300] = vectors[40]
    index, asked = frame(spark, vectors, "id"), frame(spark, vectors[30:60], "qid")
    found = ranking.nearest(asked, index, 4, ranking.Dense(metric, values_per_block=3000), max_questions=5, question_block=7)
    assert sorted((r.qid, r.rank, r.id) for r in found.collect()) == brute(vectors[30:60], vectors, 4, metric)


def test_values_beyond_single_precision(spark):
    vectors = np.random.default_rng(7).normal(size=(300, 3)) * 1e25
    index, asked = frame(spark, vectors, "id"), frame(spark, vectors[:9], "qid")
    found = ranking.nearest(asked, index, 2, ranking.Dense("cosine"))
    assert sorted((r.qid, r.rank, r.id) for r in found.collect()) == brute(vectors[:9], vectors, 2, "cosine")


def test_small_question_blocks_share_a_pass(spark):
    rng = np.random.default_rng(8)
    index, asked = frame(spark, rng.normal(size=(80, 4)), "id"), frame(spark, rng.normal(size=(60, 4)), "qid")
    plan = ranking.nearest_in_turn(asked, index, 2, block_rows=4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_an_index_is_not_copied_for_every_small_question_block(spark, monkeypatch):
    rng = np.random.default_rng(9)
    index, asked = frame(spark, rng.normal(size=(80, 4)), "id"), frame(spark, rng.normal(size=(60, 4)), "qid")
    centroids = rng.normal(size=(3, 4))
    copies, cells = [], ranking._score_cells
    monkeypatch.setattr(ranking, "_score_cells", lambda left, right, *a: copies.append(right.count()) or cells(left, right, *a))
    found = ranking.approximate_nearest(asked, ranking.assign_cells(index, centroids), centroids, 2, probes=3, question_block=4)
    assert copies == [80]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, ranking.nearest(asked, index, 2).collect()))
