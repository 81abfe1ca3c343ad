"""Sign-projection candidates: recall against the exact search, share of pairs scored, no lost bucket rows."""

import numpy as np
from pyspark.sql import functions as F

from pagequarry.operators import ranking, signs


def test_recall_on_clustered_vectors(spark):
    rng = np.random.default_rng(21)
    centres = rng.normal(scale=4, size=(8, 16))
    vectors = centres[rng.integers(0, 8, 800)] + rng.normal(size=(800, 16))
    vectors[100:160] = vectors[100]  # a large bucket of copies
    index = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id bigint, vector array<float>")
    questions = index.select(F.col("id").alias("qid"), "vector")
    found = {(r.qid, r.id) for r in ranking.without_self(signs.hashed_nearest(questions, index, 4), 3).collect()}
    exact = {(r.qid, r.id) for r in ranking.without_self(ranking.nearest(questions, index, 4), 3).collect()}
    recall = len(found & exact) / len(exact)
    share = signs.candidate_share(questions, index)
    print(f"recall {recall:.3f}, share of pairs scored {share:.3f}")
    assert recall >= 0.9 and share < 1.0
    # Copies share every code: each finds the others, none is cut off.
    copies = {(q, i) for q, i in found if 100 <= q < 160}
    assert all(100 <= i < 160 for _, i in copies) and len(copies) == 60 * 3


def test_scores_equal_the_exact_ones(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(60, 5))
    index = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id bigint, vector array<float>")
    questions = index.select(F.col("id").alias("qid"), "vector")
    hashed = {(r.qid, r.id): r.score for r in signs.hashed_nearest(questions, index, 60).collect()}
    exact = {(r.qid, r.id): r.score for r in ranking.nearest(questions, index, 60).collect()}
    assert hashed and all(exact[pair] == score for pair, score in hashed.items())
    empty = spark.createDataFrame([], "qid bigint, vector array<float>")
    assert signs.hashed_nearest(empty, index, 3).count() == 0
