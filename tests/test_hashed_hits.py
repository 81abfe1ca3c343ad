"""Hashed candidates: the best of them are the hits, and no pair is written."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.operators import signs
from test_screen import brute, frame


@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
def test_hashed_hits_are_the_best_candidates_without_writing_pairs(spark, metric):
    rng = np.random.default_rng(10)
    vectors = rng.normal(size=(400, 8))
    vectors[50:90] = vectors[50]
    index = frame(spark, vectors, "id")
    asked = index.where("id < 120").select(F.col("id").alias("qid"), "vector")
    hits = signs.hashed_nearest(asked, index, 3, metric, tables=2, bits=6)
    assert "Join" not in hits._jdf.queryExecution().executedPlan().toString()
    may = {(r.qid, r.id) for r in signs.candidates(asked, index, 2, 6).collect()}
    assert len(may) < 120 * 400 / 2
    every = {q: [] for q in range(120)}
    for q, _, i in brute(vectors[:120], vectors, 400, metric):
        if (q, i) in may:
            every[q].append(i)
    expected = sorted((q, n, i) for q, ids in every.items() for n, i in enumerate(ids[:3], 1))
    assert sorted((r.qid, r.rank, r.id) for r in hits.collect()) == expected
