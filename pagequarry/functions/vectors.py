"""Vector expressions and the numpy scores used inside search tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("l2", "cosine", "dot")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def checked_vector(vector: Column, dimension: int) -> Column:
    """``vector``, or a failed job when its length is not ``dimension``."""
    message = F.concat(F.lit(f"expected {dimension} dimensions, found "), F.size(vector).cast("string"))
    return F.when(F.size(vector) == dimension, vector).otherwise(F.raise_error(message).cast("array<float>"))


def score_matrix(questions: np.ndarray, vectors: np.ndarray, metric: str) -> np.ndarray:
    """Scores, higher is better, one row per question and one column per vector."""
    products = questions @ vectors.T
    if metric == "dot":
        return products
    q_norm = np.einsum("ij,ij->i", questions, questions)[:, None]
    v_norm = np.einsum("ij,ij->i", vectors, vectors)[None, :]
    if metric == "cosine":
        scale = np.sqrt(q_norm * v_norm)
        return np.divide(products, scale, out=np.zeros_like(products), where=scale > 0)
    distance = np.maximum(q_norm + v_norm - 2.0 * products, 0.0)
    return 1.0 / (1.0 + distance)


def vector_sum(vector: Column) -> Column:
    """A vector's values weighed by position, so that a stale or wrong vector shows."""
    weighed = F.transform(vector, lambda x, at: x.cast("double") * (at + 1))
    return F.round(F.aggregate(weighed, F.lit(0.0), lambda total, x: total + x), 6)
