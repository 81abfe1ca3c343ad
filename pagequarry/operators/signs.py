"""Approximate nearest neighbours by sign random projections: hashed candidates, exact re-ranking.

Every vector gets, for each of ``tables`` tables, a code of ``bits`` bits:
bit j of table t is 1 when the vector's dot product with Gaussian plane
(t, j), drawn from a fixed seed, is positive; vectors are taken relative to
the index mean. Vectors close in angle around the mean share most bits.

A question probes, in every table, its own code and the ``bits`` codes one
bit away from it (multi-probe). Candidates are the index rows whose code
matches a probe in any table. Only candidates are kept, the best ``k`` by the
same metric as ``ranking.nearest``, scored exactly, ties to the lower id.
There is no cap on a bucket: copies and common directions make large
buckets, and all their rows are candidates. ``candidate_share`` reports the
share of all (question, row) pairs that are candidates; recall is measured
against the exact search in the tests.

``hashed_nearest`` never writes a pair: with 48 tables of 10 bits nearly half
of all pairs are candidates, whose equi-join on (table, code) grows with the
square of the rows. The index streams past the questions as in
``ranking.nearest``, every vector with its codes; a pair whose single precision
score can still reach the question's best ``k`` is a hit only if its codes meet.
The work is therefore that of the exact search, and the disk that of its hits.
``candidates`` makes the pairs themselves, to count them on small sets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.operators.ranking import Dense, nearest

TABLES = 48
BITS = 10

SEED = 20240611
# Vectors whose codes are made at a time.
CODED_ROWS = 1024


def planes(tables: int, bits: int, dimension: int, seed: int = SEED) -> np.ndarray:
    """Gaussian planes, ``tables x bits x dimension``, the same in every task for one seed."""
    return np.random.default_rng(seed).normal(size=(tables, bits, dimension))


def code_matrix(vectors: np.ndarray, centre: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """The code of each vector (row) less ``centre`` in each table (column)."""
    signs = planes(tables, bits, vectors.shape[1])  # tables x bits x dimension
    values = np.zeros((len(vectors), tables), np.int64)
    for at in range(0, len(vectors), CODED_ROWS):
        part = vectors[at : at + CODED_ROWS] - centre[None, :]
        positive = np.einsum("nd,tjd->ntj", part, signs) > 0
        values[at : at + CODED_ROWS] = (positive.astype(np.int64) << np.arange(bits, dtype=np.int64)).sum(axis=2)
    return values


def codes(vector: Column, centre: np.ndarray, tables: int = TABLES, bits: int = BITS) -> Column:
    """``array<bigint>``: the code in each table of the vector less ``centre``."""

    @F.arrow_udf("array<bigint>")
    def code(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.list_(pa.int64()))
        values = code_matrix(Dense().load(column), centre, tables, bits)
        offsets = pa.array(np.arange(len(column) + 1, dtype=np.int32) * tables)
        return pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1)))

    return code(vector)


def centre_of(index: DataFrame) -> np.ndarray:
    """Mean of the index vectors, one value per dimension, summed over all rows."""
    width = index.select(F.size("vector").alias("n")).agg(F.max("n")).first()[0] or 0
    if not width:
        return np.zeros(0)
    sums = index.agg(*(F.avg(F.col("vector")[d].cast("double")).alias(f"d{d}") for d in range(width))).first()
    return np.array([sums[f"d{d}"] or 0.0 for d in range(width)], np.float64)


def _entries(df: DataFrame, key: str, centre: np.ndarray, tables: int, bits: int) -> DataFrame:
    return df.select(key, F.posexplode(codes(F.col("vector"), centre, tables, bits)).alias("table", "code"))


def candidates(questions: DataFrame, index: DataFrame, tables: int = TABLES, bits: int = BITS, centre: np.ndarray | None = None) -> DataFrame:
    """Distinct ``qid, id`` of rows sharing a probed code with the question in some table.

    Vectors are taken relative to ``centre`` (default: the index mean), so that
    directions around the data, not from the origin, decide the bits.
    """
    centre = centre_of(index) if centre is None else centre
    flips = F.array(F.lit(0).cast("bigint"), *(F.lit(1 << j).cast("bigint") for j in range(bits)))
    probes = _entries(questions, "qid", centre, tables, bits).select(
        "qid", "table", F.explode(F.transform(flips, lambda flip: F.col("code").bitwiseXOR(flip))).alias("code")
    )
    return probes.join(_entries(index, "id", centre, tables, bits), ["table", "code"]).select("qid", "id").distinct()


@dataclass(frozen=True, eq=False)
class Hashed(Dense):
    """Vectors scored as :class:`Dense`, among the pairs whose codes meet in some table."""

    centre: np.ndarray | None = None
    tables: int = TABLES
    bits: int = BITS

    def marks(self, vectors: np.ndarray) -> np.ndarray:
        return code_matrix(vectors, self.centre, self.tables, self.bits).astype(np.int16 if self.bits < 15 else np.int64)

    def admitted(self, questions: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        apart = questions ^ vectors
        # At most one bit differs: the code itself or a probe one bit away.
        return ((apart & (apart - 1)) == 0).any(axis=1)


def hashed_nearest(
    questions: DataFrame, index: DataFrame, k: int, metric: str = "l2", tables: int = TABLES, bits: int = BITS
) -> DataFrame:
    """``qid, rank, id, score``: the best ``k`` candidates of each question, scored exactly; null keys are left out."""
    questions = questions.select("qid", "vector").where(F.col("qid").isNotNull())
    index = index.select("id", "vector")
    scoring = Hashed(metric, centre=centre_of(index), tables=tables, bits=bits)
    return nearest(questions, index.where(F.col("id").isNotNull()), k, scoring)


def candidate_share(questions: DataFrame, index: DataFrame, tables: int = TABLES, bits: int = BITS) -> float:
    """Candidate pairs over all (question, row) pairs."""
    scored = candidates(questions, index, tables, bits).count()
    return scored / max(1, questions.count() * index.count())
