"""Exact and approximate top-k search.

Every question is scored against every candidate inside tasks, block by
block, and a task emits only its own best k per question, so pairs are never
materialised. Dense vectors are compared in single precision first: a pair
whose score, with the largest rounding error it can have, stays below the
question's k-th is left; the others are scored in double precision. A question
set of checked size travels to the index; of a larger one, a bounded part at a
time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.functions.vectors import score_matrix
from pagequarry.session import materialise, new_folder

# Scores are ranked at so many significant digits, so that noise in the last bits decides no tie.
SCORE_DIGITS = 9
MAX_BROADCAST_QUESTIONS = 4096
MAX_BROADCAST_VALUES = 8_000_000
QUESTION_BLOCK = 2048
INDEX_BLOCK = 50_000
# Vector values of the questions that one pass over the index, or one task of a cell, holds.
PASS_VALUES = 2_000_000
# Index rows met first, while a question has no k-th score yet; then twice as many each time.
FIRST_ROWS = 128
# Pairs scored in double precision at a time.
PAIRS = 65_536


def significant(values: np.ndarray, digits: int = SCORE_DIGITS) -> np.ndarray:
    """``values`` at ``digits`` significant digits, however large or small they are."""
    size = np.zeros(values.shape)
    np.log10(np.abs(values), out=size, where=values != 0)
    scale = 10.0 ** (digits - 1 - np.floor(size))
    return np.round(values * scale) / scale + 0.0


class BestK:
    """Running best k candidates of several questions, ties going to the lower id."""

    def __init__(self, questions: int, k: int):
        self.k = k
        self.question = np.zeros(0, np.int64)
        self.score = np.zeros(0)
        self.id: np.ndarray | None = None
        self.floor = np.full(questions, -np.inf)

    def add(self, scores: np.ndarray, ids: np.ndarray, positive_only: bool = False) -> None:
        bound = self.floor
        if scores.shape[1] > self.k:
            local = -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1]
            bound = np.maximum(bound, local)
        # A little below the bound, as scores are compared at SCORE_DIGITS digits afterwards.
        wanted = scores >= (bound - np.where(np.isfinite(bound), np.abs(bound), 0.0) * 10.0 ** (2 - SCORE_DIGITS))[:, None]
        if positive_only:
            wanted &= scores > 0
        q, column = np.nonzero(wanted)
        self.merge(q, ids[column], significant(scores[q, column]))

    def merge(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Take in pairs, by question number, whose scores are rounded already."""
        if not len(q):
            return
        question = np.concatenate([self.question, q])
        score = np.concatenate([self.score, scores])
        id_ = ids if self.id is None else np.concatenate([self.id, ids])
        order = np.lexsort((id_, -score, question))
        question, score, id_ = question[order], score[order], id_[order]
        first = np.searchsorted(question, question)
        position = np.arange(len(question)) - first
        kept = position < self.k
        self.question, self.score, self.id = question[kept], score[kept], id_[kept]
        full = position == self.k - 1
        self.floor[question[full]] = score[full]


@dataclass(frozen=True)
class Dense:
    """Vectors as ``array<float>``, all of one length."""

    metric: str = "l2"
    values_per_block: int = 4_000_000

    positive_only = False

    def load(self, column: pa.Array):
        lengths = pc.list_value_length(column)
        width = lengths[0].as_py() if len(lengths) else 0
        if len(lengths) and (lengths.null_count or pc.min_max(lengths).as_py() != {"min": width, "max": width}):
            raise ValueError("vectors differ in length")
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)

    def blocks(self, questions, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        if not len(questions):
            return
        vectors = self.load(column)
        step = max(1, self.values_per_block // max(len(questions), vectors.shape[1], 1))
        for start in range(0, len(vectors), step):
            yield start, score_matrix(questions, vectors[start : start + step], self.metric)

    def marks(self, vectors: np.ndarray) -> np.ndarray | None:
        """What :meth:`admitted` compares, one row per vector; None admits every pair."""
        return None

    def admitted(self, questions: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Whether the pairs of these marks, row by row, may be hits."""
        raise NotImplementedError


def pair_scores(questions: np.ndarray, vectors: np.ndarray, metric: str) -> np.ndarray:
    """The scores of :func:`score_matrix`, pair by pair."""
    if metric == "l2":
        apart = questions - vectors
        return 1.0 / (1.0 + np.einsum("ij,ij->i", apart, apart))
    products = np.einsum("ij,ij->i", questions, vectors)
    if metric == "dot":
        return products
    scale = np.sqrt(np.einsum("ij,ij->i", questions, questions) * np.einsum("ij,ij->i", vectors, vectors))
    return np.divide(products, scale, out=np.zeros_like(products), where=scale > 0)


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


class _Screen:
    """A block of questions whose best ``k`` grow while index vectors pass.

    The key of a pair grows with its score: the product less half the squared
    length of the vector (l2), the product with the vector at unit length
    (cosine), or the product (dot). Keys are made in single precision.
    """

    def __init__(self, vectors: np.ndarray, marks: np.ndarray | None, scoring: Dense, k: int):
        self.vectors, self.marks, self.scoring, self.k = vectors, marks, scoring, k
        self.best = BestK(len(vectors), k)
        self.norm = _norms(vectors)
        self.single = self._single(vectors, np.ones(len(vectors)))

    @staticmethod
    def _single(vectors: np.ndarray, last: np.ndarray) -> np.ndarray:
        return np.concatenate([vectors, last[:, None]], axis=1).astype(np.float32)

    def safe(self, largest: float) -> bool:
        """Whether no single precision value can overflow, and none is missing."""
        return bool(max(self.norm.max(initial=0.0), largest) < 1e15)

    def add(self, ids: np.ndarray, vectors: np.ndarray, norm: np.ndarray, single: np.ndarray, marks: np.ndarray | None) -> None:
        most = max(FIRST_ROWS, self.scoring.values_per_block // max(len(self.vectors), 1))
        start, step = 0, FIRST_ROWS
        while start < len(vectors):
            rows = slice(start, min(start + (most if np.isfinite(self.best.floor).all() else min(step, most)), len(vectors)))
            part = None if marks is None else marks[rows]
            self._add(ids[rows], vectors[rows], norm[rows], single[rows], part)
            start, step = rows.stop, 2 * step

    def _add(self, ids, vectors, norm, single, marks) -> None:
        metric, floor = self.scoring.metric, self.best.floor
        keys = self.single @ single.T
        largest = 1.0 if metric == "cosine" else float(norm.max(initial=0.0))
        # Twice the rounding error a sum of so many single precision products can have.
        reach = self.norm * largest + (largest * largest / 2 if metric == "l2" else 0.0)
        error = (self.vectors.shape[1] + 8) * 2.0**-23 * reach + 1e-30
        if marks is None and len(vectors) > self.k and not np.isfinite(floor).all():
            kth = np.partition(keys, len(vectors) - self.k, axis=1)[:, len(vectors) - self.k] - error
            floor = np.maximum(floor, self._score(kth))
        wanted = keys >= (self._key(floor) - error)[:, None]
        q, column = np.divmod(np.flatnonzero(wanted), len(vectors))
        for at in range(0, len(q), PAIRS):
            self._take(q[at : at + PAIRS], column[at : at + PAIRS], ids, vectors, marks)

    def _take(self, q, column, ids, vectors, marks) -> None:
        if marks is not None:
            may = self.scoring.admitted(self.marks[q], marks[column])
            q, column = q[may], column[may]
        scores = significant(pair_scores(self.vectors[q], vectors[column], self.scoring.metric))
        kept = scores >= self.best.floor[q]
        self.best.merge(q[kept], ids[column[kept]], scores[kept])

    def _score(self, key: np.ndarray) -> np.ndarray:
        """The score of a key of each question."""
        if self.scoring.metric == "l2":
            return 1.0 / (1.0 + np.maximum(self.norm**2 - 2.0 * key, 0.0))
        if self.scoring.metric == "cosine":
            return np.divide(key, self.norm, out=np.zeros_like(key), where=self.norm > 0)
        return key

    def _key(self, score: np.ndarray) -> np.ndarray:
        """The least key of scores that equal ``score`` or more at ``SCORE_DIGITS`` digits."""
        least = score - np.where(np.isfinite(score), np.abs(score), 0.0) * 10.0 ** (2 - SCORE_DIGITS)
        if self.scoring.metric == "l2":
            with np.errstate(divide="ignore"):
                apart = np.where(least > 0, 1.0 / np.maximum(least, 0.0) - 1.0, np.inf)
            return (self.norm**2 - apart) / 2.0
        if self.scoring.metric == "cosine":
            return np.where(np.isfinite(least), least, 0.0) * self.norm + np.where(np.isfinite(least), 0.0, -np.inf)
        return least


class _DenseSearch:
    """The best ``k`` of a question set, ``rows`` questions at a time, while index vectors pass."""

    def __init__(self, scoring: Dense, questions: pa.Array, k: int, rows: int):
        vectors, self.scoring = scoring.load(questions), scoring
        self.starts = range(0, len(vectors), rows)
        marks = scoring.marks(vectors) if len(vectors) else None
        self.screens = [
            _Screen(vectors[at : at + rows], None if marks is None else marks[at : at + rows], scoring, k)
            for at in self.starts
        ]

    def add(self, ids: pa.Array, column: pa.Array) -> None:
        if not self.screens or not len(column):
            return
        keys, vectors = _numpy_ids(ids), self.scoring.load(column)
        norm, marks = _norms(vectors), self.scoring.marks(vectors)
        largest = norm.max() if np.isfinite(norm).all() else np.inf
        if self.scoring.metric == "l2":
            single = _Screen._single(vectors, norm**2 / -2.0) if largest < 1e15 else None
        else:
            scale = np.where(norm > 0, norm, 1.0)[:, None] if self.scoring.metric == "cosine" else 1.0
            single = _Screen._single(vectors / scale, np.zeros(len(vectors))) if largest < 1e15 else None
        for screen in self.screens:
            if screen.safe(largest):
                screen.add(keys, vectors, norm, single, marks)
            elif marks is None:
                for start, scores in self.scoring.blocks(screen.vectors, column):
                    screen.best.add(scores, keys[start : start + scores.shape[1]])
            else:
                every = np.arange(len(screen.vectors) * len(vectors))
                for at in range(0, len(every), PAIRS):
                    screen._take(*np.divmod(every[at : at + PAIRS], len(vectors)), keys, vectors, marks)

    def found(self) -> BestK:
        """What was found, under the questions' numbers in the whole set."""
        out = BestK(0, 0)
        held = [(at, screen.best) for at, screen in zip(self.starts, self.screens) if screen.best.id is not None]
        if held:
            out.question = np.concatenate([best.question + at for at, best in held])
            out.score = np.concatenate([best.score for _, best in held])
            out.id = np.concatenate([best.id for _, best in held])
        return out


@dataclass(frozen=True)
class Sparse:
    """Weighted terms as ``array<struct<term, weight>>``, scored by their dot product."""

    values_per_block: int = 100_000

    positive_only = True

    def load(self, column: pa.Array):
        row, term, weight = _postings(column)
        coded = term.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(codes, kind="stable")
        starts = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
        return _TermTable(len(column), coded.dictionary, starts, row[order], weight[order])

    def blocks(self, questions, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        if not len(questions):
            return
        row, term, weight = _postings(column)
        code = pc.index_in(term, value_set=questions.terms)
        known = pc.is_valid(code).to_numpy(zero_copy_only=False)
        row, weight = row[known], weight[known]
        code = code.drop_null().to_numpy(zero_copy_only=False)
        step = max(1, min(512, self.values_per_block // max(questions.size, 1)))
        for start in range(0, len(column), step):
            stop = min(start + step, len(column))
            lo, hi = np.searchsorted(row, [start, stop])
            first, last = questions.starts[code[lo:hi]], questions.starts[code[lo:hi] + 1]
            repeat = last - first
            total = int(repeat.sum())
            base = np.repeat(first - np.concatenate([[0], np.cumsum(repeat)[:-1]]), repeat) if total else first[:0]
            at = base + np.arange(total)
            cell = questions.question[at] * (stop - start) + np.repeat(row[lo:hi] - start, repeat)
            value = questions.weight[at] * np.repeat(weight[lo:hi], repeat)
            scores = np.bincount(cell, value, questions.size * (stop - start))
            yield start, scores.reshape(questions.size, stop - start)


@dataclass(frozen=True)
class _TermTable:
    """Question weights grouped by term: those of term ``t`` are ``starts[t]`` to ``starts[t + 1]``."""

    size: int
    terms: pa.Array
    starts: np.ndarray
    question: np.ndarray
    weight: np.ndarray

    def __len__(self) -> int:
        return self.size


def _postings(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    row = np.repeat(np.arange(len(column)), lengths.astype(np.int64))
    term, weight = flat.field("term"), flat.field("weight")
    return row, term, weight.to_numpy(zero_copy_only=False)


Scoring = Dense | Sparse


def _local_schema(questions: DataFrame, index: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("qid", questions.schema["qid"].dataType),
            T.StructField("id", index.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _numpy_ids(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _add_block(best: BestK, scoring: Scoring, questions, ids: pa.Array, vectors: pa.Array) -> None:
    keys = _numpy_ids(ids)
    for start, scores in scoring.blocks(questions, vectors):
        best.add(scores, keys[start : start + scores.shape[1]], scoring.positive_only)


def _emit(best: BestK, qids: pa.Array, qid_type: pa.DataType, id_type: pa.DataType) -> pa.Table:
    ids = best.id if best.id is not None else []
    return pa.table(
        {
            "qid": qids.take(pa.array(best.question)).cast(qid_type),
            "id": pa.array(ids, id_type),
            "score": pa.array(best.score, pa.float64()),
        }
    )


def _one_array(column: pa.ChunkedArray) -> pa.Array:
    merged = column.combine_chunks()
    return merged.combine_chunks() if isinstance(merged, pa.ChunkedArray) else merged


def _scan_index(questions: pa.Table, scoring: Scoring, k: int, rows: int = QUESTION_BLOCK) -> Callable:
    """Task function: stream the index past a question set held in memory, ``rows`` questions scored at a time."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids = _one_array(questions.column("qid"))
        vectors, id_type = _one_array(questions.column("vector")), None
        if isinstance(scoring, Dense):
            search = _DenseSearch(scoring, vectors, k, rows)
            for batch in batches:
                id_type = batch.column("id").type
                search.add(batch.column("id"), batch.column("vector"))
            best = search.found()
        else:
            loaded, best = scoring.load(vectors), BestK(len(qids), k)
            for batch in batches:
                id_type = batch.column("id").type
                _add_block(best, scoring, loaded, batch.column("id"), batch.column("vector"))
        if best.id is not None:
            yield from _emit(best, qids, qids.type, id_type).to_batches()

    return scan


def _score_cell(scoring: Dense, k: int, rows: int) -> Callable:
    """Task function: one block of questions against one block of the index, ``rows`` questions scored at a time."""

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        qids = _one_array(left.column("qid"))
        best = BestK(len(qids), k)
        if len(left) and len(right):
            search = _DenseSearch(scoring, _one_array(left.column("vector")), k, rows)
            search.add(_one_array(right.column("id")), _one_array(right.column("vector")))
            best = search.found()
        return _emit(best, qids, qids.type, right.schema.field("id").type)

    return score


def rank(local: DataFrame, k: int) -> DataFrame:
    """Best ``k`` per question, numbered from 1."""
    order = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc("id"))
    return (
        local.withColumn("rank", F.row_number().over(order).cast("bigint"))
        .filter(F.col("rank") <= k)
        .select("qid", "rank", "id", "score")
    )


def without_self(hits: DataFrame, k: int) -> DataFrame:
    """Drop a question's own row from its best ``k + 1``, keeping ``k``."""
    return rank(hits.filter(F.col("qid") != F.col("id")).select("qid", "id", "score"), k)


def fits_broadcast(
    questions: DataFrame, max_questions: int = MAX_BROADCAST_QUESTIONS, max_values: int = MAX_BROADCAST_VALUES
) -> bool:
    """Whether rows and vector values of ``questions`` stay below both bounds."""
    seen = questions.limit(max_questions + 1).agg(F.count("*").alias("n"), F.sum(F.size("vector")).alias("values")).first()
    return seen.n <= max_questions and (seen["values"] or 0) <= max_values


def nearest(
    questions: DataFrame,
    index: DataFrame,
    k: int,
    scoring: Scoring = Dense(),
    where: Column | None = None,
    max_questions: int = MAX_BROADCAST_QUESTIONS,
    question_block: int = QUESTION_BLOCK,
    index_block: int = INDEX_BLOCK,
) -> DataFrame:
    """Exact best ``k`` of ``index (id, vector)`` for each of ``questions (qid, vector)``.

    ``where`` filters the index before ranking. Returns ``qid, rank, id, score``.
    The questions are evaluated once and written; a set beyond ``max_questions``
    goes to :func:`nearest_in_turn`, scored ``question_block`` rows at a time.
    ``index_block`` is no longer used here: the index is never divided.
    """
    if where is not None:
        index = index.filter(where)
    index = index.select("id", "vector")
    # Written once, so that vectors made by a model are made once.
    questions = materialise(questions.select("qid", "vector"), "questions")
    if fits_broadcast(questions, max_questions):
        schema = _local_schema(questions, index)
        local = index.mapInArrow(_scan_index(questions.toArrow(), scoring, k, question_block), schema)
        return rank(local, k)
    return nearest_in_turn(questions, index, k, scoring, question_block)


def nearest_in_turn(
    questions: DataFrame,
    index: DataFrame,
    k: int,
    scoring: Scoring = Dense(),
    block_rows: int = QUESTION_BLOCK,
    block_values: int = MAX_BROADCAST_VALUES,
) -> DataFrame:
    """Exact best ``k`` for a question set of any size, without moving the index.

    Questions are dealt by a hash of ``qid`` into passes, and written once, by
    pass. Each pass is broadcast to a scan of the index, whose tasks stream
    their part of the index past it and keep the best ``k`` per question. The
    index is read once per pass and never shuffled, nor is any question copied;
    the passes' results are ranked together. Dense questions fill a pass up to
    ``PASS_VALUES`` vector values, and are scored ``block_rows`` at a time
    inside it: passes, and with them the tasks and files the driver hears of,
    do not multiply with small blocks. Sparse ones are dealt by ``block_rows``
    rows and ``block_values`` values.
    """
    spark = questions.sparkSession
    questions = questions.select("qid", "vector")
    schema = _local_schema(questions, index)
    size = questions.agg(F.count("*").alias("n"), F.sum(F.size("vector")).alias("values")).first()
    values = size["values"] or 0
    if isinstance(scoring, Dense):
        blocks = max(1, min(math.ceil(size.n / block_rows), math.ceil(values / min(block_values, PASS_VALUES))))
    else:
        blocks = max(1, math.ceil(size.n / block_rows), math.ceil(values / block_values))
    folder = new_folder(spark, "question-blocks")
    dealt = questions.withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(blocks)))
    # One task writes a pass, so there are as many files as passes.
    dealt.repartition("block").write.partitionBy("block").parquet(folder)
    stored = spark.read.schema(questions.schema.add("block", T.IntegerType())).parquet(folder)
    found = None
    for block in range(blocks):
        held = stored.where(F.col("block") == block).select("qid", "vector").toArrow()
        local = index.mapInArrow(_scan_index(held, scoring, k, block_rows), schema)
        found = local if found is None else found.unionByName(local)
    return rank(found, k)


def _numbers(n: Column) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1)


def _score_cells(left, right, keys, scoring, k, schema, rows) -> DataFrame:
    # Fresh column identities, since both sides may stem from the same table.
    left = left.select(*[F.col(name).alias(name) for name in left.columns])
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_score_cell(scoring, k, rows), schema)


# ---- approximate search -------------------------------------------------


def train_centroids(index: DataFrame, n: int, seed: int = 1, iterations: int = 10) -> np.ndarray:
    """``n`` cluster centres of the index vectors; the driver receives only the centres."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    model = KMeans(k=n, seed=seed, maxIter=iterations).fit(
        index.select(array_to_vector(F.col("vector").cast("array<double>")).alias("features"))
    )
    return np.array(model.clusterCenters())


def nearest_cells(vector: Column, centroids: np.ndarray, probes: int = 1) -> Column:
    """Numbers of the ``probes`` closest centres, closest first."""
    scoring = Dense("l2")

    @F.arrow_udf("array<bigint>")
    def cells(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.list_(pa.int64()))
        scores = score_matrix(scoring.load(column), centroids, "l2")
        best = np.argsort(-scores, axis=1, kind="stable")[:, :probes].astype(np.int64)
        offsets = np.arange(len(column) + 1, dtype=np.int32) * best.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(best.reshape(-1)))

    return cells(vector)


def assign_cells(index: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``index`` with the number of each vector's closest centre as ``cell``."""
    return index.withColumn("cell", F.element_at(nearest_cells(F.col("vector"), centroids), 1))


def approximate_nearest(
    questions: DataFrame,
    celled_index: DataFrame,
    centroids: np.ndarray,
    k: int,
    probes: int,
    metric: str = "l2",
    question_block: int = QUESTION_BLOCK,
    index_block: int = INDEX_BLOCK,
) -> DataFrame:
    """Best ``k`` among the vectors in each question's ``probes`` closest cells.

    Probing every cell gives the exact answer. A cell with many vectors, or one
    that many questions probe, is divided into blocks, so a popular cell is
    shared by several tasks. Only vectors of probed cells are shuffled, once
    for every ``PASS_VALUES`` vector values of questions that probe their cell;
    inside a task ``question_block`` questions are scored at a time.
    """
    questions = questions.select("qid", "vector")
    probed = materialise(
        questions.withColumn("cell", F.explode(nearest_cells(F.col("vector"), centroids, probes))), "probed-cells"
    )
    return probed_nearest(probed, celled_index, len(centroids), k, metric, question_block, index_block)


def probed_nearest(
    probed: DataFrame,
    celled_index: DataFrame,
    cells: int,
    k: int,
    metric: str = "l2",
    question_block: int = QUESTION_BLOCK,
    index_block: int = INDEX_BLOCK,
) -> DataFrame:
    """Best ``k`` of each question among the vectors of the cells it is paired with in ``probed (qid, vector, cell)``."""
    schema = _local_schema(probed.select("qid", "vector"), celled_index)
    sizes = F.broadcast(
        celled_index.groupBy("cell").count()
        .withColumn("cell", F.when(F.col("cell") < cells, F.col("cell")).otherwise(F.raise_error(F.lit("cells of another training")).cast("bigint")))
        .select("cell", F.ceil(F.col("count") / index_block).alias("parts"))
    )
    # One row per centre at most, as ``sizes``.
    probes_of = F.broadcast(
        probed.groupBy("cell").agg(F.count("*").alias("count"), F.sum(F.size("vector")).alias("values"))
        .select("cell", F.greatest(F.lit(1), F.ceil(F.least(F.col("count") / question_block, F.col("values") / PASS_VALUES))).alias("groups"))
    )
    left = (
        probed.join(sizes, "cell").join(probes_of, "cell")
        .withColumn("qb", F.pmod(F.xxhash64("qid"), F.col("groups")))
        .withColumn("ib", F.explode(_numbers(F.col("parts"))))
        .drop("parts", "groups")
    )
    right = (
        celled_index.select("id", "vector", "cell")
        .join(sizes, "cell").join(probes_of, "cell")
        .withColumn("ib", F.pmod(F.xxhash64("id"), F.col("parts")))
        .withColumn("qb", F.explode(_numbers(F.col("groups"))))
        .drop("parts", "groups")
    )
    return rank(_score_cells(left, right, ["cell", "ib", "qb"], Dense(metric), k, schema, question_block), k)
